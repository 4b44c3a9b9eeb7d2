"""Time slices to series, blocks of years, history files, output paths, stored fixed fields."""

from pyspark.sql import functions as F

from gridloom.functions import fixed_values as fixed
from gridloom.functions.calendar import month_index
from gridloom.operators import series as sr
from gridloom.plans import chains
from gridloom.plans.bindings import field, read, static
from gridloom.plans.registry import query, view
from gridloom.sources.sinks import prepare_output, with_facets
from gridloom.sources.tables import facet_path, fx_on_grid, marked, split_series
from gridloom.streaming import slices as live

MONTH = "(year(l_shipdate) * 12 + month(l_shipdate) - 1)::INTEGER"
DIMS = ("time_idx", "lev", "cell", "l_orderkey")


def slices(spark, d):
    return read(spark, d, "lineitem").select(
        month_index(F.col("l_shipdate")).alias("time_idx"), F.col("l_linenumber").alias("lev"), F.col("l_suppkey").alias("cell"), "l_orderkey",
        F.col("l_quantity").alias("QTY"), F.col("l_extendedprice").alias("PRICE"), F.col("l_discount").alias("DISC"),
    )


view(
    "series",
    " UNION ALL ".join(
        f"SELECT {MONTH} AS time_idx, l_linenumber AS lev, l_suppkey AS cell, l_orderkey, '{v}' AS var, {c} AS value FROM lineitem"
        for v, c in (("QTY", "l_quantity"), ("PRICE", "l_extendedprice"), ("DISC", "l_discount"))
    ),
)


def series(spark, d):
    return sr.slices_to_series(slices(spark, d), DIMS, ("QTY", "PRICE", "DISC"))


@query("slices_to_series", "SELECT * FROM series", ["series"])
def slices_to_series(spark, d):
    return series(spark, d)


view("blocks", "SELECT *, (1994 + (time_idx // 12 - 1994) // 3 * 3)::INTEGER AS block FROM series WHERE time_idx // 12 BETWEEN 1994 AND 1999", ("series",))


def blocks(spark, d):
    return sr.year_blocks(series(spark, d), 1994, 1998, 3, F.floor(F.col("time_idx") / 12).cast("int"))


@query("year_blocks", "SELECT var, block, count(*) AS n, min(time_idx) AS first, max(time_idx) AS last FROM blocks GROUP BY 1, 2", ["blocks"])
def year_blocks(spark, d):
    return blocks(spark, d).groupBy("var", "block").agg(F.count(F.lit(1)).alias("n"), F.min("time_idx").alias("first"), F.max("time_idx").alias("last"))


@query(
    "new_blocks",
    "SELECT var, block, time_idx, lev, cell, l_orderkey, value FROM blocks WHERE (var, block) NOT IN (SELECT DISTINCT var, block FROM blocks WHERE (var = 'QTY' OR block = 1994) AND cell > 50)",
    ["blocks"],
)
def new_blocks(spark, d):
    every = blocks(spark, d)
    return sr.new_blocks(every, every.filter("(var = 'QTY' OR block = 1994) AND cell > 50"))


STREAMS = """
    SELECT 'QTY' AS var, 'mon' AS freq, 'h.z' AS stream, year(l_shipdate) AS y, l_quantity AS value FROM lineitem
    UNION ALL SELECT 'QTY', 'mon', 'h.native', year(l_shipdate), l_quantity * 2 FROM lineitem
    UNION ALL SELECT 'LINE', 'mon', 'h.native', year(l_shipdate), l_linenumber FROM lineitem
    UNION ALL SELECT 'TOTAL', 'day', 'h.sfc', year(o_orderdate), round(o_totalprice * 100) FROM orders
    UNION ALL SELECT 'QTY', '6hr', 'h.inst', year(DATE '1990-01-01' + (ts::DATE - DATE '2020-01-01')::INTEGER), round(value * 100) FROM events"""
view("streams", STREAMS)


@query(
    "stream_series",
    "SELECT var, freq, stream, (1993 + (y - 1993) // 2 * 2)::INTEGER AS block, count(*) AS n, sum(value)::DOUBLE AS total FROM streams WHERE y BETWEEN 1993 AND 1996 GROUP BY 1, 2, 3, 4",
    ["streams"],
)
def stream_series(spark, d):
    """Two monthly streams that share a variable, a daily one by its steps, a 6-hour one by its time: each keeps all its rows
    of the years, none takes the place of another."""
    lines, orders, events = (read(spark, d, t) for t in ("lineitem", "orders", "events"))
    month, cell = month_index(F.col("l_shipdate")).alias("time_idx"), F.col("l_suppkey").alias("cell")
    days = lambda column, start: F.datediff(F.to_date(column), F.lit(start).cast("date"))
    made = chains.stream_series(
        {
            ("mon", "h.z"): lines.select(month, cell, F.col("l_quantity").alias("QTY")),
            ("mon", "h.native"): lines.select(month, cell, (F.col("l_quantity") * 2).alias("QTY"), F.col("l_linenumber").alias("LINE")),
            ("day", "h.sfc"): orders.select(days("o_orderdate", "0000-01-01").alias("time_idx"), F.col("o_custkey").alias("cell"), F.rint(F.col("o_totalprice") * 100).alias("TOTAL")),
            ("6hr", "h.inst"): events.select(
                F.lit(0).alias("time_idx"), F.col("user_id").alias("cell"), days("ts", "2020-01-01").cast("double").alias("time_b0"), F.rint(F.col("value") * 100).alias("QTY")
            ),
        },
        years=(1993, 1996, 2), units="days since 1990-01-01", calendar="standard",
    )
    return made.groupBy("var", "freq", "stream", "block").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))


@query(
    "amended_means",
    """WITH r AS (SELECT l_suppkey AS cell, (year(l_shipdate) * 12 + month(l_shipdate) - 1)::INTEGER AS month, l_quantity AS v,
                   l_orderkey % 5 = 0 AS late FROM lineitem),
       gone AS (SELECT DISTINCT month FROM r WHERE NOT late)
       SELECT 'QTY' AS var, cell, month, round(avg(v), 6) AS value, count(*) AS n, count(*) FILTER (late) AS late FROM r WHERE month IN (FROM gone) GROUP BY 2, 3""",
    [],
)
def amended_means(spark, d):
    """Means that went out at the end of each month lack the rows of every fifth order, which came later; the stored series mends them."""
    rows = read(spark, d, "lineitem").select(
        F.lit("QTY").alias("var"), F.col("l_suppkey").alias("cell"), month_index(F.col("l_shipdate")).alias("m"), (F.col("l_orderkey") % 5 == 0).alias("late"), F.col("l_quantity").alias("value")
    )
    in_time = rows.filter("NOT late").groupBy("var", "cell", F.col("m").alias("month")).agg(F.avg("value").alias("value"), F.count(F.lit(1)).alias("n"))
    return live.amended_means(in_time, rows, F.col("m")).withColumn("value", F.round("value", 6))


HISTORY = "'/archive/run.' || CASE o_orderkey % 5 WHEN 0 THEN 'cam.h0a' WHEN 1 THEN 'cam.h1a' WHEN 2 THEN 'cice.h.' WHEN 3 THEN 'cice.h1.' ELSE 'other' END || '.' || o_orderkey || '.nc'"
view("history", f"SELECT {HISTORY} AS path FROM orders")


def history(spark, d):
    return read(spark, d, "orders").select(F.expr(HISTORY).alias("path"))


def kind(spark, model, realm):
    table = sr.pattern_table(spark, {model: {realm: fixed.HISTORY_PATTERNS[model][realm]}})
    return table


@query("include_patterns", "SELECT path, p AS pattern FROM history, (VALUES ('cice.h.'), ('cice.h1.')) g(p) WHERE contains(path, p)", ["history"])
def include_patterns(spark, d):
    return sr.match_patterns(history(spark, d), kind(spark, "cesm", "seaIce"))


@query("pattern_counts", "SELECT p AS pattern, count(*) AS files FROM history, (VALUES ('cam.h0a'), ('cam.h1a'), ('cam.h2a'), ('cam.h4a')) g(p) WHERE contains(path, p) GROUP BY 1", ["history"])
def pattern_counts(spark, d):
    return sr.pattern_counts(history(spark, d), kind(spark, "noresm", "atmos"))


DATED = """'/archive/' || o_orderpriority || '/x' || (o_orderkey % 13) || '.' || year(o_orderdate) || CASE WHEN o_orderpriority = '5-LOW' AND o_orderkey % 2 = 0 THEN '' ELSE '-' END
  || lpad(CAST(month(o_orderdate) AS VARCHAR(2)), 2, '0') || CASE WHEN o_orderkey % 6 = 0 THEN '.txt' ELSE '.nc' END"""


@query(
    "latest_month",
    f"""SELECT o_orderpriority, path, y AS year, m AS month, mixed FROM (
        SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY y DESC, m DESC, split_part(path, '/', 4) DESC) AS rn,
               min(sep) OVER (PARTITION BY o_orderpriority) <> max(sep) OVER (PARTITION BY o_orderpriority) AS mixed FROM (
        SELECT o_orderpriority, {DATED} AS path, year(o_orderdate)::INTEGER AS y, month(o_orderdate)::INTEGER AS m,
               CASE WHEN o_orderpriority = '5-LOW' AND o_orderkey % 2 = 0 THEN '' ELSE '-' END AS sep FROM orders WHERE o_orderkey % 6 <> 0)) WHERE rn = 1""",
)
def latest_month(spark, d):
    files = read(spark, d, "orders").select("o_orderpriority", F.expr(DATED).alias("path"))
    return sr.latest_month(files, ["o_orderpriority"], check="flag")


@query("ocean_static", "SELECT CASE var WHEN 'PRICE' THEN 'deptho' ELSE 'areacello' END AS var, cell, value FROM field WHERE var IN ('PRICE', 'QTY')", ["field"])
def ocean_static(spark, d):
    renamed = F.when(F.col("var") == "PRICE", "deptho").when(F.col("var") == "QTY", "areacello").otherwise(F.col("var"))
    return sr.ocean_static(field(spark, d).withColumn("var", renamed)).select("var", "cell", "value")


@query(
    "scan_series",
    """SELECT var, time_idx, lev, cell, value FROM field WHERE var IN ('PRICE', 'TAX')
       UNION ALL SELECT DISTINCT 'area', NULL::INTEGER, NULL::INTEGER, l_suppkey, (l_suppkey % 13)::DOUBLE FROM lineitem""",
    ["field"],
)
def scan_series(spark, d):
    """Series with NaN for missing and an area that every slice repeats."""
    nan = F.coalesce("value", F.lit(float("nan")))
    repeated = read(spark, d, "lineitem").select(
        F.lit("area").alias("var"), month_index(F.col("l_shipdate")).alias("time_idx"), F.col("l_linenumber").alias("lev"),
        F.col("l_suppkey").alias("cell"), (F.col("l_suppkey") % 13).cast("double").alias("value"),
    )
    moving, fixed_once = split_series(field(spark, d).withColumn("value", nan).unionByName(repeated), ("PRICE", "TAX", "area"))
    return moving.unionByName(fixed_once, allowMissingColumns=True)


@query(
    "output_tree",
    """SELECT 'era/act/inst/src/hist/r1/' || CASE WHEN cell % 2 = 0 THEN 'nh' ELSE 'glb' END || '/mon/' || lower(var) || '/tavg-u-hxy-u/gr' AS path, count(*) AS n, sum((value = 1e20)::INTEGER)::BIGINT AS missing
       FROM (SELECT var, cell, coalesce(value, 1e20) AS value FROM field) GROUP BY 1""",
    ["field"],
)
def output_tree(spark, d):
    facets = dict(zip(fixed.TREE_FACETS, ("era", "act", "inst", "src", "hist", "r1"))) | {"frequency": "mon"}
    named = field(spark, d).withColumn("var", F.concat(F.lower("var"), F.lit("_tavg-u-hxy-u"))).withColumn("region", F.when(F.col("cell") % 2 == 0, "nh"))
    out = with_facets(prepare_output(named), facets)
    return out.groupBy(facet_path().alias("path")).agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("value") == F.lit(1e20).cast("float")).cast("long")).alias("missing"))


@query(
    "existing_fx",
    "SELECT cell, landfrac AS value FROM static",
    ["static"],
)
def existing_fx(spark, d):
    """A stored field is reused only on the same grid: the moved one, with other values, is refused, marked or not."""
    grid = static(spark, d)
    stored = grid.select(F.lit("sftlf").alias("var"), "cell", "lat", "lon", F.col("landfrac").alias("value"))
    moved = stored.withColumns({"lat": F.col("lat") + 1.0, "value": F.lit(-1.0)})
    found = [fx_on_grid(s, "sftlf", grid) for s in (moved, marked(moved, moved), marked(stored, stored.orderBy(F.desc("cell"))), stored)]
    usable = [f for f in found if f is not None]
    if len(usable) != 2:
        raise ValueError(f"{len(usable)} of 4 stored fields were taken for this grid, not 2")
    return usable[0].select("cell", "value")
