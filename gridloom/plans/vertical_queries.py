"""Vertical interpolation, depth remap, hybrid output and level tables."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from gridloom.functions.values import pressure_to_pa, reference_pressure
from gridloom.operators import regrid as rg
from gridloom.operators import vertical as vt
from gridloom.plans.bindings import NLON, axes, coefficients, field, read, static
from gridloom.plans.regrid_queries import cons
from gridloom.plans.registry import query, view, with_views
from gridloom.sources.tables import axis_levels, coordinate_file

PLEVS = (100000.0, 85000.0, 70000.0, 50000.0, 30000.0, 20000.0, 10000.0)
BINS = ((0.0, 2.0), (2.0, 6.0), (6.0, 10.0), (10.0, 20.0), (20.0, 400.0))


def pressure_sql(source: str, keys: str, p0: str = "100000e0") -> str:
    """Interpolation as a range match between neighbouring levels, then every level of every column."""
    listed = ", ".join(f"({p:.0f}e0)" for p in PLEVS)
    return f"""
      cols AS (SELECT {keys}, lev, value, hyam * {p0} + hybm * ps AS p FROM {source}),
      seg AS (SELECT *, lead(p) OVER w AS p1, lead(value) OVER w AS v1,
                     lead(lev, 2) OVER w IS NULL AND lead(lev) OVER w IS NOT NULL AS ends,
                     lag(lev) OVER w IS NULL AND lead(lev) OVER w IS NULL AS alone
              FROM cols WINDOW w AS (PARTITION BY {keys} ORDER BY lev)),
      hit AS (SELECT {keys}, plev, CASE WHEN plev = p THEN value WHEN plev = p1 THEN v1
                     ELSE value + ((v1 - value) * (plev - p)) / (p1 - p) END AS value
              FROM seg JOIN (VALUES {listed}) l(plev)
                ON (p <= plev AND (plev < p1 OR (ends AND plev = p1))) OR (alone AND plev = p)),
      interp AS (SELECT {keys}, plev, hit.value FROM (SELECT DISTINCT {keys} FROM cols) CROSS JOIN (VALUES {listed}) l(plev)
                 LEFT JOIN hit USING ({keys}, plev))"""


view(
    "on_levels",
    "SELECT var, time_idx, lev, cell, value, hyam, hybm, ps FROM price JOIN coeff USING (lev) LEFT JOIN static USING (cell)",
    ("price", "coeff", "static"),
)


def with_column_inputs(spark, d):
    return vt.join_column_inputs(field(spark, d, "PRICE"), static(spark, d), coefficients(spark), ("cell",))


@query(
    "column_inputs",
    "SELECT * FROM on_levels",
    ["on_levels"],
)
def column_inputs(spark, d):
    return with_column_inputs(spark, d).select("var", "time_idx", "lev", "cell", "value", "hyam", "hybm", "ps")


def with_interp(source_view: str, keys: str, body: str, uses, p0: str = "100000e0"):
    head = with_views(uses, "")
    return f"{head.rstrip()}, {pressure_sql(source_view, keys, p0).strip()} {body}"


@query("pressure_interp", with_interp("on_levels", "var, time_idx, cell", "SELECT var, time_idx, cell, plev, value FROM interp", ["on_levels"]))
def pressure_interp(spark, d):
    return vt.to_pressure(with_column_inputs(spark, d), PLEVS)


# A stored reference pressure that differs by level, and is missing on one of them.
P0_SQL = "coalesce(CASE WHEN lev <> 4 THEN 90000e0 + lev * 1000e0 END, 98000e0)"


@query("pressure_interp_stored_p0", with_interp("on_levels", "var, time_idx, cell", "SELECT var, time_idx, cell, plev, value FROM interp", ["on_levels"], P0_SQL))
def pressure_interp_stored_p0(spark, d):
    stored = coefficients(spark).withColumn("P0", F.when(F.col("lev") != 4, F.lit(90000.0) + F.col("lev") * 1000.0))
    inputs = vt.join_column_inputs(field(spark, d, "PRICE"), static(spark, d), stored, ("cell",))
    return vt.to_pressure(inputs, PLEVS, vt.stored_p0(inputs, 98000.0))


view("dst_ps", "SELECT dst_cell AS cell, sum(w * ps_cents) / sum(w) / 100e0 AS ps FROM (SELECT cell, round(ps * 100) AS ps_cents FROM static) JOIN cons ON src_cell = cell GROUP BY 1", ("static", "cons"))
view(
    "regridded_levels",
    "SELECT var, time_idx, lev, cell, value, hyam, hybm, ps FROM regridded JOIN coeff USING (lev) LEFT JOIN dst_ps USING (cell)",
    ("regridded", "coeff", "dst_ps"),
)


def regridded_ps(spark, d):
    """Surface pressure on the destination grid; cents keep the sums whole."""
    cents = static(spark, d).select("cell", F.round(F.col("ps") * 100).alias("value"))
    return rg.regrid(cents, cons(spark, d), keys=()).select("cell", (F.col("value") / 100.0).alias("ps"))


@query(
    "zonal_mean_pressure",
    with_interp(
        "regridded_levels",
        "var, time_idx, cell",
        f"SELECT var, time_idx, plev, (cell // {NLON})::INTEGER AS ilat, round(avg(value), 3) AS value FROM interp GROUP BY 1, 2, 3, 4",
        ["regridded_levels"],
    ),
)
def zonal_mean_pressure(spark, d):
    on_grid = rg.regrid(field(spark, d, "PRICE"), cons(spark, d))
    inputs = vt.join_column_inputs(on_grid, regridded_ps(spark, d), coefficients(spark), ("cell",))
    return vt.zonal_mean(vt.to_pressure(inputs, PLEVS), NLON).withColumn("value", F.round("value", 3))  # a mean depends on its order


@query(
    "zonal_mean",
    f"""SELECT var, time_idx, lev, (cell // {NLON})::INTEGER AS ilat, avg(value) AS value FROM
        (SELECT var, time_idx, lev, dst_cell AS cell, sum(w * value) AS value FROM price JOIN cons ON src_cell = cell GROUP BY 1, 2, 3, 4)
        GROUP BY 1, 2, 3, 4""",
    ["price", "cons"],
)
def zonal_mean(spark, d):
    joined = field(spark, d, "PRICE").withColumnRenamed("cell", "src_cell").join(cons(spark, d), "src_cell")
    sums = joined.groupBy("var", "time_idx", "lev", F.col("dst_cell").alias("cell")).agg(F.sum(F.col("w") * F.col("value")).alias("value"))
    return vt.zonal_mean(sums, NLON, ("var", "time_idx", "lev"))


# Interface k of a column lies at the summed thickness of the layers above; thickness 2^(lev % 3) makes weights exact.
view(
    "layers",
    """SELECT var, time_idx, cell, lev - 1 AS k, value, sum(dz) OVER w - dz AS z0, sum(dz) OVER w AS z1 FROM
       (SELECT *, (1 << (lev % 3))::DOUBLE AS dz FROM price) WINDOW w AS (PARTITION BY var, time_idx, cell ORDER BY lev)""",
    ("price",),
)


def layers(spark, d):
    dz = F.pow(F.lit(2.0), F.col("lev") % 3)
    column = Window.partitionBy("var", "time_idx", "cell").orderBy("lev")
    base = F.sum("dz").over(column)
    stacked = field(spark, d, "PRICE").withColumn("dz", dz).withColumns({"z1": base, "rank": F.row_number().over(column)})
    return stacked.select("var", "time_idx", "cell", (F.col("rank") - 1).alias("k"), "value", (F.col("z1") - F.col("dz")).alias("z0"), "z1")


@query(
    "depth_overlap_remap",
    f"""SELECT var, time_idx, cell, olevel, CASE WHEN den > 0 THEN coalesce(num, 0e0) / den END AS value FROM (
        SELECT c.var, c.time_idx, c.cell, olevel::INTEGER AS olevel, sum(l.w * l.value) AS num, sum(l.w) AS den
        FROM (SELECT DISTINCT var, time_idx, cell FROM layers) c
        CROSS JOIN (VALUES {", ".join(f"({i}, {a}::DOUBLE, {b}::DOUBLE)" for i, (a, b) in enumerate(BINS))}) b(olevel, b0, b1)
        LEFT JOIN LATERAL (SELECT (least(z1, b1) - greatest(z0, b0)) / (z1 - z0) AS w, value FROM layers x
              WHERE x.var = c.var AND x.time_idx = c.time_idx AND x.cell = c.cell AND z0 < b1 AND z1 > b0) l ON true
        GROUP BY 1, 2, 3, 4)""",
    ["layers"],
)
def depth_overlap_remap(spark, d):
    return vt.remap_depth(layers(spark, d), BINS)


# Bins that stretch with the column: twice or four times as thick in two thirds of the cells.
view(
    "column_bins",
    f"""SELECT s_suppkey AS cell, olevel::INTEGER AS olevel, b0 * (1 << (s_suppkey % 3)) AS b0, b1 * (1 << (s_suppkey % 3)) AS b1
        FROM supplier, (VALUES {", ".join(f"({i}, {a}::DOUBLE, {b}::DOUBLE)" for i, (a, b) in enumerate(BINS))}) b(olevel, b0, b1)""",
)


@query(
    "depth_remap_by_column",
    """SELECT var, time_idx, cell, olevel, CASE WHEN den > 0 THEN coalesce(num, 0e0) / den END AS value FROM (
        SELECT c.var, c.time_idx, c.cell, b.olevel, sum(l.w * l.value) AS num, sum(l.w) AS den
        FROM (SELECT DISTINCT var, time_idx, cell FROM layers) c JOIN column_bins b ON b.cell = c.cell
        LEFT JOIN LATERAL (SELECT (least(z1, b.b1) - greatest(z0, b.b0)) / (z1 - z0) AS w, value FROM layers x
              WHERE x.var = c.var AND x.time_idx = c.time_idx AND x.cell = c.cell AND z0 < b.b1 AND z1 > b.b0) l ON true
        GROUP BY 1, 2, 3, 4)""",
    ["layers", "column_bins"],
)
def depth_remap_by_column(spark, d):
    """Depth bins held in a table, another set for each cell."""
    edge = F.explode(F.array(*[F.struct(F.lit(i).alias("olevel"), F.lit(a).alias("a"), F.lit(b).alias("b")) for i, (a, b) in enumerate(BINS)])).alias("_e")
    stretch = F.pow(F.lit(2.0), F.col("cell") % 3)
    cells = read(spark, d, "supplier").select(F.col("s_suppkey").alias("cell"), edge)
    bins = cells.select("cell", "_e.olevel", (F.col("_e.a") * stretch).alias("b0"), (F.col("_e.b") * stretch).alias("b1"))
    return vt.remap_depth_by_column(layers(spark, d), bins)


@query(
    "hybrid_output",
    """SELECT o.var, o.time_idx, o.lev, o.cell, o.value, p.value AS ps, hyam AS a, hybm AS b, 100000e0 AS p0 FROM
       (SELECT * FROM regridded) o JOIN (
          SELECT time_idx, dst_cell AS cell, sum(w * value) / nullif(sum(CASE WHEN value IS NOT NULL THEN w END), 0) AS value
          FROM (SELECT DISTINCT time_idx, cell FROM native) JOIN (SELECT cell, round(ps) AS value FROM static) USING (cell)
          JOIN cons ON src_cell = cell GROUP BY 1, 2) p USING (time_idx, cell) JOIN coeff USING (lev)""",
    ["regridded", "native", "static", "cons", "coeff"],
)
def hybrid_output(spark, d):
    target = field(spark, d, "PRICE")
    surface = target.select("time_idx", "cell").distinct().join(static(spark, d).select("cell", F.round("ps").alias("value")), "cell")
    both = target.unionByName(surface.select(F.lit("PS").alias("var"), "time_idx", F.lit(0).alias("lev"), "cell", "value"))
    on_grid = rg.regrid(both, cons(spark, d))
    ps = on_grid.filter("var = 'PS'").select("time_idx", "cell", F.col("value").alias("ps"))
    return vt.hybrid_output(on_grid.filter("var != 'PS'"), ps, coefficients(spark))


@query(
    "hybrid_levels",
    """SELECT lev, a, b, coalesce(p0, 98000e0) AS p0, l.ha AS a_b0, l.hb AS b_b0, r.ha AS a_b1, r.hb AS b_b1 FROM
       (SELECT p_partkey AS lev, p_retailprice AS a, p_size / 50e0 AS b, CASE WHEN p_partkey % 3 > 0 THEN p_size * 1000e0 END AS p0 FROM part)
       LEFT JOIN (SELECT p_partkey AS lev, p_retailprice / 2e0 AS ha, p_size / 4e0 AS hb FROM part) l USING (lev)
       LEFT JOIN (SELECT p_partkey - 1 AS lev, p_retailprice / 2e0 AS ha, p_size / 4e0 AS hb FROM part) r USING (lev)""",
)
def hybrid_levels(spark, d):
    part = read(spark, d, "part")
    lev, price, size = F.col("p_partkey"), F.col("p_retailprice"), F.col("p_size")
    mid = part.select(lev.alias("lev"), price.alias("hyam"), (size / 50.0).alias("hybm"), F.when(lev % 3 > 0, size * 1000.0).alias("P0"))
    return vt.hybrid_levels(mid, part.select(lev.alias("lev"), (price / 2.0).alias("hyai"), (size / 4.0).alias("hybi")), 98000.0)


@query("rescale_levels", "SELECT axis_id, i, s / 1000e0 AS lev, (s + i) / 1000e0 AS ilev FROM axes", ["axes"])
def rescale_levels(spark, d):
    table = axes(spark, d).select("axis_id", "i", F.col("s").alias("lev"), (F.col("s") + F.col("i")).alias("ilev"))
    return vt.rescale_levels(table)


@query(
    "vertical_meta",
    """SELECT k, lev, hyam, b0, b1, hyai, 100000e0 AS P0 FROM
       (SELECT p_partkey AS k, p_size + 0.5e0 AS lev, p_retailprice AS hyam FROM part)
       JOIN (SELECT p_partkey AS k, p_size::DOUBLE AS b0, p_retailprice / 2e0 AS hyai FROM part) USING (k)
       JOIN (SELECT p_partkey - 1 AS k, p_size::DOUBLE AS b1 FROM part) USING (k)""",
)
def vertical_meta(spark, d):
    part = read(spark, d, "part")
    levels = part.select(F.col("p_partkey").alias("k"), (F.col("p_size") + 0.5).cast("double").alias("lev"), F.col("p_retailprice").alias("hyam"))
    edges = part.select(F.col("p_partkey").alias("k"), F.col("p_size").cast("double").alias("ilev"), (F.col("p_retailprice") / 2.0).alias("hyai"))
    return vt.attach_vertical_meta(levels, edges, reference_pressure())


@query(
    "depth_bounds_truncate",
    "SELECT a.axis_id, a.i AS k, a.s::DOUBLE AS depth, a.i::DOUBLE AS b0, (a.i + 1)::DOUBLE AS b1 FROM axes a WHERE a.i < 40",
    ["axes"],
)
def depth_bounds_truncate(spark, d):
    levels = axes(spark, d).select("axis_id", F.col("i").alias("k"), F.col("s").cast("double").alias("depth"))
    bounds = spark.range(40).select(F.col("id").alias("k"), F.col("id").cast("double").alias("b0"), (F.col("id") + 1).cast("double").alias("b1"))
    return vt.truncate_bounds(levels, bounds)


@query(
    "plev_to_pa",
    """SELECT axis_id, i, CASE WHEN u IN ('hpa', 'mbar') OR (u = '' AND m <= 2000) THEN v * 100e0 ELSE v END AS plev FROM (
       SELECT *, max(v) OVER (PARTITION BY axis_id) AS m FROM (
         SELECT axis_id, i, CASE axis_id % 3 WHEN 0 THEN 'hpa' WHEN 1 THEN '' ELSE 'pa' END AS u,
                CASE WHEN axis_id % 2 = 0 THEN s * 10e0 ELSE s * 1000e0 END AS v FROM axes))""",
    ["axes"],
)
def plev_to_pa(spark, d):
    a = F.col("axis_id")
    table = axes(spark, d).select(
        "axis_id",
        "i",
        F.when(a % 3 == 0, "hPa").when(a % 3 == 1, " ").otherwise("Pa").alias("units"),
        F.when(a % 2 == 0, F.col("s") * 10.0).otherwise(F.col("s") * 1000.0).alias("v"),
    )
    largest = table.groupBy("axis_id").agg(F.max("v").alias("m"))
    joined = table.join(largest, "axis_id")
    return joined.select("axis_id", "i", pressure_to_pa(F.col("v"), F.col("units"), F.col("m")).alias("plev"))


def level_texts(spark, d):
    """One JSON text per part, with its axis; three parts share a table set, and their files have different names."""
    size, k = F.col("p_size").cast("string"), F.col("p_partkey")
    text = F.concat(
        F.lit('{"axis_entry": {"plev'), "p_brand", k, F.lit('": {"requested": ["'), size, F.lit('000.", "'), size, F.lit('0."]}, "latitude": {"units": "1"}}}')
    )
    name = F.when(k % 3 == 0, "CMIP_coordinate").when(k % 3 == 1, "CMIP6_coordinate").when(F.col("p_size") % 2 == 0, "CMIP7_coordinate").otherwise("CMIP8_coordinate")
    return read(spark, d, "part").select(F.floor(k / 3).alias("set"), F.concat(F.lit("tables/"), name, F.lit(".json")).alias("path"), text.alias("value"))


view("axis_texts", "SELECT p_partkey // 3 AS set, p_partkey, p_size, 'plev' || p_brand || p_partkey AS axis, o::INTEGER AS ord, (CASE o WHEN 0 THEN p_size * 1000 ELSE p_size * 10 END)::DOUBLE AS plev FROM part, (VALUES (0), (1)) g(o)")


@query("axis_levels", "SELECT axis, ord, plev FROM axis_texts", ["axis_texts"])
def all_axis_levels(spark, d):
    return axis_levels(level_texts(spark, d))


@query(
    "requested_levels",
    """SELECT set, axis, ord, plev FROM (SELECT *, CASE p_partkey % 3 WHEN 0 THEN 3 WHEN 1 THEN 2 ELSE 1 END AS r FROM axis_texts WHERE p_partkey % 3 < 2 OR p_size % 2 = 0)
       QUALIFY r = min(r) OVER (PARTITION BY set)""",
    ["axis_texts"],
)
def requested_levels(spark, d):
    """Of every table set the file that comes first by name decides; files of other names do not count."""
    return axis_levels(coordinate_file(level_texts(spark, d), ["set"]), ["set"])


@query(
    "reference_pressure",
    """SELECT s_suppkey AS cell, coalesce(CASE WHEN s_suppkey % 3 = 0 THEN s_acctbal END, CASE WHEN s_suppkey % 3 = 1 AND s_suppkey % 2 = 0 THEN 98000e0 END, 100000e0) AS p0 FROM supplier""",
)
def reference_pressures(spark, d):
    c = F.col("s_suppkey")
    attribute = F.when(c % 3 == 1, F.when(c % 2 == 0, "98000.0").otherwise("not a number"))
    return read(spark, d, "supplier").select(
        c.alias("cell"), reference_pressure(F.when(c % 3 == 0, F.col("s_acctbal")), attribute).alias("p0")
    )
