"""The given tables seen as fields, grids, weights, axes, catalogs and logs, in Spark and in SQL.

Values are whole numbers (cents, units, percent points) and fractions are eighths, so sums do not depend on their
order and both engines agree to the last bit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions.calendar import month_index
from gridloom.plans.registry import view

NLAT, NLON = 4, 6
CELLS = NLAT * NLON
NATIVE = ("PRICE", "QTY", "DISC", "TAX")
AXIS_POINTS = 48


# Declared, so no file is opened to find a schema.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
    "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[table]).parquet(f"{sf_dir}/{table}.parquet")


# --- field ---------------------------------------------------------------------------------------------------------


def native(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per month, level and cell with the four native variables; PRICE is missing for every seventh amount."""
    lines = read(spark, sf_dir, "lineitem")
    cents = lambda c: F.sum(F.rint(F.col(c) * 100))
    summed = lines.groupBy(
        month_index(F.col("l_shipdate")).alias("time_idx"), F.col("l_linenumber").alias("lev"), F.col("l_suppkey").alias("cell")
    ).agg(cents("l_extendedprice").alias("_p"), F.sum("l_quantity").alias("QTY"), cents("l_discount").alias("DISC"), cents("l_tax").alias("TAX"))
    price = F.when(F.pmod(F.col("QTY").cast("long"), F.lit(7)) != 0, F.col("_p"))
    return summed.select("time_idx", "lev", "cell", price.alias("PRICE"), "QTY", "DISC", "TAX")


def field(spark: SparkSession, sf_dir: str, *variables: str) -> DataFrame:
    """The native variables as a long field table."""
    names = list(variables or NATIVE)
    wide = native(spark, sf_dir)
    if len(names) == 1:
        return wide.select(F.lit(names[0]).alias("var"), "time_idx", "lev", "cell", F.col(names[0]).alias("value"))
    return wide.unpivot(["time_idx", "lev", "cell"], names, "var", "value")


view(
    "native",
    """SELECT time_idx, lev, cell, CASE WHEN QTY::BIGINT % 7 <> 0 THEN p END AS PRICE, QTY, DISC, TAX FROM (
       SELECT (year(l_shipdate) * 12 + month(l_shipdate) - 1)::INTEGER AS time_idx, l_linenumber::INTEGER AS lev,
              l_suppkey AS cell, sum(round(l_extendedprice * 100)) AS p, sum(l_quantity) AS QTY,
              sum(round(l_discount * 100)) AS DISC, sum(round(l_tax * 100)) AS TAX
       FROM lineitem GROUP BY 1, 2, 3)""",
)
view(
    "field",
    " UNION ALL ".join(f"SELECT '{v}' AS var, time_idx, lev, cell, {v} AS value FROM native" for v in NATIVE),
    ("native",),
)
view("price", "SELECT var, time_idx, lev, cell, value FROM field WHERE var = 'PRICE'", ("field",))


# --- grids ---------------------------------------------------------------------------------------------------------


def static(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells with surface pressure, fractions, areas and coordinates; the land fraction is missing in some."""
    c = F.col("s_suppkey")
    return read(spark, sf_dir, "supplier").select(
        c.alias("cell"),
        (F.lit(95000.0) + F.col("s_acctbal")).alias("ps"),
        F.when(c % 10 != 7, (c % 9) / F.lit(8.0)).alias("landfrac"),
        ((c % 5) / F.lit(4.0)).alias("wet"),
        ((c % 13 + 1) * 10).cast("double").alias("area"),
        ((c % 13 + 1) * 1000).cast("double").alias("tarea"),
        ((c * 37) % 181 - 90).cast("double").alias("tlat"),
        ((c * 37) % 181 - 90).cast("double").alias("lat"),
        ((c * 53) % 720 - 360).cast("double").alias("lon"),
    )


view(
    "static",
    """SELECT s_suppkey AS cell, 95000e0 + s_acctbal AS ps,
       CASE WHEN s_suppkey % 10 <> 7 THEN (s_suppkey % 9) / 8e0 END AS landfrac, (s_suppkey % 5) / 4e0 AS wet,
       ((s_suppkey % 13 + 1) * 10)::DOUBLE AS area, ((s_suppkey % 13 + 1) * 1000)::DOUBLE AS tarea,
       ((s_suppkey * 37) % 181 - 90)::DOUBLE AS tlat, ((s_suppkey * 37) % 181 - 90)::DOUBLE AS lat,
       ((s_suppkey * 53) % 720 - 360)::DOUBLE AS lon FROM supplier""",
)


def weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sparse maps from the cells to a 4 x 6 grid, three entries per cell."""
    cells = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("src_cell"), F.explode(F.sequence(F.lit(0), F.lit(2))).alias("j"))
    entry = lambda name, dst, w: F.struct(F.lit(name).alias("map_id"), dst.cast("long").alias("dst_cell"), w.cast("double").alias("w"))
    both = F.array(
        entry("cons", (F.col("src_cell") * 7 + F.col("j") * 5) % CELLS, F.col("j") + 1),
        entry("bilin", (F.col("src_cell") * 11 + F.col("j") * 3 + 1) % CELLS, F.col("j") * 2 + 1),
    )
    return cells.select("src_cell", F.explode(both).alias("_e")).select("_e.map_id", "src_cell", "_e.dst_cell", "_e.w")


view(
    "weights",
    f"""SELECT 'cons' AS map_id, s_suppkey AS src_cell, (s_suppkey * 7 + j * 5) % {CELLS} AS dst_cell, (j + 1)::DOUBLE AS w
        FROM supplier, generate_series(0, 2) g(j)
        UNION ALL SELECT 'bilin', s_suppkey, (s_suppkey * 11 + j * 3 + 1) % {CELLS}, (j * 2 + 1)::DOUBLE
        FROM supplier, generate_series(0, 2) g(j)""",
)
view("cons", "SELECT src_cell, dst_cell, w FROM weights WHERE map_id = 'cons'", ("weights",))


def coefficients(spark: SparkSession) -> DataFrame:
    """Hybrid coefficients of the seven levels."""
    k = F.col("id")
    return spark.range(1, 8).select(
        k.cast("int").alias("lev"), ((F.lit(7) - k) / F.lit(70.0)).alias("hyam"), (k / F.lit(7.0)).alias("hybm")
    )


view("coeff", "SELECT k::INTEGER AS lev, (7 - k) / 70e0 AS hyam, k / 7e0 AS hybm FROM generate_series(1, 7) g(k)")


# --- axes ------------------------------------------------------------------------------------------------------------


def axes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Axes of up to 48 points each, with a number ``s`` of 1..50 per point to derive values from."""
    key = F.col("p_partkey")
    return read(spark, sf_dir, "part").select(
        F.floor(key / AXIS_POINTS).cast("long").alias("axis_id"), (key % AXIS_POINTS).alias("i"), F.col("p_size").alias("s")
    )


view("axes", f"SELECT p_partkey // {AXIS_POINTS} AS axis_id, p_partkey % {AXIS_POINTS} AS i, p_size AS s FROM part")
