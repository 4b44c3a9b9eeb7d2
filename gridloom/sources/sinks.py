"""Writing series, output trees and reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions import fixed_values as fixed
from gridloom.functions.values import fill_missing
from gridloom.operators.regrid import fx_missing, fx_table
from gridloom.operators.series import new_blocks
from gridloom.sources.tables import marked


def gathered(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows of one output folder brought together, in pieces of the advisory partition size.

    Adaptive execution joins small folders into one task and splits a folder that holds most of the rows, so the
    number and size of files follow the data.
    """
    return df.hint("rebalance", *by)


def write_series(series: DataFrame, path: str, by: Sequence[str] = ("var", "freq")) -> None:
    """Series files by variable, each sorted in time."""
    spread = gathered(series, by).sortWithinPartitions(*by, "time_idx")
    spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def write_blocks(spark: SparkSession, series: DataFrame, path: str, *, overwrite: bool = False, keys: Sequence[str] = ("var", "block")) -> None:
    """Block files: replace the blocks at hand, or add only the blocks that are not stored yet."""
    if overwrite:
        gathered(series, keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)
        return
    fresh = new_blocks(series, spark.read.parquet(path), keys) if _exists(spark, path) else series
    gathered(fresh, keys).write.mode("append").partitionBy(*keys).parquet(path)


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        return not spark.read.parquet(path).limit(1).isEmpty()
    except Exception as error:  # the reader's own error for a path that is not there
        if "PATH_NOT_FOUND" in str(error) or "UNABLE_TO_INFER_SCHEMA" in str(error):
            return False
        raise


def prepare_output(df: DataFrame, *, fill: float = fixed.MISSING) -> DataFrame:
    """Values as stored: missing and infinite as the fill value, 4-byte floats."""
    return df.withColumn("value", fill_missing(F.col("value"), fill))


def with_facets(df: DataFrame, facets: Mapping[str, str], regridded: bool = True) -> DataFrame:
    """Facet columns that are the same for all rows; the grid label is ``gr`` when regridded, else ``gn``.

    A branded name ``short_branding`` gives the variable and branding facets. The region stays when the rows have one.
    """
    named = df.withColumn("variable_id", F.substring_index("var", "_", 1)).withColumn(
        "branding_suffix", F.when(F.contains("var", F.lit("_")), F.expr("substring(var, instr(var, '_') + 1)")).otherwise("none")
    )
    base = {"region": "glb"} | dict(facets) | {"grid_label": "gr" if regridded else "gn"}
    added = {k: F.lit(v) for k, v in base.items() if k not in named.columns}
    if "region" in df.columns:
        added["region"] = F.coalesce(F.col("region"), F.lit(base["region"]))
    return named.withColumns(added)


def write_tree(df: DataFrame, root: str, facets: Sequence[str] = fixed.TREE_FACETS) -> None:
    """Parquet files under one folder level per facet."""
    gathered(df, facets).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*facets).parquet(root)


def write_fx(fields: DataFrame, grid: DataFrame, path: str) -> None:
    """Fixed fields (``var, cell, value`` and what else they have) by variable, each replaced as a whole, with their grid's fingerprint."""
    marked(fields, grid).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("var").parquet(path)


def ensure_fx(spark: SparkSession, path: str, static: DataFrame, weights: DataFrame, source_id: str) -> DataFrame:
    """Stored fixed fields of all maps for one source; only maps that are not stored yet are computed and added.

    Keyed by map and source, so another model's fractions on the same map are never reused.
    """
    wanted = weights.select("map_id", F.lit(source_id).alias("source_id")).distinct()
    missing = fx_missing(wanted, spark.read.parquet(path)) if _exists(spark, path) else wanted
    open_maps = sorted(row["map_id"] for row in missing.collect())  # a handful of maps
    if open_maps:
        made = fx_table(static, weights.filter(F.col("map_id").isin(open_maps)))
        made.withColumn("source_id", F.lit(source_id)).write.mode("append").parquet(path)
    return spark.read.parquet(path).filter(F.col("source_id") == source_id)


def flat_table(table: DataFrame) -> DataFrame:
    """Nested columns as JSON text, for files that hold plain cells only."""
    return table.select(*[F.to_json(c).alias(c) if t.startswith(("array", "map", "struct")) else F.col(c) for c, t in table.dtypes])


def write_report(root: str, summary: DataFrame, tables: Mapping[str, DataFrame]) -> None:
    """Audit results: the summary as JSON, each table as CSV with a header, lists as JSON text."""
    summary.write.mode("overwrite").json(f"{root}/validation_summary")
    for name, table in tables.items():
        flat_table(table).write.mode("overwrite").option("header", True).csv(f"{root}/{name}")
