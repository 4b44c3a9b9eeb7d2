"""From time slices that hold many variables to one series per variable."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions import fixed_values as fixed
from gridloom.functions import text as tx
from gridloom.functions.calendar import year_block
from gridloom.functions.sizing import small


def slices_to_series(slices: DataFrame, dims: Sequence[str], variables: Sequence[str]) -> DataFrame:
    """Long series rows (dims, ``var``, ``value``) from wide slice rows. No shuffle: each row turns in place."""
    numbers = slices.select(*dims, *[F.col(v).cast("double").alias(v) for v in variables])
    return numbers.unpivot(list(dims), list(variables), "var", "value")


def year_blocks(series: DataFrame, first: int, last: int, step: int, year: Column) -> DataFrame:
    """Rows of the years first..last, each with the first year of its block.

    The last block keeps its full length, so it may end after ``last``.
    """
    end = first + ((last - first) // step + 1) * step - 1
    return series.filter(year.between(first, end)).withColumn("block", year_block(year, first, step))


def new_blocks(series: DataFrame, existing: DataFrame, keys: Sequence[str] = ("var", "block")) -> DataFrame:
    """Rows of blocks that are not stored yet, for runs without overwriting."""
    return series.join(small(existing.select(*keys).distinct()), list(keys), "left_anti")


def pattern_table(spark: SparkSession, patterns: Mapping = fixed.HISTORY_PATTERNS) -> DataFrame:
    """(model, realm, frequency, pattern) of the history files."""
    rows = [
        (model, realm, frequency, pattern)
        for model, realms in patterns.items()
        for realm, frequencies in realms.items()
        for frequency, listed in frequencies.items()
        for pattern in listed
    ]
    return spark.createDataFrame(rows, "model string, realm string, frequency string, pattern string")


def include_patterns(patterns: Mapping, model: str, realm: str, frequency: str) -> list[str]:
    """File-name parts of one kind of history file; an undefined kind is an error."""
    try:
        return list(patterns[model][realm][frequency])
    except KeyError:
        raise ValueError(f"no patterns for model={model}, realm={realm}, frequency={frequency}") from None


def match_patterns(files: DataFrame, patterns: DataFrame) -> DataFrame:
    """Files (``path``) with every pattern their name contains.

    The few patterns ride along as one array per file, so there is no join on a text search.
    """
    listed = [row["pattern"] for row in patterns.select("pattern").distinct().orderBy("pattern").collect()]
    if not listed:
        return files.withColumn("pattern", F.lit(None).cast("string")).limit(0)
    name = tx.file_name(F.col("path"))
    hits = F.filter(F.array(*[F.lit(p) for p in listed]), lambda p: F.contains(name, p))
    return files.withColumn("pattern", F.explode(hits))


def pattern_counts(files: DataFrame, patterns: DataFrame) -> DataFrame:
    """Files per pattern; patterns without files are absent."""
    return match_patterns(files, patterns).groupBy("pattern").agg(F.count(F.lit(1)).alias("files"))


def latest_month(files: DataFrame, keys: Sequence[str] = (), check: str = "raise") -> DataFrame:
    """Most recent dated file (``path, year, month``), ties by name; mixing YYYYMM and YYYY-MM names is an error.

    ``check="flag"`` reports the mix as column ``mixed`` instead.
    """
    name = tx.file_name(F.col("path"))
    part = lambda i: F.regexp_extract(name, fixed.FILE_MONTH_PATTERN, i)
    dated = files.filter(name.rlike(fixed.FILE_MONTH_PATTERN)).select(
        *keys, "path", part(1).cast("int").alias("year"), part(3).cast("int").alias("month"), part(2).alias("sep"), name.alias("_n")
    )
    best = dated.groupBy(*keys).agg(
        F.max(F.struct("year", "month", F.col("_n"), "path")).alias("_m"), (F.min("sep") != F.max("sep")).alias("mixed")
    ).filter(F.col("_m").isNotNull())
    out = best.select(*keys, "_m.path", "_m.year", "_m.month", "mixed")
    if check == "flag":
        return out
    wrong = F.raise_error(F.lit("mixed date styles in file names")).cast("string")
    return out.withColumn("path", F.when(F.col("mixed"), wrong).otherwise(F.col("path"))).drop("mixed")


def ocean_static(field: DataFrame) -> DataFrame:
    """Depth and cell area of the ocean grid, nothing else."""
    return field.filter(F.col("var").isin(*fixed.OCEAN_STATIC))
