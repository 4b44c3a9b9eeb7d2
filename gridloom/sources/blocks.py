"""Stored series with a manifest: which blocks of which series are complete, and what is in them.

A block is the rows of one variable, frequency and stream, of one block of years if the series is cut into such. Its files
replace whatever its folder has; only then is it listed in the manifest, by one small file that appears at once. What a job left
behind that did not get so far is not listed: readers do not see it, and the next run replaces it. A rerun compares names with the
manifest and reads neither the stored series nor slices whose blocks are all listed.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gridloom.functions.sizing import small
from gridloom.sources.sinks import gathered

KEYS = ("var", "freq", "stream", "block")
MANIFEST = "_blocks"
ENTRY = "var string, freq string, stream string, block int, rows bigint, first_time int, last_time int, levels array<int>, last_cell bigint, commit bigint"


def entries(spark: SparkSession, path: str) -> DataFrame:
    """Everything that was ever written to the manifest; ``rows`` is NULL where a block was opened to be replaced."""
    try:
        return spark.read.schema(ENTRY).parquet(f"{path}/{MANIFEST}")
    except Exception as error:  # the reader's own error for a path that is not there
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], ENTRY)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """The last entry of every complete block: names, rows, first and last time, levels (NULL: it has none), greatest cell."""
    stored = entries(spark, path)
    last = F.max_by(F.struct(*[F.col(n) for n in stored.columns]), F.struct("commit", F.col("rows").isNotNull())).alias("e")
    return stored.groupBy(*KEYS).agg(last).select("e.*").filter(F.col("rows").isNotNull())


def open_blocks(spark: SparkSession, path: str, freq: str, stream: str, variables: Sequence[str], blocks: Iterable[int | None]) -> list[tuple[str, int | None]]:
    """(variable, block) of one stream that are not listed yet; as many rows come to the driver as the stream has blocks."""
    mine = manifest(spark, path).filter((F.col("freq") == freq) & (F.col("stream") == stream))
    done = {(r["var"], r["block"]) for r in mine.select("var", "block").collect()}
    return [(v, b) for v in variables for b in blocks if (v, b) not in done]


def store(spark: SparkSession, series: DataFrame, path: str, replaces: Column | None = None) -> DataFrame:
    """Write the blocks of ``series`` (KEYS, or all of them but block, time_idx, cell, value, maybe lev), each in place of what its
    folder has, and list them; the new entries. Listed blocks that ``replaces`` names are taken off the list first: if the job
    ends early they are open again."""
    keys = [k for k in KEYS if k in series.columns]
    earlier = entries(spark, path).agg(F.max("commit")).first()[0]
    commit = 0 if earlier is None else earlier + 1
    if replaces is not None and not (gone := manifest(spark, path).filter(replaces)).isEmpty():
        opened = gone.withColumns({"rows": F.lit(None).cast("bigint"), "commit": F.lit(commit).cast("bigint")})
        opened.coalesce(1).write.mode("append").parquet(f"{path}/{MANIFEST}")
    if series.isEmpty():
        return spark.createDataFrame([], ENTRY)
    # A column that is the same for all rows of a run, so that what was written now is known from the files themselves; and
    # the names of the blocks, seen while they are written.
    seen = Observation()
    named = series.withColumn("written", F.lit(commit)).observe(seen, F.collect_set(F.struct(*keys)).alias("keys"))
    spread = gathered(named, keys).sortWithinPartitions(*keys, "time_idx")
    spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)
    found = seen.get["keys"]
    back = spark.read.parquet(path)
    for i, k in enumerate(keys):  # only their folders are opened
        back = back.filter(F.col(k).isin(sorted({r[i] for r in found})))
    lev = F.col("lev") if "lev" in back.columns else F.lit(None)
    levels = F.sort_array(F.collect_set(lev.cast("int")))  # a variable has some hundred levels at most
    text = [F.col(k).cast("int" if k == "block" else "string").alias(k) for k in keys]
    stated = back.filter(F.col("written") == commit).groupBy(*text).agg(
        F.count("*").alias("rows"), F.min("time_idx").cast("int").alias("first_time"), F.max("time_idx").cast("int").alias("last_time"),
        F.when(F.size(levels) > 0, levels).alias("levels"), F.max("cell").cast("bigint").alias("last_cell"), F.lit(commit).cast("bigint").alias("commit"),
    )
    names = [x.split()[0] for x in ENTRY.split(", ")]
    listed = stated if "block" in keys else stated.withColumn("block", F.lit(None).cast("int"))
    listed.select(*names).coalesce(1).write.mode("append").parquet(f"{path}/{MANIFEST}")
    return manifest(spark, path).filter(F.col("commit") == commit)


def read_blocks(spark: SparkSession, path: str, variables: Sequence[str] | None = None, freq: str | None = None) -> DataFrame:
    """The rows of the listed blocks. Folders are pruned by the names asked for; files that are not listed fall out in a join with
    the manifest, which is broadcast when it measures small."""
    listed = manifest(spark, path)
    if variables is not None:
        listed = listed.filter(F.col("var").isin(list(variables)))
    if freq is not None:
        listed = listed.filter(F.col("freq") == freq)
    rows = spark.read.parquet(path)
    if variables is not None:
        rows = rows.filter(F.col("var").isin(list(variables)))
    keys = [k for k in KEYS if k in rows.columns]
    # Files of a commit that was not listed, or not yet, have another number than the entry.
    wanted = small(listed.select(*keys, F.col("commit").alias("written")).withColumn("written", F.col("written").cast("int")))
    return rows.join(wanted, [*keys, "written"], "left_semi").drop("written")


def shapes(spark: SparkSession, path: str, freq: str | None = None) -> DataFrame:
    """One row per variable: has_levels, levels, times and cells of its series, from the manifest alone."""
    listed = manifest(spark, path)
    listed = listed if freq is None else listed.filter(F.col("freq") == freq)
    levels = F.array_sort(F.array_distinct(F.flatten(F.collect_list("levels"))))  # one short list for each block
    return listed.groupBy("var").agg(
        F.max(F.col("levels").isNotNull()).alias("has_levels"), F.when(F.size(levels) > 0, levels).alias("levels"),
        F.min("first_time").alias("first_time"), F.max("last_time").alias("last_time"), F.max("last_cell").alias("last_cell"), F.sum("rows").alias("rows"),
    )
