"""Series from slice files as they arrive, block by block, and their monthly means once a month is complete.

Event time is a clock of months: month n of a calendar is hour n, so that a window of one hour is one month in every
calendar, however many days it has, and a watermark of two hours waits for two months.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gridloom.functions.calendar import year_block
from gridloom.functions.sizing import small
from gridloom.operators.series import slices_to_series


def stream_slices(spark: SparkSession, path: str, dims: Sequence[str], variables: Sequence[str], schema: str | None = None) -> DataFrame:
    """Streaming read of wide slice files as long series rows."""
    declared = schema or spark.read.parquet(path).schema
    return slices_to_series(spark.readStream.schema(declared).parquet(path), dims, variables)


def append_series(
    series: DataFrame, out: str, checkpoint: str, first_year: int, step: int, year: str = "cast(floor(time_idx / 12) as int)"
) -> StreamingQuery:
    """Append arriving rows to the series table by variable and block of years; runs until all files are taken."""
    blocked = series.withColumn("block", year_block(F.expr(year), first_year, step))
    writer = blocked.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
    return writer.partitionBy("var", "block").outputMode("append").trigger(availableNow=True).start()


def monthly_means(series: DataFrame, month: Column, wait: int, keys: Sequence[str] = ("var", "cell")) -> DataFrame:
    """(keys, month, value, n): mean and number of rows of each month, from a stream, when no row of it is expected any more.

    ``month`` counts months from 0. A month goes out once rows more than ``wait`` months younger than its end have come;
    until then its slices may come in any order, and one sum and two counts a key are all the state there is. Rows that
    come later still are left out here, and ``amended_means`` takes them in from the stored series. Missing values count in
    ``n``, not in the mean; rows without a month belong to none.
    """
    clock = series.withColumn("_clock", F.timestamp_seconds(month.cast("bigint") * 3600)).withWatermark("_clock", f"{wait} hours")
    means = clock.groupBy(F.window("_clock", "1 hour").alias("_w"), *keys).agg(F.avg("value").alias("value"), F.count(F.lit(1)).alias("n"))
    number = (F.unix_seconds(F.col("_w.start")) / 3600).cast("int")
    return means.select(*keys, number.alias("month"), "value", "n").filter("month IS NOT NULL")


def append_means(means: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Append complete months to a table by variable; runs until all files are taken."""
    writer = means.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
    return writer.partitionBy("var").outputMode("append").trigger(availableNow=True).start()


def amended_means(means: DataFrame, series: DataFrame, month: Column, keys: Sequence[str] = ("var", "cell")) -> DataFrame:
    """The months of ``means`` with all rows that the stored ``series`` has for them: (keys, month, value, n, late).

    Months are compared by number of rows, which sums up before any shuffle; where they agree the streamed mean stays, where
    late slices were left out (``late`` of them) the stored rows decide. Keys of a month that were late altogether are
    added; months that have not gone out yet are not.
    """
    known = [*keys, "month"]
    stored = series.withColumn("month", month.cast("int")).groupBy(*known).agg(F.avg("value").alias("_value"), F.count(F.lit(1)).alias("_n"))
    gone_out = small(means.select(F.col("month").alias("_gone")).distinct())
    whole = stored.join(gone_out, F.col("month") == F.col("_gone"), "left_semi")
    late = F.col("_n") - F.coalesce("n", F.lit(0))
    value = F.when(late > 0, F.col("_value")).otherwise(F.col("value"))
    return whole.join(means.select(*known, "value", "n"), known, "left").select(*known, value.alias("value"), F.col("_n").alias("n"), late.alias("late"))
