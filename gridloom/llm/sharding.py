"""Shards by a keyed permutation: each row's global number goes through a Feistel network with cycle walking.

Global numbers depend on the rows alone, not on files or partitions: rows fall into buckets by a hash of their keys, are
numbered by key in a bucket, and the buckets' totals, summed up, give each bucket its base. The permutation is a bijection
of 0..n-1, so position p goes to shard p mod k and slot p div k: counts differ by one at most, slots have no gap, and any
row's place can be computed from its number without a look at other rows.

Cases: nulls are keys like others; equal rows are counted first and numbered as a block, so copies without end do not meet
in one task; an empty table gives no rows; columns that are no keys are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from gridloom.llm.common import cut

ROUNDS = 6
#: Numbers of equal rows that are listed at once.
RUN = 65536


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: xor-shifts and odd multipliers, wrapping."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def permute(numbers: np.ndarray, n: int, seed: int) -> np.ndarray:
    """A permutation of 0..n-1 of the numbers given. The network works on the smallest even number of bits that holds n-1;
    what lands at n or above walks on through it until it is below n, which keeps it a bijection."""
    half = max(1, ((max(n - 1, 1)).bit_length() + 1) // 2)
    mask, bits = np.uint64((1 << half) - 1), np.uint64(half)
    with np.errstate(over="ignore"):
        keys = [mix(np.array([seed * 0x9E3779B9 + i], np.uint64))[0] for i in range(ROUNDS)]

        def once(x):
            left, right = x >> bits, x & mask
            for key in keys:
                left, right = right, left ^ (mix(right ^ key) & mask)
            return (left << bits) | right

        out = once(numbers.astype(np.uint64))
        while (far := out >= np.uint64(n)).any():
            out[far] = once(out[far])
    return out.astype(np.int64)


def numbered(rows: DataFrame, keys: list[str], per_bucket: int = 50_000) -> tuple[DataFrame, int]:
    """The keys of each row with a number from 0 without gaps, and the count of rows."""
    counted = cut(rows.groupBy(*keys).agg(F.count("*").alias("copies")))
    n = counted.agg(F.sum("copies")).first()[0] or 0
    buckets = max(256, -(-n // per_bucket))
    counted = counted.withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)))
    inside = Window.partitionBy("bucket").orderBy(*keys)
    counted = counted.withColumn("place", F.sum("copies").over(inside.rowsBetween(Window.unboundedPreceding, -1)))
    totals = counted.groupBy("bucket").agg(F.sum("copies").alias("total"))
    # One row for each bucket of some 50,000 rows.
    bases = totals.select("bucket", (F.sum("total").over(Window.orderBy("bucket")) - F.col("total")).alias("base"))
    first = F.col("base") + F.coalesce("place", F.lit(0))
    placed = counted.join(bases, "bucket").select(*keys, first.alias("first"), "copies")
    # Numbers of equal rows in runs of RUN, so no list is longer, however many copies a row has.
    runs = placed.select(*keys, "first", "copies", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("copies") - 1) / RUN))).alias("run"))
    start = F.col("first") + F.col("run") * RUN
    stop = F.least(start + (RUN - 1), F.col("first") + F.col("copies") - 1)
    return runs.select(*keys, F.explode(F.sequence(start, stop)).alias("number")), n


def shard_plan(rows: DataFrame, keys: list[str], shards: int, seed: int = 0) -> DataFrame:
    """The keys of every row, with number, position, shard and slot."""
    placed, n = numbered(rows.select(*keys), keys)
    schema = StructType([*placed.schema.fields, StructField("position", LongType())])

    def run(batches):
        for batch in batches:
            numbers = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(permute(numbers, n, seed))], names=[*batch.schema.names, "position"])

    moved = placed.mapInArrow(run, schema)
    position = F.col("position")
    return moved.select("*", F.pmod(position, F.lit(shards)).cast("int").alias("shard"), F.floor(position / shards).cast("bigint").alias("slot"))
