"""Regridding with packed weights, joined by the layout that the field is stored in.

Beyond what may be broadcast, a weight table joined by cell would shuffle the field. Packed, it has one row per source cell: the
entries of all its maps. Field and packed weights are stored in buckets of the same block of neighbouring cells, so the join needs
no exchange, each task holds one bucket of weights, and partial sums still see neighbours together. What is exchanged are these
sums, once. The join is by block and cell while the buckets are by block alone, which Spark takes as co-located with
``spark.sql.requireAllClusterKeysForCoPartition=false`` (part of :mod:`gridloom.session`); without it results are the same.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions import fixed_values as fixed
from gridloom.functions.sizing import BROADCAST_BYTES, measured_bytes
from gridloom.operators.regrid import KEYS

#: Neighbouring cells in one block.
BLOCK = 4096


def block_of(cell: Column, size: int = BLOCK) -> Column:
    return F.floor(cell / F.lit(size)).cast("bigint")


def pack_weights(weights: DataFrame, size: int = BLOCK) -> DataFrame:
    """(block, cell, entries) from (map_id, src_cell, dst_cell, w): every map's destinations of a source cell, in order. A list is as long as
    the destination cells that a cell overlaps."""
    entry = F.struct("map_id", "dst_cell", "w")
    packed = weights.groupBy(F.col("src_cell").alias("cell")).agg(F.array_sort(F.collect_list(entry)).alias("entries"))
    return packed.select(block_of(F.col("cell"), size).alias("block"), "cell", "entries")


def buckets_for(packed: DataFrame, per_bucket: int = BROADCAST_BYTES) -> int:
    """Buckets that each hold at most some ``per_bucket`` bytes of packed weights: a power of two, so that tables of different size fit
    each other by merging buckets."""
    need = max(1, -(-measured_bytes(packed) // per_bucket))
    return 1 << (need - 1).bit_length()


def write_by_block(df: DataFrame, name: str, buckets: int, by: Sequence[str] = (), path: str | None = None, size: int = BLOCK) -> None:
    """Store a table with ``cell`` in buckets of blocks; ``by`` names folders (variable, frequency). One task writes a bucket, so a
    folder has as many files as there are buckets."""
    placed = df if "block" in df.columns else df.withColumn("block", block_of(F.col("cell"), size))
    writer = placed.repartition(buckets, "block").write.mode("overwrite").format("parquet").bucketBy(buckets, "block")
    writer = writer.partitionBy(*by) if by else writer
    (writer if path is None else writer.option("path", path)).saveAsTable(name)


def regrid_packed(field: DataFrame, packed: DataFrame, keys: Sequence[str] = KEYS, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Weighted mean over the source cells that have a value, for rows that name their map (``map_id``), as regrid_by_map gives.

    Packed weights up to ``limit`` bytes are broadcast; beyond, a field that was stored by block (and brings its ``block``, of the size
    that the weights were packed with) is joined by block and cell, without an exchange, and any other one by cell.
    """
    by = ["block", "cell"] if "block" in field.columns else ["cell"]
    side = F.broadcast(packed) if measured_bytes(packed) <= limit else packed.hint("shuffle_hash")
    mine = F.filter("entries", lambda e: e["map_id"] == F.col("map_id"))
    spread = field.join(side, by).select(*keys, "value", F.inline(mine).alias("_map", "_dst", "_w"))
    summed = spread.groupBy(*keys, F.col("_dst").alias("cell")).agg(
        F.sum(F.col("_w") * F.col("value")).alias("_num"), F.sum(F.when(F.col("value").isNotNull(), F.col("_w"))).alias("_den")
    )
    value = F.when(F.col("_den") >= fixed.VALID_WEIGHT_TOLERANCE, F.try_divide(F.col("_num"), F.col("_den").cast("double")))
    return summed.select(*keys, "cell", value.alias("value"))

