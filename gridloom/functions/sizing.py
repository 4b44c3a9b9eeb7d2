"""Broadcast a table only when its measured size allows it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 64 * 1024 * 1024


def _row_bytes(schema: T.StructType) -> Column:
    """Bytes of one row in a broadcast table: 8 per field, 32 for the row, and the length of what has an open one."""
    size = F.lit(8 * len(schema.fields) + 32).cast("long")
    for field in schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(column), F.lit(0))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            size = size + F.coalesce(F.octet_length(F.to_json(F.struct(column))), F.lit(0))
    return size


def measured_bytes(df: DataFrame) -> int:
    """Size of a table, summed over its rows (a distributed sum; one number comes back)."""
    return df.select(F.sum(_row_bytes(df.schema)).alias("b")).first()["b"] or 0


def small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Mark ``df`` for broadcasting if it measures at most ``limit`` bytes.

    Beyond the limit the table is returned as it is: the join then shuffles both sides on its key and adaptive
    execution splits keys that hold too many rows.
    """
    return F.broadcast(df) if measured_bytes(df) <= limit else df
