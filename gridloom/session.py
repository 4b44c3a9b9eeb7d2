"""Session settings the library is written for. Every one is a public Spark setting and may be overridden."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Joins, partition numbers and hot keys are settled at run time from real sizes.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256m",
    # Tables in buckets of blocks of cells are joined by block and cell without an exchange.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # Larger splits: a field file is read by few columns, so a split holds much less than its size.
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
}


def session(app: str, master: str | None = None, **settings: str) -> SparkSession:
    """A session with these settings; keyword names use ``__`` for dots (``spark__driver__memory="8g"``)."""
    builder = SparkSession.builder.appName(app)
    builder = builder if master is None else builder.master(master)
    for key, value in (SETTINGS | {k.replace("__", "."): v for k, v in settings.items()}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
