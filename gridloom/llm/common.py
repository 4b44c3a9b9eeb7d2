"""Helpers that the text operators share: checkpoints, Arrow batches, safe names, text columns."""

from __future__ import annotations

import gc
import shutil
import tempfile
import zlib
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space: space and U+0009 to U+000D.
SPACES = b" \t\n\x0b\x0c\r"
#: Spark's setting (4.1 on) that a query's shuffle files go when the query ends.
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def checkpoint_folder(master: str, configured: str | None) -> str:
    """The session's ``spark.checkpoint.dir``. One of this machine is made only where all tasks run on it (``local[...]``)."""
    if configured:
        return configured
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return tempfile.mkdtemp(prefix="spark-")


def cut(df: DataFrame) -> DataFrame:
    """Write df to the shared checkpoint folder and go on from there: no recomputation, no lineage, and rows that stay as
    they are when an executor is lost. Spark removes the files once nothing refers to them, if the session sets
    ``spark.cleaner.referenceTracking.cleanCheckpoints``; else whoever owns the folder does.

    Nothing reads the shuffles behind a checkpoint again, so their files go at once; else executors would keep those of all
    earlier steps until the driver happens to collect its garbage. The session's setting is as before afterwards."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(checkpoint_folder(context.master, df.sparkSession.conf.get("spark.checkpoint.dir", None)))
    conf = df.sparkSession.conf
    before = conf.get(RELEASE, None)
    conf.set(RELEASE, "true")
    try:
        # The setting holds for frames made under it; df itself may be used again by others.
        return df.select("*").checkpoint()
    finally:
        if before is None:
            conf.unset(RELEASE)
        else:
            conf.set(RELEASE, before)


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once a session's context, for clusters that do not have it installed."""
    context = spark.sparkContext
    if getattr(context, "_shipped_package", False):
        return
    root = Path(__file__).resolve().parents[1]
    if root.parent.is_dir():  # not when it already runs from an archive
        made = shutil.make_archive(f"{tempfile.mkdtemp(prefix='spark-')}/{root.name}", "zip", root.parent, root.name)
        context.addPyFile(made)
    context._shipped_package = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_text(name: str = "text") -> Column:
    """The UTF-8 bytes of a text; null counts as empty."""
    return F.coalesce(F.col(name), F.lit("")).cast("binary")


def as_array(values, kind: pa.DataType) -> pa.Array:
    return values if isinstance(values, pa.Array) and values.type == kind else pa.array(values, kind)


def arrow_type(name: str) -> pa.DataType:
    if name.startswith("array<"):
        return pa.list_(arrow_type(name[6:-1]))
    plain = {"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()}
    return plain[name]


def slices(batch: pa.RecordBatch, column: str, most: int = 1 << 23) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``most`` bytes in the column each; a longer single value is a part of its own."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start = total = 0
    for i, n in enumerate(sizes):
        if total and total + n > most:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += int(n)
    if start < batch.num_rows:
        yield batch.slice(start)


def crc_of(name: str) -> Column:
    """crc32 of an id as text, for folds; a null id has the text ''."""
    return F.crc32(F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary"))


def crc(data: bytes) -> int:
    return zlib.crc32(data)


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that df does not have in any spelling."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


class Recent:
    """A table of what a worker has worked out, in two generations: once the younger is full it becomes the older, and
    what is asked for again comes back from there. Only memory depends on the limit, never a result."""

    def __init__(self, limit: int):
        self.limit = limit
        self.young: dict = {}
        self.old: dict = {}

    def lacking(self, keys: set) -> list:
        """The keys to be worked out, so that the younger generation has all of ``keys`` afterwards."""
        if len(self.young) > self.limit:
            self.old, self.young = self.young, {}
        unknown, old, young = [], self.old, self.young
        for key in keys.difference(young):
            if (known := old.get(key)) is None:
                unknown.append(key)
            else:
                young[key] = known
        return unknown


@contextmanager
def no_cycles():
    """Many small objects and no cycles among them: the cycle collector would only walk over them again and again."""
    gc.disable()
    try:
        yield
    finally:
        gc.enable()
