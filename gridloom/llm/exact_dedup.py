"""Exact duplicates by digest, with frequent digests split off.

Texts are equal when their digests are: SHA-256 of the text without ASCII white space. Misra-Gries summaries of the
partitions, added up, name every digest that may hold over 2/k of the rows; there are at most k, and one exact pass over
them finds their winners, which are broadcast. Rows with such a digest are decided where they are; the other digests go
through an ordinary grouping and join by digest.

Cases: null counts as empty text, and empty texts equal each other; the longest original text wins, then the smallest id
(null ids come last), then one row among rows repeated whole; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import cut, free_name, raw_text

#: Counters in a summary: a digest with more than 2/COUNTERS of all rows is split off.
COUNTERS = 1000


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, digest (32 bytes), points: code points of the original text."""
    kinds = pa.schema([("doc_id", pa.int64()), ("digest", pa.binary()), ("points", pa.int64())])

    def run(batches):
        for batch in batches:
            hashed, points = [], []
            for raw in batch.column(1).to_pylist():
                # split() of bytes parts at exactly U+0020 and U+0009 to U+000D.
                hashed.append(hashlib.sha256(b"".join(raw.split())).digest())
                points.append(len(raw.decode("utf-8", "replace")))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(hashed, pa.binary()), pa.array(points, pa.int64())], schema=kinds)

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), raw_text(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, digest binary, points bigint")


def summary(counts: dict[bytes, int], k: int) -> dict[bytes, int]:
    """Misra-Gries: back to k counters by taking the (k+1)-th largest count off all of them."""
    if len(counts) <= k:
        return counts
    off = int(np.partition(np.fromiter(counts.values(), np.int64, len(counts)), len(counts) - k - 1)[len(counts) - k - 1])
    return {key: n - off for key, n in counts.items() if n > off}


def frequent(rows: DataFrame, n: int, k: int = COUNTERS) -> DataFrame:
    """Digests that may be frequent, k at most. A partition's summary counts a digest too low by 1/(k+1) of its rows at
    most; so the sum over partitions keeps at least n/k for every digest with 2n/k rows, and at most k digests reach that."""
    kinds = pa.schema([("digest", pa.binary()), ("seen", pa.int64())])

    def run(batches):
        counts: dict[bytes, int] = {}
        for batch in batches:
            for pair in batch.column(0).value_counts():
                key = pair["values"].as_py()
                counts[key] = counts.get(key, 0) + pair["counts"].as_py()
            counts = summary(counts, k)
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], schema=kinds)

    seen = rows.select("digest").mapInArrow(run, "digest binary, seen bigint")
    return seen.groupBy("digest").agg(F.sum("seen").alias("seen")).filter((F.col("seen") >= n / k) & (F.col("seen") > 1)).select("digest")


def winners(rows: DataFrame) -> DataFrame:
    """digest, group_size, and the id and row of the one that stays."""
    best = F.min(F.struct((-F.col("points")).alias("a"), F.col("doc_id").isNull().alias("b"), F.col("doc_id").alias("keep_id"), F.col("row").alias("keep_row")))
    return rows.groupBy("digest").agg(F.count("*").alias("group_size"), best.alias("best")).select("digest", "group_size", "best.keep_id", "best.keep_row")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = COUNTERS) -> DataFrame:
    """Every row: doc_id, digest, points, keep_id, group_size, kept."""
    rows = cut(digests(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id()))
    n = rows.count()
    heavy = cut(frequent(rows, n, k))  # k rows at most
    won = F.broadcast(cut(winners(rows.join(F.broadcast(heavy), "digest", "left_semi"))))  # k rows at most
    held = rows.join(won, "digest")
    rest = rows.join(F.broadcast(heavy), "digest", "left_anti")
    held = held.unionByName(rest.join(winners(rest), "digest"))
    return held.select("doc_id", "digest", "points", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = COUNTERS) -> DataFrame:
    """The rows of docs that stay, with all their columns. Rows of one id and one text are one document here: one stays."""
    other, mark, times = (free_name(docs, n) for n in ("_other_id", "_digest", "_times"))
    kept = exact_groups(docs, id_col, text_col, k).filter("kept").select(F.col("doc_id").alias(other), "digest")
    kept = kept.withColumnRenamed("digest", f"{mark}_kept")
    repeats = docs.groupBy(id_col).agg(F.count("*").alias(times)).filter(F.col(times) > 1).select(F.col(id_col).alias(other))
    same = F.col(id_col).eqNullSafe(F.col(other))
    once = docs.filter(F.col(id_col).isNotNull()).join(repeats, same, "left_anti").join(kept, F.col(id_col) == F.col(other), "left_semi")
    # Ids that come more than once, and rows without one, are told apart by their texts' digests, too.
    twice = docs.join(repeats, same, "left_semi").unionByName(docs.filter(F.col(id_col).isNull()).join(repeats, same, "left_anti"))
    plain = F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), r"[\x20\x09-\x0D]", "").cast("binary")
    hashed = twice.withColumn(mark, F.unhex(F.sha2(plain, 256)))
    some = hashed.join(kept, same & (F.col(mark) == F.col(f"{mark}_kept")), "left_semi").dropDuplicates([id_col, mark]).drop(mark)
    return once.unionByName(some)
