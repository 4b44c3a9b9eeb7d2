"""Concatenate and cut: documents become one stream of tokens, cut every ``window`` tokens.

Pass one tokenises each partition and keeps a running offset in it; the totals of the partitions, summed up in order, give
each partition its global offset. Pass two only cuts: a document that crosses a window's end leaves a boundary record (a
piece) on each side. Nothing is shuffled but one total for each partition, and long documents or hot sources cost nothing.

Cases: a null or empty text is its end token alone; equal and repeated rows are packed each by itself, also with null ids;
an empty table gives no rows; columns other than the id and the text are neither read nor returned.
"""

from __future__ import annotations

import re
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridloom.llm.common import Recent, arrow_type, as_array, cut, no_cycles

#: Distinct matches that a worker remembers in each of two generations.
MATCHES = 350_000
#: The pre-tokenizer's pattern, as it reads for lower-case texts of ASCII and Latin-1 characters.
LATIN = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ÿ]+|[0-9²³¹¼½¾]|[^\\t-\\r \x85\xa0a-zªµºß-öø-ÿ0-9²³¹¼½¾]+")


class WordTokens:
    """Ids of texts by a tokenizer whose tokens never span a match of its pattern, as those of whole texts.

    Each distinct match is encoded once. Matches are encoded many at a time, with spaces between; tokens that end a match
    mark where it stops. Lower case and composition are plain in ASCII and Latin-1; the library does all else itself.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True
        if self.whole.get_vocab_size() > 1 << 16:
            raise ValueError("ids are stored as 16-bit numbers")
        self.ends = np.zeros(max(self.whole.get_vocab_size(), 1 << 16), bool)
        for token, i in self.whole.get_vocab().items():
            self.ends[i] = token.endswith("</w>")
        self.matches = Recent(MATCHES)

    def learn(self, matches: list[str]) -> None:
        known = self.matches.young
        for start in range(0, len(matches), 2000):
            group = matches[start : start + 2000]
            ids = np.array(self.whole.encode_batch_fast([" ".join(group)], add_special_tokens=False)[0].ids, "<u2")
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) != len(group):
                raise ValueError("a match of the pre-tokenizer has no end token")
            data, at = ids.tobytes(), 0
            for match, stop in zip(group, stops.tolist(), strict=True):
                known[match] = data[2 * at : 2 * stop]
                at = stop

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 16-bit ids of each text."""
        with no_cycles():
            found = [LATIN.findall(text.lower()) if is_latin(text) else None for text in texts]
            self.learn(self.matches.lacking(set().union(*(x for x in found if x))))
            known = self.matches.young.__getitem__
            return [b"".join(map(known, x)) if x is not None else self.by_library(text) for text, x in zip(texts, found, strict=True)]

    def by_library(self, text: str) -> bytes:
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u2").tobytes()


def is_latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


@cache
def word_tokens(path: str) -> WordTokens:
    return WordTokens(path)


def tokenised(docs: DataFrame, path: str, end: int, id_col: str, text_col: str) -> DataFrame:
    """doc_id, ids (binary, without the end token added yet), doc_tokens with it, part, and place: tokens before it in part."""
    import zstandard

    schema = "doc_id bigint, ids binary, doc_tokens bigint, part int, place bigint"
    kinds = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()), ("part", pa.int32()), ("place", pa.int64())])
    tail = np.array([end], "<u2").tobytes()

    def run(batches):
        tokens, pack = word_tokens(path), zstandard.ZstdCompressor(level=1)
        part, place = TaskContext.get().partitionId(), 0
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                some = batch.slice(start, 512)
                ids = [x + tail for x in tokens.encode(some.column(1).cast(pa.string()).to_pylist())]
                sizes = np.array([len(x) // 2 for x in ids], np.int64)
                places = place + np.cumsum(sizes) - sizes
                place += int(sizes.sum())
                small = [pack.compress(x) for x in ids]
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(small, pa.binary()), pa.array(sizes), pa.array(np.full(len(ids), part, np.int32)), pa.array(places)], schema=kinds)

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).mapInArrow(run, schema)


def pack(docs: DataFrame, path: str, window: int = 2048, end: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces: doc_id, start, length, ids (binary, little-endian unsigned 32-bit), doc_tokens, sequence_id, offset."""
    import zstandard

    rows = cut(tokenised(docs, path, end, id_col, text_col))
    totals = rows.groupBy("part").agg(F.sum("doc_tokens").alias("total"))
    # One row for each partition of the input; its size follows from the number of partitions, not from their rows.
    before = totals.select("part", (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("base"))
    placed = rows.join(F.broadcast(before), "part").select("doc_id", "ids", "doc_tokens", (F.col("base") + F.col("place")).alias("at"))
    schema = "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"
    kinds = [arrow_type(x) for x in ("bigint", "bigint", "bigint", "binary", "bigint", "bigint", "bigint")]
    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]

    def cut_up(batches):
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for first in range(0, batch.num_rows, 512):
                out: list[list] = [[] for _ in names]
                some = batch.slice(first, 512)
                for doc, packed, n, at in zip(*(some.column(i).to_pylist() for i in range(4)), strict=True):
                    ids = np.frombuffer(unpack.decompress(packed), "<u2").astype("<u4").tobytes()
                    start = 0
                    while start < n:
                        sequence, offset = divmod(at + start, window)
                        length = min(window - offset, n - start)
                        for column, value in zip(out, (doc, start, length, ids[4 * start : 4 * (start + length)], n, sequence, offset), strict=True):
                            column.append(value)
                        start += length
                yield pa.RecordBatch.from_arrays([as_array(c, k) for c, k in zip(out, kinds, strict=True)], names=names)

    return placed.mapInArrow(cut_up, schema)


def sequences(pieces: DataFrame, window: int = 2048, pad: int = 0) -> DataFrame:
    """The sequences themselves: sequence_id, ids (binary), n_tokens, n_padding. Only the last is padded. A sequence has at
    most ``window`` pieces, which bounds what a group gathers."""
    filled = F.array_sort(F.collect_list(F.struct("offset", "ids", "length")))
    made = pieces.groupBy("sequence_id").agg(filled.alias("parts"))
    made = made.withColumn("n_tokens", F.aggregate("parts", F.lit(0).cast("bigint"), lambda n, p: n + p["length"]))
    hexed = F.array_join(F.transform("parts", lambda p: F.hex(p["ids"])), "")
    padding = np.array([pad], "<u4").tobytes().hex()
    lacks = (F.lit(window) - F.col("n_tokens")).cast("int")
    return made.select("sequence_id", F.unhex(F.concat(hexed, F.repeat(F.lit(padding), lacks))).alias("ids"), "n_tokens", lacks.alias("n_padding"))
