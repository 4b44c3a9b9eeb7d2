"""Alignment of two tokenizers over a corpus, by byte offsets, as an Arrow pipeline.

Both tokenizers cut the same bytes, a space and the text. Per batch of documents: the lists of ids are flattened and carry
their parent indices; cumulative sums of token lengths, less what their document began at, give the byte offset at which
each token ends; an Acero hash join of both tables on (document, end) finds the offsets where both end, which part a document into
groups. The outer join in order of its keys is at the same time the list of all overlaps: each stretch between two ends lies
in one token of A and one of B, the next ones to end. ``Table.group_by`` counts how often a document holds an id pair and in
how many documents of a task it is held; Spark adds the tasks' counts up.

The counts go back to the documents by pair: a task's documents are written as blocks, one for each of ``BUCKETS`` hash
buckets of pairs, compressed; blocks meet their bucket's counts, and only sums by document and bucket return. A bucket holds
1/64 of the pairs that the two vocabularies allow at most, and its blocks are dealt to as many tasks as their size asks for,
so a frequent pair costs no more than one entry a document.

Cases: null and empty texts, and texts whose tokens do not give the bytes back (such as those with U+2581), have no tokens:
all counts are 0 and the group text is ''. Repeated rows and ids, null ids too, are aligned each by itself, and count as
documents each. Long texts are tokenised whole, one at a time. Other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from functools import cache
from itertools import accumulate, chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import cut, no_cycles, raw_text, slices

#: Hash buckets of id pairs.
BUCKETS = 64
#: Bytes of text that are aligned at once, and that one set of blocks holds, about.
BATCH, CHUNK = 1 << 20, 1 << 23
#: Most documents in one set of blocks (they are numbered by 16 bits).
CHUNK_ROWS = 60_000
#: Distinct pairs that a task counts before it hands them on.
PARTIAL = 4_000_000
#: Distinct pieces of text that a worker remembers before it begins anew; only time depends on it.
WORDS = 800_000
#: Bytes of blocks that one task looks up, about.
PER_TASK = 1 << 26
#: The pattern that splits text before the merges of A.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: White space among the first 256 characters, and a run of it with the run of other characters behind it.
BLANKS = "\t\n\x0b\x0c\r \x85\xa0"
STRETCH = re.compile(f"[{BLANKS}]*[^{BLANKS}]+|[{BLANKS}]+")
MARK = "▁"
ODD = np.uint32(0x9E3779B1)


def byte_level() -> dict[str, int]:
    """The character that stands for each byte: printable ones for themselves, the others from U+0100 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Pair:
    """Two tokenizers: A, byte-level merges, on a space and the text; B, sentence pieces, on the text.

    No token of A, and none of B but for some characters, goes on from other characters into white space, so a text may be
    cut in front of each run of white space. Where all characters are below U+0100, such stretches are encoded once and
    remembered; texts with other characters, or with white space that B joins to what is before it, are encoded whole.
    """

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        import tiktoken

        with open(path_a, encoding="utf-8") as file:
            described = json.load(file)
        special = {x["content"] for x in described["added_tokens"]}
        chars = byte_level()
        vocab = {bytes(chars[c] for c in token): i for token, i in described["model"]["vocab"].items() if token not in special}
        self.a = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=vocab, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        size = self.b.get_piece_size()
        if max(max(vocab.values()) + 1, size) > 1 << 16:
            raise ValueError("ids are stored as 16-bit numbers")
        names = [self.b.id_to_piece(i) for i in range(size)]
        self.bytes_a = pa.array([t for _, t in sorted((i, t) for t, i in vocab.items())], pa.binary())
        if sorted(vocab.values()) != list(range(len(vocab))):
            raise ValueError("ids of A have gaps")
        self.bytes_b = pa.array([piece_bytes(n, self.b.is_byte(i)) for i, n in enumerate(names)], pa.binary())
        self.mark = self.b.piece_to_id(MARK)
        merged = [n for i, n in enumerate(names) if len(n) > 1 and not (self.b.is_control(i) or self.b.is_byte(i))]
        if any(re.search(f"[^{MARK}]{MARK}", n) for n in merged):
            raise ValueError("a piece of B goes on into the next word")
        #: White space that pieces of B join to other characters: texts that have it are not cut up.
        self.joining = {c for n in merged for c in n if c in BLANKS}
        self.places: dict[str, int] = {}
        self.forget()

    def forget(self) -> None:
        self.places.clear()
        self.flat, self.offsets = (array("H"), array("H")), (array("q", [0]), array("q", [0]))

    def learn(self, stretches: list[str]) -> None:
        # B puts a mark in front of what it gets; in front of white space other than a space that mark is a token by itself.
        given = self.b.encode([s[1:] if s[0] == " " else s for s in stretches], num_threads=1)
        given = [ids[1:] if s[0] != " " else ids or [self.mark] for s, ids in zip(stretches, given, strict=True)]
        self.places.update(zip(stretches, range(len(self.places), len(self.places) + len(stretches)), strict=True))
        for side, ids in enumerate(([self.a.encode_ordinary(s) for s in stretches], given)):
            self.flat[side].extend(chain.from_iterable(ids))
            self.offsets[side].extend(accumulate(map(len, ids), initial=self.offsets[side].pop()))

    def encode(self, spaced: list[str]) -> tuple[pa.ListArray, pa.ListArray]:
        """Ids by A and by B of texts that begin with the space put in front."""
        with no_cycles():
            found = [STRETCH.findall(s) if is_latin(s) and self.joining.isdisjoint(s) else None for s in spaced]
            parts = [x for y in found if y for x in y]
            if len(self.places) > WORDS:
                self.forget()
            self.learn(list(set(parts).difference(self.places)))
            places = np.fromiter(map(self.places.__getitem__, parts), np.int64, len(parts))
        count = np.array([len(x) if x else 0 for x in found], np.int64)
        out = []
        for side, whole in enumerate((self.a.encode_ordinary, lambda s: self.b.encode(s[1:], num_threads=1))):
            flat, offsets = np.array(self.flat[side]), np.array(self.offsets[side])
            first, size = offsets[places], np.diff(offsets)[places]
            until = np.concatenate([[0], np.cumsum(size)])
            ids = flat[np.arange(until[-1]) + np.repeat(first - until[:-1], size)]
            edges = until[np.concatenate([[0], np.cumsum(count)])]
            if None in found:
                texts = [ids[lo:hi] if x is not None else np.array(whole(s), np.uint16) for s, x, lo, hi in zip(spaced, found, edges, edges[1:], strict=False)]
                ids, edges = np.concatenate(texts), np.cumsum([0, *map(len, texts)])
            out.append(pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(ids)))
        return out[0], out[1]


def piece_bytes(name: str, is_byte: bool) -> bytes:
    return bytes([int(name[3:-1], 16)]) if is_byte else name.replace(MARK, " ").encode()


def is_latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


@cache
def tokenizers(path_a: str, path_b: str) -> Pair:
    return Pair(path_a, path_b)


@cache
def decimals() -> pa.Array:
    """Decimal ids followed by a comma, a bar, a semicolon or nothing."""
    return pa.array([f"{i}{mark}" for mark in (",", "|", ";", "") for i in range(1 << 16)], pa.string())


class Aligned(NamedTuple):
    """Of a batch: by document n_a, n_b, n_groups, n_links (numpy) and groups (text); (doc, pair, n) of every id pair in a document."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    groups: pa.Array
    pairs: pa.Table


def joined(ids: pa.ListArray, table: pa.Array) -> pa.Array:
    """The bytes of each document's tokens."""
    return pc.binary_join(pa.ListArray.from_arrays(ids.offsets, table.take(ids.values)), pa.scalar(b"", pa.binary()))


def ends(ids: pa.ListArray, sizes: pa.Array, name: str) -> tuple[pa.Table, np.ndarray]:
    """(key, number) of every token, key: document and the byte of it at which the token ends; and the tokens' ids."""
    flat, parent = pc.list_flatten(ids), pc.list_parent_indices(ids)
    total = pc.cumulative_sum(sizes.take(flat))
    # Segmented: less the sum that was reached at the end of the document before.
    reached = np.concatenate([[0], total.to_numpy()])[ids.offsets.to_numpy()[:-1]]
    end = pc.subtract(total, pa.array(reached).take(parent))
    key = pc.add(pc.shift_left(pc.cast(parent, pa.int64()), pa.scalar(40, pa.int64())), end)
    return pa.table({"key": key, name: pa.array(np.arange(len(flat), dtype=np.int32))}), flat.to_numpy()


def align(spaced: pa.Array, a: pa.ListArray, b: pa.ListArray, bytes_a: pa.Array, bytes_b: pa.Array) -> Aligned:
    """Groups and links of documents whose ids are given; ``spaced`` are the bytes that both must give back."""
    count = len(spaced)
    good = pc.and_(pc.equal(joined(a, bytes_a), spaced), pc.equal(joined(b, bytes_b), spaced))
    good = pc.and_(good, pc.greater(pc.binary_length(spaced), 1)).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(good)
    if len(rows) < count:
        a, b = a.take(pa.array(rows)), b.take(pa.array(rows))
    size = lambda table: pc.cast(pc.binary_length(table), pa.int64())
    (left, flat_a), (right, flat_b) = ends(a, size(bytes_a), "i"), ends(b, size(bytes_b), "j")
    both = left.join(right, "key", join_type="full outer", use_threads=False)
    both = both.take(pa.array(np.argsort(both.column("key").to_numpy())))
    i, j = both.column("i").combine_chunks(), both.column("j").combine_chunks()
    ends_a, ends_b = (~np.asarray(x.is_null()) for x in (i, j))
    doc = both.column("key").to_numpy() >> 40
    common = ends_a & ends_b
    before = np.cumsum(common) - common  # groups that have ended before this stretch
    to_numpy = lambda x: pc.fill_null_backward(x).to_numpy(zero_copy_only=False)
    link = flat_a[to_numpy(i)].astype(np.uint32) << np.uint32(16) | flat_b[to_numpy(j)] if len(doc) else np.zeros(0, np.uint32)
    pairs = pa.table({"doc": pa.array(rows[doc].astype(np.int32)), "pair": pa.array(link)}).group_by(["doc", "pair"], use_threads=False).aggregate([([], "count_all")])

    # Text of the groups: tokens of A and B take turns by group.
    per_doc = lambda mark: np.bincount(doc[mark], minlength=len(rows))
    n_a, n_b, n_groups = per_doc(ends_a), per_doc(ends_b), per_doc(common)
    group_a, group_b = before[ends_a], before[ends_b]
    groups = int(common.sum())
    until_a, until_b = (np.concatenate([[0], np.cumsum(np.bincount(g, minlength=groups))]) for g in (group_a, group_b))
    code = np.empty(len(group_a) + len(group_b), np.int32)
    code[np.arange(len(group_a)) + until_b[group_a]] = flat_a + (common[ends_a].astype(np.int32) << 16)
    last = np.zeros(len(group_b), bool)
    last[np.cumsum(n_b)[n_b > 0] - 1] = True
    code[np.arange(len(group_b)) + until_a[group_b + 1]] = flat_b + (np.where(last, 3, np.where(common[ends_b], 2, 0)).astype(np.int32) << 16)
    offsets = np.zeros(count + 1, np.int32)
    offsets[rows + 1] = n_a + n_b
    text = pc.binary_join(pa.ListArray.from_arrays(pa.array(np.cumsum(offsets, dtype=np.int32)), decimals().take(pa.array(code))), "")

    def spread(found: np.ndarray) -> np.ndarray:
        out = np.zeros(count, np.int64)
        out[rows] = found
        return out

    return Aligned(spread(n_a), spread(n_b), spread(n_groups), spread(np.bincount(doc, minlength=len(rows))), text, pairs.rename_columns(["doc", "pair", "n"]))


def planes(values: np.ndarray) -> bytes:
    """The first bytes of all numbers, then the second ones, and so on: easier to compress."""
    return np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def from_planes(data: memoryview, kind: str, n: int) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data[: n * size], np.uint8).reshape(size, n).T).view(kind).reshape(n)


def bucket_of(pairs: np.ndarray) -> np.ndarray:
    return ((pairs * ODD) >> np.uint32(32 - BUCKETS.bit_length() + 1)).astype(np.int64)


def blocks(doc: np.ndarray, pair: np.ndarray, n: np.ndarray):
    """(bucket, bytes) of a chunk's entries, and (pair, documents) of the chunk; entries by bucket, pair, document."""
    import zstandard

    pack = zstandard.ZstdCompressor(level=3)
    order = np.lexsort((doc, pair, bucket_of(pair)))
    doc, pair, n = doc[order].astype("<u2"), pair[order], n[order].astype("<u4")
    starts = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]])) if len(pair) else np.zeros(0, np.int64)
    distinct, held = pair[starts], np.diff(np.append(starts, len(pair)))
    bucket = bucket_of(distinct)
    made, edges = [], np.searchsorted(bucket, np.arange(BUCKETS + 1))
    for k, (lo, hi) in enumerate(zip(edges, edges[1:], strict=False)):
        if hi > lo:
            first, stop = starts[lo], starts[hi] if hi < len(starts) else len(pair)
            step = doc[first:stop].copy()
            step[1:] -= doc[first : stop - 1]
            body = planes(np.diff(distinct[lo:hi], prepend=np.uint32(0)).astype("<u4")) + planes(held[lo:hi].astype("<u2")) + planes(step) + planes(n[first:stop])
            made.append((k, np.array([hi - lo, stop - first], "<i8").tobytes() + pack.compress(body)))
    return made, pa.table({"pair": pa.array(distinct.astype(np.int64)), "n": pa.array(held.astype(np.int64))})


def unpacked(block: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs in order, in how many documents of the chunk each is; documents and numbers of links, pair by pair."""
    import zstandard

    pairs, entries = np.frombuffer(block[:16], "<i8").tolist()
    body = memoryview(zstandard.ZstdDecompressor().decompress(block[16:]))
    distinct = np.cumsum(from_planes(body, "<u4", pairs), dtype=np.uint32)
    held = from_planes(body[4 * pairs :], "<u2", pairs)
    doc = np.cumsum(from_planes(body[6 * pairs :], "<u2", entries), dtype=np.uint16)
    return distinct, held, doc, from_planes(body[6 * pairs + 2 * entries :], "<u4", entries)


#: One table for three kinds of rows: 0 documents (number, doc_id, n_a, n_b, n_groups, n_links, groups), 1 blocks
#: (number: bucket, data), 2 counts of a task (number: pair, chunk: its bucket, n_a: documents).
ROWS = "kind int, chunk bigint, number bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, data binary"
KINDS = pa.schema([("kind", pa.int32()), *((x, pa.int64()) for x in ("chunk", "number", "doc_id", "n_a", "n_b", "n_groups", "n_links")), ("groups", pa.string()), ("data", pa.binary())])


def rows_of(n: int, **columns) -> pa.RecordBatch:
    made = [pa.array(columns[f.name], f.type) if f.name in columns and not isinstance(columns[f.name], pa.Array) else columns.get(f.name, pa.nulls(n, f.type)) for f in KINDS]
    return pa.RecordBatch.from_arrays(made, schema=KINDS)


def aligned(docs: DataFrame, path_a: str, path_b: str, digest: bool, id_col: str, text_col: str) -> DataFrame:
    """Rows of ROWS; one set of blocks for some 8 MB of text. A document's number in its chunk and the chunk's blocks come from one task."""

    def run(batches):
        pair, part, counter = tokenizers(path_a, path_b), TaskContext.get().partitionId(), 0
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size = number = 0
        counts = pa.table({"pair": pa.array([], pa.int64()), "n": pa.array([], pa.int64())})

        def flush():
            nonlocal counts, held, size, number, counter
            if held:
                made, fresh = blocks(*(np.concatenate(x) for x in zip(*held, strict=True)))
                chunk = part << 32 | counter
                for k in range(0, len(made), 16):
                    some = made[k : k + 16]
                    yield rows_of(len(some), kind=[1] * len(some), chunk=[chunk] * len(some), number=[b for b, _ in some], data=[d for _, d in some])
                counts = pa.concat_tables([counts, fresh]).group_by("pair", use_threads=False).aggregate([("n", "sum")]).rename_columns(["pair", "n"])
            held, size, number, counter = [], 0, 0, counter + 1

        def hand_on():
            nonlocal counts
            for some in counts.to_batches(1 << 16):
                bucket = bucket_of(some.column("pair").to_numpy().astype(np.uint32))
                yield rows_of(some.num_rows, kind=[2] * some.num_rows, chunk=bucket, number=some.column("pair"), n_a=some.column("n"))
            counts = counts.slice(0, 0)

        for batch in batches:
            for some in slices(batch, "text", BATCH):
                texts = [" " + t.decode() for t in some.column(1).to_pylist()]
                a, b = pair.encode(texts)
                found = align(pa.array(texts).cast(pa.binary()), a, b, pair.bytes_a, pair.bytes_b)
                n = len(texts)
                groups = found.groups
                if digest:
                    groups = pa.array([hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups.to_pylist()])
                numbers = np.arange(number, number + n)
                yield rows_of(n, kind=[0] * n, chunk=[part << 32 | counter] * n, number=numbers, doc_id=some.column(0), n_a=found.n_a, n_b=found.n_b, n_groups=found.n_groups, n_links=found.n_links, groups=groups)
                doc, ids, times = (c.to_numpy() for c in found.pairs.columns)
                held.append((doc + number, ids, times))
                number, size = number + n, size + sum(map(len, texts))
                if size >= CHUNK or number + 10_000 > CHUNK_ROWS:
                    yield from flush()
                    if counts.num_rows > PARTIAL:
                        yield from hand_on()
        yield from flush()
        yield from hand_on()

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), raw_text(text_col).alias("text")).mapInArrow(run, ROWS)


def pair_counts(rows: DataFrame) -> DataFrame:
    """(bucket, pair, a, b, n, best): in how many documents an id pair is linked, and whether no other pair of that A id is in more."""
    counts = rows.filter("kind = 2").groupBy(F.col("chunk").alias("bucket"), F.col("number").alias("pair")).agg(F.sum("n_a").alias("n"))
    counts = counts.select("bucket", "pair", F.shiftright("pair", 16).alias("a"), F.col("pair").bitwiseAND(0xFFFF).alias("b"), "n")
    # At most one row for each id of A's vocabulary, 65,536.
    highest = counts.groupBy("a").agg(F.max("n").alias("_highest"))
    return counts.join(F.broadcast(highest), "a").select("bucket", "pair", "a", "b", "n", (F.col("n") == F.col("_highest")).alias("best"))


def looked_up(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """(chunk, data) for each block: documents, their links with a best pair, and their sums of counts, in the block's bucket."""
    only = rows.filter("kind = 1")
    size = only.agg(F.sum(F.octet_length("data"))).first()[0] or 0
    salts = max(1, -(-size // (BUCKETS * PER_TASK)))
    salt = F.explode(F.sequence(*(F.lit(x).cast("bigint") for x in (0, salts - 1))))
    counted = counts.select(F.col("bucket").alias("number"), salt.alias("salt"), F.lit(0).alias("kind"), F.col("pair").alias("chunk"), (F.col("n") * 2 + F.col("best").cast("int")).alias("n"), F.lit(None).cast("binary").alias("data"))
    dealt = only.select("number", F.pmod(F.xxhash64("chunk"), F.lit(salts)).alias("salt"), F.lit(1).alias("kind"), "chunk", F.lit(None).cast("bigint").alias("n"), "data")
    tasks = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), 2 * BUCKETS * salts)
    met = counted.union(dealt).repartition(tasks, "number", "salt").sortWithinPartitions("number", "salt", "kind", "chunk")

    def run(batches):
        import zstandard

        pack = zstandard.ZstdCompressor(level=3)
        group, known, keys, counts = None, [], None, None
        for batch in batches:
            columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(5)]
            place = np.stack(columns[:2], 1)
            edges = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]).any(1)])) if len(place) else []
            for first, stop in zip(edges, [*edges[1:], len(place)], strict=True):
                if group != tuple(place[first]):
                    group, known, keys = tuple(place[first]), [], None
                ahead = first + int((columns[2][first:stop] == 0).sum())
                if ahead > first:
                    known.append((columns[3][first:ahead].astype(np.uint32), columns[4][first:ahead].astype(np.int64)))
                if ahead < stop and keys is None:
                    keys, counts = (np.concatenate(x) for x in zip(*known, strict=True))
                    known = []
                for k in range(ahead, stop):
                    distinct, held, doc, times = unpacked(batch.column(5)[k].as_py())
                    mine = counts[np.searchsorted(keys, distinct)]
                    share, best = np.repeat(mine >> 1, held) * times, np.repeat(mine & 1, held) * times
                    top = int(doc.max()) + 1
                    sums = [sum_by(doc, x, top) for x in (best, share)]
                    there = np.flatnonzero(sums[1])
                    body = planes(there.astype("<u2")) + planes(sums[0][there].astype("<i8")) + planes(sums[1][there].astype("<i8"))
                    yield pa.RecordBatch.from_arrays([pa.array([int(columns[3][k])]), pa.array([np.int64(len(there)).tobytes() + pack.compress(body)], pa.binary())], names=["chunk", "data"])

    return met.mapInArrow(run, "chunk bigint, data binary")


def sum_by(place: np.ndarray, values: np.ndarray, top: int) -> np.ndarray:
    """Exact sums of whole numbers by place (a float sum would round above 2**53)."""
    if not len(values) or int(values.max()) * len(values) < 1 << 53:
        return np.bincount(place, values, top).astype(np.int64)
    out = np.zeros(top, np.int64)
    np.add.at(out, place, values)
    return out


def correspondences(docs: DataFrame, path_a: str, path_b: str, digest: bool = False, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Two tables: the documents (doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups), one row each, groups as
    text or as its SHA-256 if ``digest``; and the id pairs of the corpus (bucket, pair, a, b, n, best)."""
    rows = cut(aligned(docs, path_a, path_b, digest, id_col, text_col))
    counts = cut(pair_counts(rows))
    tasks = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows.filter("kind = 0").count() // 500_000))
    fields = ["number", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups"]
    nothing = [F.lit(None).cast(t).alias(c) for c, t in rows.select(*fields).dtypes]
    found = looked_up(rows, counts).select("chunk", F.lit(1).alias("kind"), *nothing, "data")
    met = rows.filter("kind = 0").select("chunk", "kind", *fields, F.lit(None).cast("binary").alias("data")).union(found)
    met = met.repartition(tasks, "chunk").sortWithinPartitions("chunk", "kind", "number")
    schema = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups string"
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]

    def run(batches):
        import zstandard

        unpack = zstandard.ZstdDecompressor()
        chunk, parts, best, total = None, [], None, None

        def done():
            held = pa.Table.from_batches(parts)
            columns = [held.column(c) for c in fields[1:6]]
            n = held.num_rows
            made = pa.table([*columns, pa.array(best[:n]), pa.array(total[:n]), held.column("groups")], names=names)
            yield from made.combine_chunks().to_batches(1 << 14)

        for batch in batches:
            chunks, kinds = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(2))
            edges = np.flatnonzero(np.concatenate([[True], chunks[1:] != chunks[:-1]])) if len(chunks) else []
            for first, stop in zip(edges, [*edges[1:], len(chunks)], strict=True):
                if chunk != chunks[first]:
                    if parts:
                        yield from done()
                    chunk, parts, best, total = chunks[first], [], np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
                ahead = first + int((kinds[first:stop] == 0).sum())
                if ahead > first:
                    parts.append(batch.slice(first, ahead - first))
                for k in range(ahead, stop):
                    data = batch.column(9)[k].as_py()
                    n = int(np.frombuffer(data[:8], "<i8")[0])
                    body = memoryview(unpack.decompress(data[8:]))
                    there = from_planes(body, "<u2", n)
                    best[there] += from_planes(body[2 * n :], "<i8", n)
                    total[there] += from_planes(body[10 * n :], "<i8", n)
        if parts:
            yield from done()

    return met.mapInArrow(run, schema), counts
