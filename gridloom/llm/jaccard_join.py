"""All pairs of word n-gram sets with a Jaccard similarity of at least a threshold, and the groups they form.

Two sets of sizes s <= t with J >= p differ in at most H = floor((1-p)/(1+p) * (s+t)) elements, and s >= p*t. The universe
is cut by a hash of the element into segments. Sets fall into bands of size; a band has a budget D of differences, the
largest H of a pair whose smaller set is in it. A segment is indexed either by its whole subset (weight 1: misses a pair
only if the subsets differ in 1 element or more) or by the subset and its one-deletion neighbours (weight 2: misses only 2
differences or more). With weights that sum to D+1, no pair is missed. Empty subsets say nothing and would gather all sets
that happen to have one; so a band has weights for D+1+z, and a set whose empty segments weigh z at most does without their
keys: what is left still weighs D+1. The few sets with more write those keys, too, and meet there. The cost model chooses
weight and z for each band: whole subsets write one key a segment, neighbourhoods one an element, but have larger subsets.
A set goes into its own band, and into each lower band whose smaller sets it may pair with.

Copies in one part of a batch write their keys once, and sets that are equal (by a 256-bit digest) are one node. Where
several nodes share a key, each is verified against one hub, the one that shares most keys overall; then the hub has done
its part, and what is still in other components goes on without it. After ``stars`` hubs the rest is compared across
components only, block by block, by histograms whose differences bound those of the sets; only what they leave is verified. So a group of n near copies costs some n verifications, not n*n, and every pair of nodes with a common key
is verified or already joined by verified links. Verification is exact: it builds both sets from the texts.

Cases: a null text or one without words has the empty set and no link; with fewer than n words the whole sequence is the
one element; words are parted by ASCII white space and lower-cased in A-Z only; rows that share an id are one node, and
their links add up; rows with a null id are left alone (no group can be named by them); other columns are not read; an
empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import cut, raw_text, slices
from gridloom.llm.components import components

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
#: Bytes of text that are hashed at once, about.
LONG = 1 << 21
BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True
#: Keys in one bucket of the index, about.
PER_BUCKET = 1_000_000
#: Up to so many ids are broadcast (8 bytes each).
BROADCAST_IDS = 2_000_000


@dataclass(frozen=True)
class Scheme:
    """n words an element; two sets link when 100 * shared >= percent * union."""

    n: int = 4
    percent: int = 85

    def most_different(self, total: int) -> int:
        """Most elements in which two linked sets of ``total`` elements together may differ: with d differences the union
        is (total + d) / 2 and what is shared (total - d) / 2, so 100 * (total - d) >= percent * (total + d)."""
        return (100 - self.percent) * total // (100 + self.percent)

    def partner(self, size: int) -> int:
        """The largest set that may link with one of this size."""
        return 100 * size // self.percent


@dataclass(frozen=True)
class Band:
    """Sizes low..high of the smaller set; ``segments`` of one weight, 1 or 2; ``spare`` weight of empty segments."""

    number: int
    low: int
    high: int
    reach: int
    segments: int
    weight: int
    spare: int


#: What a set costs, in keys, that has to write the keys of its empty segments.
EMPTY_KEYS = 1e5


def tail(mean: float, beyond: int) -> float:
    """Poisson probability of more than ``beyond``."""
    if beyond > mean + 10 * math.sqrt(mean) + 10:
        return 0.0
    return max(0.0, 1 - sum(math.exp(-mean + k * math.log(mean) - math.lgamma(k + 1)) for k in range(beyond + 1)))


def allocate(size: int, budget: int) -> tuple[int, int, int]:
    """Segments, weight and spare weight for sets of ``size`` elements at the least cost."""
    if not budget:
        return 1, 1, 0  # equal sets only
    best = None
    for weight in (1, 2):
        spare = 0
        while True:
            segments = -(-(budget + 1 + spare) // weight)
            mean = size / segments
            empty = math.exp(-mean) * (1 + (weight == 2) * mean) if segments > 1 else 0.0
            more = tail(segments * empty, (segments * weight - budget - 1) // weight) if empty else 0.0
            cost = (segments if weight == 1 else segments + size) + more * EMPTY_KEYS
            if best is None or cost < best[0]:
                best = (cost, segments, weight, segments * weight - budget - 1)
            if more * EMPTY_KEYS < 0.01 * cost or segments > size:
                break
            spare += max(1, spare // 8)
    return best[1:]


@cache
def bands(scheme: Scheme, most: int = 1 << 26) -> list[Band]:
    """Bands of sizes, each some 30 % wide, from 1 to ``most``."""
    out, low = [], 1
    while low <= most:
        high = max(low, int(low * 1.3))
        budget = scheme.most_different(high + scheme.partner(high))
        out.append(Band(len(out), low, high, scheme.partner(high), *allocate(low, budget)))
        low = high + 1
    return out


@cache
def band_lows(scheme: Scheme) -> np.ndarray:
    return np.array([b.low for b in bands(scheme)], np.int64)


@cache
def band_reach(scheme: Scheme) -> np.ndarray:
    return np.array([b.reach for b in bands(scheme)], np.int64)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


KEY, SCRAMBLE = np.random.default_rng(20).integers(1, 1 << 63, 2, np.uint64) | np.uint64(1)
#: What a byte counts at each of the first 64 places of a word.
PLACED = mix(np.arange(64 << 8, dtype=np.uint64) * SCRAMBLE + KEY)


def words_of(raw: bytes) -> list[bytes]:
    """split() of bytes parts at exactly U+0020 and U+0009 to U+000D."""
    return raw.translate(LOWER).split()


def elements(raw: bytes, n: int) -> set[tuple[bytes, ...]]:
    words = words_of(raw)
    return {tuple(words)} if 0 < len(words) < n else set(zip(*(words[i:] for i in range(n)), strict=False))


def word_hashes(text: bytes) -> np.ndarray:
    """64-bit hashes of the words of a text: sums of a scrambled number for each pair of a byte and its place in the word
    (tabulation hashing, with ``mix`` of a keyed number as the table), scrambled with the length."""
    codes = np.frombuffer(text, np.uint8)
    if len(text) > LONG:
        # A long text in parts that end between words; only a longer word makes a longer part.
        blank = np.flatnonzero(BLANK[codes])
        cuts = np.unique(blank[np.unique(np.searchsorted(blank, np.arange(LONG // 2, len(text), LONG // 2), "right")) - 1]) if len(blank) else blank
        if len(cuts):
            ends = [0, *cuts.tolist(), len(text)]
            parts = [text[a:b] for a, b in zip(ends, ends[1:], strict=False)]
            if max(map(len, parts)) < len(text):
                return np.concatenate([word_hashes(part) for part in parts])
    inner = np.concatenate([[False], ~BLANK[codes], [False]])
    edges = np.flatnonzero(inner[1:] != inner[:-1])
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64)
    sizes = ends - starts
    place = np.arange(sizes.sum(), dtype=np.int64) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    mine = (place.astype(np.uint64) << np.uint64(8)) | codes[inner[1:-1]]
    with np.errstate(over="ignore"):
        values = PLACED[mine] if len(PLACED) > mine.max() else mix(mine * SCRAMBLE + KEY)
        return mix(np.add.reduceat(values, np.cumsum(sizes) - sizes) + sizes.astype(np.uint64))


def element_sets(raws: list[bytes], n: int) -> list[np.ndarray]:
    """Sets of 64-bit element hashes of texts, in order. They only find candidates and count one text's elements."""
    lows = [raw.translate(LOWER) for raw in raws]
    out, start = [], 0
    while start < len(lows):
        stop, held = start, 0
        while stop < len(lows) and (stop == start or held + len(lows[stop]) < 1 << 20):
            held += len(lows[stop]) + 1
            stop += 1
        some = lows[start:stop]
        found = word_hashes(b" ".join(some))
        counts = [len(x.split()) for x in some] if len(some) > 1 else [len(found)]
        with np.errstate(over="ignore"):
            total = np.full(max(0, len(found) - n + 1), n, np.uint64)
            for i in range(n):
                total = mix(total * np.uint64(0x9E3779B97F4A7C15) + found[i : len(found) - n + 1 + i]) if len(total) else total
        at = 0
        for count in counts:
            if count >= n:
                mine = np.sort(total[at : at + count - n + 1])
                out.append(mine[np.concatenate([[True], mine[1:] != mine[:-1]])])
            else:
                out.append(short(found[at : at + count]))
            at += count
        start = stop
    return out


def short(found: np.ndarray) -> np.ndarray:
    """The one element of a text with fewer than n words."""
    if not len(found):
        return found
    total = np.full(1, len(found), np.uint64)
    with np.errstate(over="ignore"):
        for code in found:
            total = mix(total * np.uint64(0x9E3779B97F4A7C15) + code)
    return total


def histogram(found: np.ndarray) -> bytes:
    """How many elements fall into each cell of a hash, 255 at most; cells: a power of two, about the size of the set.
    Half as many cells are the sums of neighbours; the sum of differences of two histograms is never above the number
    of elements in which the sets differ."""
    cells = 1 << max(4, (len(found) - 1).bit_length() if len(found) else 0)
    place = (found >> np.uint64(65 - cells.bit_length())).astype(np.int64)
    return np.minimum(np.bincount(place, minlength=cells), 255).astype(np.uint8).tobytes()


def keys_of(found: np.ndarray, scheme: Scheme) -> np.ndarray:
    """The index keys of a set: for its own band and each lower one that it reaches into."""
    size = len(found)
    first = int(np.searchsorted(band_reach(scheme), size))
    last = int(np.searchsorted(band_lows(scheme), size, "right")) - 1
    out = []
    with np.errstate(over="ignore"):
        weights = mix(found)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(weights)])
        for band in bands(scheme)[first : last + 1]:
            place = ((found >> np.uint64(33)) * np.uint64(band.segments) >> np.uint64(31)).astype(np.int64)
            # The elements are in order, so those of a segment stand together; a subset's key is the sum of its hashes.
            count = np.bincount(place, minlength=band.segments)
            ends = np.cumsum(count)
            totals = sums[ends] - sums[ends - count]
            salt = mix(np.arange(band.segments, dtype=np.uint64) + np.uint64(band.number << 32))
            write_all = band.weight * np.count_nonzero(count < band.weight) > band.spare
            out.append(mix(totals + salt)[(count > 0) | write_all])
            if band.weight == 2:
                out.append(mix(totals[place] - weights + salt[place])[(count[place] > 1) | write_all])
    return np.unique(np.concatenate(out)) if out else np.zeros(0, np.uint64)


def described(docs: DataFrame, scheme: Scheme, id_col: str, text_col: str) -> DataFrame:
    """doc_id, n_shingles, digest of the set (null if empty)."""
    kinds = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("digest", pa.binary())])

    def run(batches):
        for batch in batches:
            for some in slices(batch, "text"):
                sets = element_sets(some.column(1).to_pylist(), scheme.n)
                digest = [hashlib.sha256(x.tobytes()).digest() if len(x) else None for x in sets]
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array([len(x) for x in sets], pa.int64()), pa.array(digest, pa.binary())], schema=kinds)

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), raw_text(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, n_shingles bigint, digest binary")


def by_bucket(nodes: list[int], keys: list[np.ndarray], buckets: int) -> list[pa.Array]:
    """bucket, data: the pairs of a key and a node, 16 bytes each, in the order of buckets. They are written once, sorted, and
    the values of data are slices of that."""
    every = np.concatenate(keys)
    bucket = ((every >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)
    order = np.argsort(bucket, kind="stable").astype(np.int32)
    flat = np.empty(len(every), np.dtype([("key", "<u8"), ("node", "<i8")]))
    flat["key"] = every[order]
    del every
    flat["node"] = np.repeat(np.array(nodes, np.int64), [len(k) for k in keys])[order]
    bucket = bucket[order]
    starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    ends = np.r_[starts, len(flat)] * flat.itemsize
    if ends[-1] >= 1 << 31:
        return [pa.array(bucket[starts]), pa.array([flat[a:b].tobytes() for a, b in zip(starts, [*starts[1:], len(flat)], strict=True)], pa.binary())]
    return [pa.array(bucket[starts]), pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(flat)])]


def indexed(texts: DataFrame, scheme: Scheme, buckets: int) -> DataFrame:
    """bucket, keys, nodes: the keys of each text, packed by bucket for each part of a batch."""
    kinds = pa.schema([("bucket", pa.int32()), ("data", pa.binary())])

    def packed(found: dict[bytes, tuple[int, np.ndarray]]):
        return pa.RecordBatch.from_arrays(by_bucket([x[0] for x in found.values()], [x[1] for x in found.values()], buckets), schema=kinds)

    def run(batches):
        found: dict[bytes, tuple[int, np.ndarray]] = {}
        held = 0
        for batch in batches:
            for some in slices(batch, "text"):
                for node, elements_of in zip(some.column(0).to_pylist(), element_sets(some.column(1).to_pylist(), scheme.n), strict=True):
                    if len(elements_of) and (digest := hashlib.sha256(elements_of.tobytes()).digest()) not in found:
                        found[digest] = node, keys_of(elements_of, scheme)
                        held += len(found[digest][1])
                    if held > 1_000_000:
                        yield packed(found)
                        found, held = {}, 0
        if held:
            yield packed(found)

    return texts.mapInArrow(run, "bucket int, data binary")


def shared_keys(index: DataFrame) -> DataFrame:
    """key, node for keys that more than one node has; runs with the same nodes come once, with how many there are."""
    kinds = pa.schema([("key", pa.int64()), ("node", pa.int64()), ("times", pa.int64())])

    def runs(rows: list[bytes]):
        flat = np.concatenate([np.frombuffer(x, np.dtype([("key", "<u8"), ("node", "<i8")])) for x in rows])
        order = np.argsort(flat["key"], kind="stable")
        keys, nodes = flat["key"][order], flat["node"][order]
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        sizes = np.diff(np.r_[starts, len(keys)])
        several = sizes > 1
        if not several.any():
            return None
        mask = np.repeat(several, sizes)
        keys, nodes, sizes = keys[mask], nodes[mask], sizes[several]
        starts = np.cumsum(sizes) - sizes
        with np.errstate(over="ignore"):
            marks = np.add.reduceat(mix(nodes.astype(np.uint64)), starts)
        _, first, times = np.unique(marks, return_index=True, return_counts=True)
        pick = np.zeros(len(sizes), bool)
        pick[first] = True
        count = np.zeros(len(sizes), np.int64)
        count[first] = times
        mask = np.repeat(pick, sizes)
        # A run is named by its set of nodes: the same set in another bucket has the same name.
        return pa.RecordBatch.from_arrays([pa.array(np.repeat(marks, sizes)[mask].view(np.int64)), pa.array(nodes[mask]), pa.array(np.repeat(count, sizes)[mask])], schema=kinds)

    def run(batches):
        # Rows come sorted by bucket: one bucket is held at a time.
        bucket, rows = None, []
        for batch in batches:
            for b, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if b != bucket and rows:
                    if (out := runs(rows)) is not None:
                        yield out
                    rows = []
                bucket = b
                rows.append(data)
        if rows and (out := runs(rows)) is not None:
            yield out

    parts = index.repartition("bucket").sortWithinPartitions("bucket")
    found = parts.mapInArrow(run, "key bigint, node bigint, times bigint")
    return found.groupBy("key", "node").agg(F.sum("times").alias("times"))


def verified(pairs: DataFrame, texts: DataFrame, scheme: Scheme) -> DataFrame:
    """a, b of the pairs (a, b) whose sets, built from the texts, link."""
    kinds = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        for batch in batches:
            out: list[tuple[int, int]] = []
            last, left = None, set()
            for a, b, x, y in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if last != a:
                    last, left = a, elements(x, scheme.n)
                right = elements(y, scheme.n)
                both = len(left & right)
                if both and 100 * both >= scheme.percent * (len(left) + len(right) - both):
                    out.append((a, b))
            yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in out], pa.int64()), pa.array([p[1] for p in out], pa.int64())], schema=kinds)

    one = texts.select(F.col("node").alias("a"), F.col("text").alias("x"))
    two = texts.select(F.col("node").alias("b"), F.col("text").alias("y"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "x", "y").mapInArrow(run, "a bigint, b bigint")


def labelled(nodes: DataFrame, links: DataFrame, key: str) -> DataFrame:
    """nodes with label: the component that the links give, or the node itself."""
    found = components(links).withColumnRenamed("node", key)
    return nodes.join(found, key, "left").withColumn("label", F.coalesce("component", key)).drop("component")


def texts_of(docs: DataFrame, nodes: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """node, text of the documents in ``nodes``. Their ids are broadcast if they are counted to be few; else both sides
    are dealt out by id."""
    chosen = docs.select(F.col(id_col).cast("bigint").alias("node"), raw_text(text_col).alias("text"))
    nodes = cut(nodes)
    return chosen.join(F.broadcast(nodes) if nodes.count() <= BROADCAST_IDS else nodes.hint("merge"), "node", "left_semi")


def sketched(texts: DataFrame, scheme: Scheme) -> DataFrame:
    """node, size, cells (a histogram) of node, text."""
    kinds = pa.schema([("node", pa.int64()), ("size", pa.int64()), ("cells", pa.binary())])

    def run(batches):
        for batch in batches:
            for some in slices(batch, "text"):
                sets = element_sets(some.column(1).to_pylist(), scheme.n)
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array([len(x) for x in sets], pa.int64()), pa.array([histogram(x) for x in sets], pa.binary())], schema=kinds)

    return texts.mapInArrow(run, "node bigint, size bigint, cells binary")


def folded(cells: list[bytes], n: int) -> np.ndarray:
    return np.stack([np.minimum(np.frombuffer(x, np.uint8).reshape(n, -1).sum(1, dtype=np.int64), 255) for x in cells]).astype(np.int16)


def close_pairs(one: tuple, two: tuple | None, scheme: Scheme) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of nodes of two blocks (or of one) in different components whose sizes and histograms leave room for a link.
    A block: nodes, labels, sizes, histograms."""
    two = two or one
    n = min(min(map(len, one[3])), min(map(len, two[3])))
    left, right = folded(one[3], n), folded(two[3], n)
    found_a, found_b = [], []
    for i in range(len(left)):
        total = one[2][i] + two[2]
        may = (one[1][i] != two[1]) & (one[0][i] != two[0])
        may &= 100 * np.minimum(one[2][i], two[2]) >= scheme.percent * np.maximum(one[2][i], two[2])
        at = np.flatnonzero(may)
        if len(at):
            differ = np.abs(right[at] - left[i]).sum(1, dtype=np.int64)
            at = at[(100 + scheme.percent) * differ <= (100 - scheme.percent) * total[at]]
            found_a.append(np.full(len(at), one[0][i]))
            found_b.append(two[0][at])
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *found_a]), np.concatenate([none, *found_b])


def across(members: DataFrame, sketches: DataFrame, scheme: Scheme, block: int = 1000) -> DataFrame:
    """a, b: nodes with a common key in different components that may link by their histograms. A key's nodes are dealt
    into blocks of some ``block``, and each pair of blocks is compared where it lies; only what may link comes out."""
    sizes = members.groupBy("key").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    dealt = members.join(sizes, "key").withColumn("mine", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    dealt = dealt.select("key", "node", "label", "mine", other)
    pair = dealt.select("key", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine", "node", "label").join(sketches, "node")
    parts = pair.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "mine").select("key", "i", "j", "mine", "node", "label", "size", "cells")
    kinds = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def block_of(rows: list[tuple]) -> tuple:
        return (*(np.array([r[k] for r in rows], np.int64) for k in (4, 5, 6)), [r[7] for r in rows])

    def compared(rows: list[tuple]):
        first = [r for r in rows if r[3] == r[1]]
        second = [r for r in rows if r[3] != r[1]] if rows[0][1] != rows[0][2] else None
        if not first or second == []:
            return None
        a, b = close_pairs(block_of(first), block_of(second) if second else None, scheme)
        pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], schema=kinds) if len(pairs) else None

    def run(batches):
        rows: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if rows and row[:3] != rows[0][:3]:
                    if (out := compared(rows)) is not None:
                        yield out
                    rows = []
                rows.append(row)
        if rows and (out := compared(rows)) is not None:
            yield out

    return parts.mapInArrow(run, "a bigint, b bigint").distinct()


def near_groups(docs: DataFrame, scheme: Scheme = Scheme(), id_col: str = "doc_id", text_col: str = "text", stars: int = 1) -> DataFrame:
    """Every row: doc_id, n_shingles, component_id."""
    rows = cut(described(docs, scheme, id_col, text_col))
    known = rows.filter("digest IS NOT NULL AND doc_id IS NOT NULL")
    sets = known.groupBy("digest").agg(F.min("doc_id").alias("node"))
    total = known.agg(F.sum("n_shingles")).first()[0] or 0
    buckets = max(256, total // (3 * PER_BUCKET))
    ids = docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("doc_id"), raw_text(text_col).alias("text"))
    shared = cut(shared_keys(indexed(ids, scheme, buckets)))
    # Copies that wrote their keys in different tasks become one node.
    one = known.join(shared.select(F.col("node").alias("doc_id")).distinct(), "doc_id", "left_semi").join(sets, "digest").select(F.col("doc_id").alias("copy"), "node")
    shared = cut(shared.withColumnRenamed("node", "copy").join(one, "copy").groupBy("key", "node").agg(F.max("times").alias("times")))
    runs = shared.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    shared = shared.join(runs, "key")
    weight = shared.groupBy("node").agg(F.sum(F.col("times") * F.col("n")).alias("weight"))
    members = cut(shared.join(weight, "node").select("key", "node", "weight"))
    some = cut(texts_of(docs, members.select("node").distinct(), id_col, text_col))
    links = members.select(F.col("node").alias("a"), F.col("node").alias("b")).limit(0)
    tried = links
    for star in range(stars + 1):
        # Before the first hub there is no link yet.
        members = cut(labelled(members, links, "node").select("key", "node", "weight", "label")) if star else members.withColumn("label", F.col("node"))
        open_ = members.groupBy("key").agg(F.max(F.struct("weight", "node", "label")).alias("hub"), F.min("label").alias("low"), F.max("label").alias("high")).filter("low <> high").select("key", "hub")
        members = cut(members.join(open_, "key"))
        if members.isEmpty():
            break
        if star < stars:
            ends = members.filter("label <> hub.label").select(F.least("node", "hub.node").alias("a"), F.greatest("node", "hub.node").alias("b")).distinct()
        else:
            left = members.select("node").distinct()
            ends = across(members.select("key", "node", "label"), sketched(some.join(left, "node", "left_semi"), scheme), scheme)
        pairs = cut(ends.join(tried, ["a", "b"], "left_anti"))
        links, tried = cut(links.union(verified(pairs, some, scheme)).distinct()), cut(tried.union(pairs))
        members = members.filter("node <> hub.node").select("key", "node", "weight")
    named = labelled(sets, links, "node").select("digest", "label")
    # Rows that share an id share a component.
    grouped = known.join(named, "digest").select("doc_id", "n_shingles", "label")
    twice = cut(grouped.groupBy("doc_id").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low <> high").select(F.col("low").alias("a"), F.col("high").alias("b")))
    joined = grouped if twice.isEmpty() else labelled(grouped.withColumnRenamed("label", "part"), twice, "part")
    alone = rows.filter("digest IS NULL OR doc_id IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return joined.select("doc_id", "n_shingles", F.col("label").alias("component_id")).unionByName(alone)
