"""Prefix trie of conversations: every distinct beginning is a node; totals go from the leaves up by time-forward processing.

A conversation is a list of turns (role and text). A node's id is a chained SHA-256 of the turns up to it, cut to 128 bits. Chains
run in bands of ``BAND`` turns, so a very long conversation is hashed by many tasks; one more hash per turn puts the id of the
band's start in front.

Nodes are cut into shards that hang together: the subtree of a first node with few enough turns below it in its band (light),
and of each band the nodes above those (heavy). A shard sends to one node outside at most. Inside a shard nodes come in reverse level order,
sorted by Spark, which spills; each pops what its children sent from a priority queue that spills, adds its own, and sends the
total to its parent. What is left in the queue goes to the shard's outer parent. The same pass then runs over the shards
that others send to, one node each, and once more inside these with all that arrives.

Cases: a null role or text is empty; rows with a null conv_id belong to no conversation and are left out; equal turn numbers, and
null ones (first), are in order of their digests, so repeated rows are turns of their own; an empty table has no node, not
even a root; a conversation without turns is a member of the root; other columns are not read. Texts of any length are hashed
where they are read and moved nowhere. A conversation or a beginning that a third of all rows share is split by ranges of
turns, by bands, and by light subtrees.
"""

from __future__ import annotations

import hashlib
import heapq
import pickle
import tempfile
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridloom.functions.sizing import BROADCAST_BYTES, measured_bytes
from gridloom.llm.common import arrow_type, cut

#: Turns that are hashed in one go.
BAND = 1024
#: Most turns below the first node of a light shard: this many, or a 4,096th of all.
LIGHT = 1_000
#: Rows of one task, about; messages of a queue in memory; ids of a node that are joined to one text.
PER_TASK, IN_MEMORY, IDS = 1_000_000, 500_000, 50_000
NODE = ["hi", "lo"]


class Trie(NamedTuple):
    """nodes: hi, lo (id), conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved. ends: hi, lo, conv_id
    of each conversation and the node where it ends."""

    nodes: DataFrame
    ends: DataFrame


class SpillingQueue:
    """A priority queue of tuples, smallest first. Beyond ``limit`` it writes what it holds, in order, to a file that only this task
    has and that goes with it, and merges the files as it pops."""

    def __init__(self, limit: int):
        self.limit, self.heap, self.runs, self.count = limit, [], [], 0

    def __len__(self) -> int:
        return len(self.heap) + len(self.runs)

    def push(self, item: tuple) -> None:
        heapq.heappush(self.heap, item)
        if len(self.heap) > self.limit:
            run = self.written(sorted(self.heap))
            self.heap = []
            heapq.heappush(self.runs, (next(run), self.count, run))
            self.count += 1

    def written(self, items: list) -> Iterator[tuple]:
        file = tempfile.TemporaryFile()
        for start in range(0, len(items), 1000):
            pickle.dump(items[start : start + 1000], file)
        file.seek(0)

        def read():
            with file:
                while True:
                    try:
                        yield from pickle.load(file)
                    except EOFError:
                        return

        return read()

    def first(self) -> tuple | None:
        if self.runs and (not self.heap or self.runs[0][0] < self.heap[0]):
            return self.runs[0][0]
        return self.heap[0] if self.heap else None

    def pop(self) -> tuple:
        if self.runs and (not self.heap or self.runs[0][0] < self.heap[0]):
            item, number, run = self.runs[0]
            if (following := next(run, None)) is None:
                heapq.heappop(self.runs)
            else:
                heapq.heapreplace(self.runs, (following, number, run))
            return item
        return heapq.heappop(self.heap)


def tasks_for(df: DataFrame, rows: int) -> int:
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // PER_TASK))


def mapped(df: DataFrame, work, schema: str) -> DataFrame:
    """``work`` turns the rows of a partition, an iterator of tuples, into tuples of the schema."""
    names, kinds = zip(*(x.strip().split() for x in schema.split(",")), strict=True)
    kinds = [arrow_type(k) for k in kinds]

    def rows(batches):
        for batch in batches:
            yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

    def batch_of(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=list(names))

    def run(batches):
        out: list[tuple] = []
        for row in work(rows(batches)):
            out.append(row)
            if len(out) == 10_000:
                yield batch_of(out)
                out = []
        if out:
            yield batch_of(out)

    return df.mapInArrow(run, schema)


def step(before: bytes, digest: bytes) -> bytes:
    return hashlib.sha256(before + digest).digest()[:16]


def halves(node: bytes) -> tuple[int, int]:
    return int.from_bytes(node[:8], "big", signed=True), int.from_bytes(node[8:], "big", signed=True)


def whole(hi: int, lo: int) -> bytes:
    return hi.to_bytes(8, "big", signed=True) + lo.to_bytes(8, "big", signed=True)


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, number (from 1, in order of turn), digest, n (code points) of every turn.

    Ranges of (conv_id, turn) are numbered where they are; a conversation that goes on from an earlier range adds what it had
    there, at most one entry for each range.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    said = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    digest = F.substring(F.unhex(F.sha2(said.cast("binary"), 256)), 1, 16)
    rows = cut(conversations.filter("conv_id IS NOT NULL").select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), digest.alias("digest"), F.length(text).cast("bigint").alias("n")))
    order = ["conv_id", F.col("turn").asc_nulls_first(), "digest"]
    spread = cut(rows.repartitionByRange(tasks_for(rows, rows.count()), *order).sortWithinPartitions(*order))
    spread = spread.withColumn("part", F.spark_partition_id())
    counts = spread.groupBy("part", "conv_id").agg(F.count("*").alias("before"))
    earlier = counts.select("part", "conv_id", (F.sum("before").over(Window.partitionBy("conv_id").orderBy("part")) - F.col("before")).alias("before"))
    placed = spread.join(F.broadcast(earlier.filter("before > 0")), ["part", "conv_id"], "left").select("conv_id", F.coalesce("before", F.lit(0)).alias("before"), "digest", "n")

    def run(rows):
        last, number = None, 0
        for conv, before, digest, n in rows:
            number = number + 1 if conv == last else before + 1
            last = conv
            yield conv, number, digest, n

    return mapped(placed, run, "conv_id bigint, number bigint, digest binary, n bigint")


def forked(numbered: DataFrame, stride: int = 100, ways: int = 6) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin like another one: c takes the first h = crc32(c) % ways turns of c - c % stride in place of its
    own first h. (conv_id, depth, digest, n, total) of every turn, and (conv_id, total), the number of turns, of each conversation."""
    numbered = cut(numbered)
    own = numbered.groupBy("conv_id").agg(F.max("number").alias("own"))
    few = numbered.filter((F.col("conv_id") % stride == 0) & (F.col("number") < ways))
    heads = few.groupBy(F.col("conv_id").alias("base")).agg(F.array_sort(F.collect_list(F.struct("number", "digest", "n"))).alias("head"))
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % ways
    convs = own.select("conv_id", "own", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % stride).alias("base")).join(heads, "base", "left")
    k = F.least("h", F.coalesce(F.size("head"), F.lit(0)).cast("bigint"))
    convs = convs.select("conv_id", "h", k.alias("k"), (k + F.greatest(F.lit(0), F.col("own") - F.col("h"))).alias("total"), F.slice("head", F.lit(1), k.cast("int")).alias("head"))
    convs = cut(convs)
    given = convs.select("conv_id", "total", F.explode("head").alias("t")).select("conv_id", F.col("t.number").alias("depth"), "t.digest", "t.n", "total")
    kept = numbered.join(convs.select("conv_id", "h", "k", "total"), "conv_id").filter("number > h")
    kept = kept.select("conv_id", (F.col("number") - F.col("h") + F.col("k")).alias("depth"), "digest", "n", "total")
    return given.union(kept), convs.select("conv_id", "total")


def chained(sequences: DataFrame, tasks: int) -> DataFrame:
    """conv_id, band, depth, n, last (0 or 1), id and parent's id of each turn, and weight: turns of the conversation from here to
    the band's end."""
    band = F.floor((F.col("depth") - 1) / BAND).cast("bigint")
    rows = sequences.select("conv_id", band.alias("band"), "depth", "digest", "n", (F.col("depth") == F.col("total")).cast("bigint").alias("last"))
    rows = rows.repartition(tasks, "conv_id", "band").sortWithinPartitions("conv_id", "band", "depth")
    schema = "conv_id bigint, band bigint, depth bigint, n bigint, last bigint, hi bigint, lo bigint, up_hi bigint, up_lo bigint, weight bigint"

    def run(rows):
        held, at = [], None

        def done():
            node, up = b"", (0, 0)
            for i, (conv, band, depth, digest, n, last) in enumerate(held):
                node = step(node, digest)
                yield conv, band, depth, n, last, *(mine := halves(node)), *up, len(held) - i
                up = mine

        for row in rows:  # a conversation's band has no more than BAND rows
            if row[:2] != at:
                yield from done()
                held, at = [], row[:2]
            held.append(row)
        yield from done()

    made = cut(mapped(rows, run, schema))
    later = made.filter("band > 0")
    if later.isEmpty():
        return made
    # The id at each band's start, from the ends of the bands before it: one row for BAND turns.
    starts = made.filter(F.col("depth") % BAND == 0).select("conv_id", "band", "hi", "lo")

    def follow(rows):
        last = None
        for conv, band, hi, lo in rows:
            start = whole(hi, lo) if conv != last else step(start, whole(hi, lo))
            last = conv
            yield conv, band + 1, *halves(start)

    starts = mapped(starts.repartition("conv_id").sortWithinPartitions("conv_id", "band"), follow, "conv_id bigint, band bigint, s_hi bigint, s_lo bigint")

    def settle(rows):
        for conv, band, depth, n, last, hi, lo, up_hi, up_lo, weight, s_hi, s_lo in rows:
            start = whole(s_hi, s_lo)
            up = (s_hi, s_lo) if depth % BAND == 1 or BAND == 1 else halves(step(start, whole(up_hi, up_lo)))
            yield conv, band, depth, n, last, *halves(step(start, whole(hi, lo))), *up, weight

    settled = later.join(starts, ["conv_id", "band"]).select(*made.columns, "s_hi", "s_lo")
    return cut(made.filter("band = 0").union(mapped(settled, settle, schema)))


def sharded(rows: DataFrame, tasks: int, total: int) -> DataFrame:
    """The rows with heavy (0 or 1) and their shard's key: of light ones the first light node, of heavy ones the band's start."""
    limit = max(LIGHT, total // 4096)
    heavy = cut(rows.groupBy(*NODE).agg(F.sum("weight").alias("w")).filter(F.col("w") > limit).select(*NODE, F.lit(1).cast("bigint").alias("heavy")))
    few = measured_bytes(heavy) <= BROADCAST_BYTES
    marked = rows.join(F.broadcast(heavy) if few else heavy, NODE, "left").select("conv_id", "band", "depth", "n", "last", *NODE, "up_hi", "up_lo", F.coalesce("heavy", F.lit(0)).alias("heavy"))
    marked = marked.repartition(tasks, "conv_id", "band").sortWithinPartitions("conv_id", "band", "depth")

    def run(rows):
        at = None
        for row in rows:
            if row[:2] != at:
                at, start, light = row[:2], row[7:9], None
            if not row[9] and light is None:
                light = row[5:7]
            yield *row, *(start if row[9] else light)

    schema = ", ".join(f"{c} bigint" for c in (*marked.columns, "s_hi", "s_lo"))
    return cut(mapped(marked, run, schema))


#: Rows of a pass: kind 1 nodes, kind 0 messages to the node (depth, hi, lo).
PASS = "s_hi bigint, s_lo bigint, depth bigint, hi bigint, lo bigint, kind int, up_depth bigint, up_hi bigint, up_lo bigint, kids bigint, leaves bigint, saved bigint"
COLUMNS = [x.split()[0] for x in PASS.split(", ")]


def forward(rows: DataFrame, tasks: int) -> DataFrame:
    """One pass over shards (rows of PASS): nodes with kids, leaves and saved of their subtrees as far as the shard and its messages
    go, and, as messages, what shards send to nodes outside."""
    rows = rows.select(*COLUMNS).repartition(tasks, "s_hi", "s_lo").sortWithinPartitions("s_hi", "s_lo", F.desc("depth"), "hi", "lo", "kind")
    most = IN_MEMORY

    def run(rows):
        queue, shard = SpillingQueue(most), None

        def leave(shard, until):
            """Messages to nodes that are not in the shard, added up."""
            out = None
            while (item := queue.first()) is not None and (until is None or item[:3] < until):
                queue.pop()
                if out is not None and out[:3] != item[:3]:
                    yield *shard, -out[0], out[1], out[2], 0, None, None, None, *out[3:]
                    out = None
                out = item if out is None else (*out[:3], *(a + b for a, b in zip(out[3:], item[3:], strict=True)))
            if out is not None:
                yield *shard, -out[0], out[1], out[2], 0, None, None, None, *out[3:]

        for s_hi, s_lo, depth, hi, lo, kind, up_depth, up_hi, up_lo, kids, leaves, saved in rows:
            if (s_hi, s_lo) != shard:
                if shard is not None:
                    yield from leave(shard, None)
                shard = (s_hi, s_lo)
            key = (-depth, hi, lo)
            if kind == 0:
                queue.push((*key, kids, leaves, saved))
                continue
            yield from leave(shard, key)
            while (item := queue.first()) is not None and item[:3] == key:
                _, _, _, a, b, c = queue.pop()
                kids, leaves, saved = kids + a, leaves + b, saved + c
            yield s_hi, s_lo, depth, hi, lo, 1, up_depth, up_hi, up_lo, kids, leaves, saved
            if up_depth is not None:
                queue.push((-up_depth, up_hi, up_lo, 1, leaves, saved))
        if shard is not None:
            yield from leave(shard, None)

    return mapped(rows, run, PASS)


def totals(nodes: DataFrame, tasks: int) -> DataFrame:
    """hi, lo, kids, leaves, saved of every node; ``nodes`` are rows of PASS with each node's own leaves and saved."""
    shard, sums = ["s_hi", "s_lo"], [F.sum(x).alias(x) for x in ("kids", "leaves", "saved")]
    local = cut(forward(nodes, tasks))
    sent = local.filter("kind = 0").drop("kind", "up_depth", "up_hi", "up_lo")
    # Nodes that get something from other shards, and the shards they are in: those above light ones, and one in BAND levels.
    got = cut(sent.groupBy("depth", *NODE).agg(*sums))
    place = cut(got.select(*NODE).join(nodes.select(*NODE, F.col("s_hi").alias("to_hi"), F.col("s_lo").alias("to_lo")), NODE))
    inner = cut(place.select(F.col("to_hi").alias("s_hi"), F.col("to_lo").alias("s_lo")).distinct())
    ours = sent.join(inner, shard)
    # Across shards: of each shard that others send to, what it and those below it that get nothing add up to.
    leafy = sent.join(inner, shard, "left_anti").groupBy("depth", *NODE).agg(*sums)
    below = leafy.join(place, NODE).groupBy(F.col("to_hi").alias("s_hi"), F.col("to_lo").alias("s_lo")).agg(*sums[1:])
    zero = [F.lit(0).cast("bigint").alias(x) for x in ("kids", "leaves", "saved")]
    own = inner.join(ours.withColumnsRenamed({"leaves": "l", "saved": "s", "hi": "t_hi", "lo": "t_lo"}), shard, "left").join(below, shard, "left")
    own = own.join(place.withColumnsRenamed({"hi": "t_hi", "lo": "t_lo"}), ["t_hi", "t_lo"], "left")
    add = lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))
    # A shard's level is that of the node it sends to, and one more; the uppermost sends to none.
    own = cut(own.select(*shard, F.coalesce(F.col("depth") + 1, F.lit(0)).alias("level"), "to_hi", "to_lo", add("l", "leaves").alias("leaves"), add("s", "saved").alias("saved")))
    level = own.select(F.col("s_hi").alias("to_hi"), F.col("s_lo").alias("to_lo"), F.col("level").alias("up_depth"))
    vertices = own.join(level, ["to_hi", "to_lo"], "left").select(
        F.lit(0).cast("bigint").alias("s_hi"), F.lit(0).cast("bigint").alias("s_lo"), F.col("level").alias("depth"), F.col("s_hi").alias("hi"), F.col("s_lo").alias("lo"),
        F.lit(1).alias("kind"), "up_depth", F.col("to_hi").alias("up_hi"), F.col("to_lo").alias("up_lo"), zero[0], "leaves", "saved",
    )
    solved = forward(vertices, 1).filter("kind = 1").select(F.col("hi").alias("s_hi"), F.col("lo").alias("s_lo"), F.col("leaves").alias("l"), F.col("saved").alias("s"))
    replaced = ours.drop("leaves", "saved").join(solved, shard).groupBy("depth", *NODE).agg(sums[0], F.sum("l").alias("leaves"), F.sum("s").alias("saved"))
    nothing = [F.lit(None).cast("bigint").alias(x) for x in ("up_depth", "up_hi", "up_lo")]
    arrived = leafy.unionByName(replaced).join(place, NODE).select(F.col("to_hi").alias("s_hi"), F.col("to_lo").alias("s_lo"), "depth", *NODE, F.lit(0).alias("kind"), *nothing, "kids", "leaves", "saved")
    again = forward(nodes.join(inner, shard).select(*COLUMNS).union(arrived), tasks)
    rest = local.join(inner, shard, "left_anti")
    return rest.select(*COLUMNS).union(again).filter("kind = 1").select(*NODE, "kids", "leaves", "saved")


def build(sequences: DataFrame, convs: DataFrame) -> Trie:
    """The trie of sequences (conv_id, depth from 1, digest, n, total); ``convs`` (conv_id, total) has every conversation."""
    sequences, convs = cut(sequences), cut(convs)
    total = sequences.count()
    tasks = tasks_for(sequences, total)
    rows = sharded(chained(sequences, tasks), tasks, total)
    least = [F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")]
    whole = [F.max(x).alias(x) for x in ("depth", "n", "up_hi", "up_lo", "s_hi", "s_lo", "heavy")]
    zeros = lambda names: [F.lit(0).cast("bigint").alias(x) for x in names]
    root = convs.agg(*least, F.sum((F.col("total") == 0).cast("bigint")).alias("n_ends")).filter("n_convs > 0")
    names = [*NODE, "conv_id", "n_convs", "n_ends", "depth", "n", "up_hi", "up_lo", "s_hi", "s_lo", "heavy"]
    nothing = [F.lit(None).cast("bigint").alias(x) for x in ("up_hi", "up_lo")]
    root = root.select(*zeros(NODE), "conv_id", "n_convs", "n_ends", *zeros(["depth", "n"]), *nothing, *zeros(["s_hi", "s_lo"]), F.lit(1).cast("bigint").alias("heavy"))
    nodes = cut(rows.groupBy(*NODE).agg(*least, F.sum("last").alias("n_ends"), *whole).select(*names).union(root))
    leaf = (F.col("n_ends") == F.col("n_convs")).cast("bigint")  # nobody goes on from here
    saved = (F.col("n_convs") - 1) * F.col("n")
    passing = nodes.select("s_hi", "s_lo", "depth", *NODE, F.lit(1).alias("kind"), F.when(F.col("depth") > 0, F.col("depth") - 1).alias("up_depth"), "up_hi", "up_lo", *zeros(["kids"]), leaf.alias("leaves"), saved.alias("saved"))
    summed = totals(passing, tasks).select(*NODE, F.col("kids").alias("n_children"), F.col("leaves").alias("n_leaves"), "saved")
    made = nodes.join(summed, NODE).select(*NODE, "conv_id", "depth", "up_hi", "up_lo", "n_convs", "n_children", "n_leaves", "saved")
    # Heavy nodes may have a third of all nodes as children; they are few, and meet them before the others are shuffled.
    parents = nodes.select(F.col("hi").alias("up_hi"), F.col("lo").alias("up_lo"), F.col("conv_id").alias("parent_conv_id"), "heavy")
    above = parents.filter("heavy = 1").drop("heavy")
    first = cut(made.join(F.broadcast(above) if measured_bytes(above) <= BROADCAST_BYTES else above, ["up_hi", "up_lo"], "left"))
    known = (F.col("depth") == 0) | F.col("parent_conv_id").isNotNull()
    second = first.filter(~known).drop("parent_conv_id").join(parents.drop("heavy"), ["up_hi", "up_lo"])
    wanted = [*NODE, "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved"]
    ends = rows.filter("last = 1").select(*NODE, "conv_id").union(convs.filter("total = 0").select(*zeros(NODE), "conv_id"))
    return Trie(first.filter(known).select(*wanted).union(second.select(*wanted)), ends)


def digests(ends: DataFrame) -> DataFrame:
    """hi, lo, sha256: of a node's conv_ids in order, joined by commas. Ranges of ids are joined first; a node with very many is then hashed from
    few long texts, one after the other."""
    ends = cut(ends)
    tasks, order = tasks_for(ends, ends.count()), [*NODE, "conv_id"]

    def join(rows):
        node, ids = None, []
        for hi, lo, conv in rows:
            if (hi, lo) != node or len(ids) == IDS:
                if ids:
                    yield *node, ids[0], ",".join(map(str, ids))
                node, ids = (hi, lo), []
            ids.append(conv)
        if ids:
            yield *node, ids[0], ",".join(map(str, ids))

    def digest(rows):
        node, made = None, None
        for hi, lo, _, text in rows:
            if (hi, lo) != node:
                if node is not None:
                    yield *node, made.hexdigest()
                node, made = (hi, lo), hashlib.sha256(text.encode())
            else:
                made.update(b"," + text.encode())
        if node is not None:
            yield *node, made.hexdigest()

    texts = mapped(ends.repartitionByRange(tasks, *order).sortWithinPartitions(*order), join, "hi bigint, lo bigint, first bigint, ids string")
    return mapped(texts.repartition(tasks, *NODE).sortWithinPartitions(*NODE, "first"), digest, "hi bigint, lo bigint, sha256 string")
