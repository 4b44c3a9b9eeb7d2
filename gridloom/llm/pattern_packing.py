"""Pattern packing: documents into as few sequences as possible, whole, by non-negative least squares on their lengths.

Only the histogram of lengths matters for a plan, and it has at most ``capacity`` entries however large the corpus is.
Patterns of two or three lengths that fill a sequence exactly are enumerated, and the number of times each is used is
fitted to the histogram by non-negative least squares: a growing set of patterns, priced by the residual, each round solved
by projected gradients. The counts are rounded so that no length is used more often than it occurs, and what is left of the
histogram is packed by best fit, longest first, many equal pieces at a time.

The plan becomes slots: of each length, the first so many pieces go to one place of one pattern, the next to another. A piece
finds its slot by its number among the pieces of its length. Pieces are dealt out by ranges of (length, row), so a length
that a third of all pieces have is numbered by many tasks; only counts of tasks are summed up over them.

Cases: a null or empty text is its end token alone; texts above ``capacity`` tokens are cut into full pieces and a rest;
equal, repeated and null ids are packed each by itself; an empty table gives no rows; other columns are not read.
Long texts are tokenised whole, one at a time; batches are cut by bytes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from gridloom.llm.common import cut, free_name, slices
from gridloom.llm.packing import word_tokens

#: Rounds in which patterns are added, and steps of projected gradients in each.
ROUNDS, STEPS = 8, 30
#: Pieces that one task numbers, about.
PER_TASK = 2_000_000


@dataclass(frozen=True)
class Plan:
    """Slots in order of (length, first number): pieces first.. of a length go to sequences from ``sequence`` on, ``copies``
    in each, at ``offset`` and behind it. ``keys`` are the slots' first numbers over all lengths, ``bases`` those of lengths."""

    bases: np.ndarray
    keys: np.ndarray
    sequence: np.ndarray
    copies: np.ndarray
    offset: np.ndarray
    sequences: int

    def place(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of the pieces with these numbers among those of their length."""
        at = self.bases[length] + number
        slot = np.searchsorted(self.keys, at, "right") - 1
        inside = at - self.keys[slot]
        return self.sequence[slot] + inside // self.copies[slot], self.offset[slot] + inside % self.copies[slot] * length


def patterns_of(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """All pairs and triples of the given lengths that sum to capacity, as rows of three with 0 for none, longest first."""
    there = np.zeros(capacity + 1, bool)
    there[lengths] = True
    found = []
    for c in lengths[::-1].tolist():
        rest = capacity - c
        if 0 < rest <= c and there[rest]:
            found.append(np.array([[c, rest, 0]], np.int32))
        b = lengths[(lengths <= min(c, rest - 1)) & (2 * lengths >= rest)]
        b = b[there[rest - b]]
        if len(b):
            found.append(np.stack([np.full(len(b), c), b, rest - b], 1).astype(np.int32))
    return np.concatenate(found) if found else np.zeros((0, 3), np.int32)


def fitted(patterns: np.ndarray, wanted: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-negative least squares: chosen patterns (numbers) and how often to use each, to meet the wanted counts.

    ``weight`` is the cost of a length's squared residual. Patterns are priced by the gradient; each round takes up the best
    one for every longest length, then moves along projected gradients with Barzilai-Borwein steps.
    """
    heads = np.flatnonzero(np.diff(patterns[:, 0], prepend=-1))  # patterns lie in order of their longest length
    chosen, x, size = np.zeros(0, np.int64), np.zeros(0), len(wanted)
    weight = weight.copy()
    weight[0] = 0.0

    def residual(cols: np.ndarray, x: np.ndarray) -> np.ndarray:
        return wanted - np.bincount(cols.ravel(), np.repeat(x, 3), size)

    left = wanted.astype(float)
    for _ in range(ROUNDS):
        price = (weight * left)[patterns].sum(1)
        best = np.maximum.reduceat(price, heads)
        at = np.flatnonzero(price == np.repeat(best, np.diff(np.append(heads, len(price)))))
        at = at[np.unique(patterns[at, 0], return_index=True)[1]]
        fresh = np.setdiff1d(at[price[at] > 0.01 * weight[patterns[at]].sum(1)], chosen)
        if not len(fresh):
            break
        chosen, x = np.concatenate([chosen, fresh]), np.concatenate([x, np.zeros(len(fresh))])
        cols = patterns[chosen]
        slope = -(weight * residual(cols, x))[cols].sum(1)
        step = 0.1
        for _ in range(STEPS):
            moved = np.maximum(x - step * slope, 0.0)
            turned = -(weight * residual(cols, moved))[cols].sum(1)
            dx, dg = moved - x, turned - slope
            x, slope = moved, turned
            if (curve := dx @ dg) <= 0:
                break
            step = min(max((dx @ dx) / curve, 1e-3), 10.0)
        chosen, x = chosen[x > 1e-9], x[x > 1e-9]
        left = residual(patterns[chosen], x)
    return chosen, x


def rounded(cols: np.ndarray, x: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Whole numbers near x that use no length more often than ``left`` has it; ``left`` is what remains afterwards."""
    counts = np.zeros(len(x), np.int64)

    def take(i: int, most: int) -> None:
        some, copies = np.unique(cols[i][cols[i] > 0], return_counts=True)
        n = min(most, int((left[some] // copies).min()))
        counts[i] += n
        left[some] -= n * copies

    for i in np.argsort(-x, kind="stable").tolist():
        take(i, int(x[i]))
    for i in np.argsort(-(x - counts), kind="stable").tolist():
        take(i, 1)
    for i in np.argsort(-x, kind="stable").tolist():
        take(i, int(left.max(initial=0)))
    return counts


def best_fit(left: np.ndarray, capacity: int) -> list[tuple[tuple[tuple[int, int], ...], int]]:
    """Patterns of (length, copies) with repeats for the pieces in ``left``: longest first into the fullest sequence with
    room. Equal sequences are one group, so the work depends on the number of lengths and not on that of pieces."""
    from bisect import bisect_left, insort

    groups: dict[int, list[tuple[tuple[tuple[int, int], ...], int]]] = {}
    rooms: list[int] = []

    def put(room: int, made: tuple[tuple[int, int], ...], n: int) -> None:
        if n:
            if room not in groups:
                groups[room] = []
                insort(rooms, room)
            groups[room].append((made, n))

    for length in np.flatnonzero(left)[::-1].tolist():
        count = int(left[length])
        while count:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                made, n = groups[room].pop()
                if not groups[room]:
                    del groups[room], rooms[at]
            else:
                room, made, n = capacity, (), -(-count // (capacity // length))
            each = room // length
            full = min(n, count // each)
            put(room - each * length, (*made, (length, each)), full)
            count -= full * each
            if full < n:
                if count:
                    put(room - count * length, (*made, (length, count)), 1)
                    full, count = full + 1, 0
                put(room, made, n - full)
    return [item for listed in groups.values() for item in listed]


def plan(counts: np.ndarray, capacity: int) -> Plan:
    """The slots for ``counts[length]`` pieces of each length up to capacity."""
    left = counts.astype(np.int64)
    made: list[tuple[tuple[tuple[int, int], ...], int]] = [(((capacity, 1),), int(left[capacity]))] if left[capacity] else []
    left[capacity] = 0
    patterns = patterns_of(np.flatnonzero(left), capacity)
    if len(patterns):
        # A long piece that is left over costs more room than a short one, which fits into gaps.
        chosen, x = fitted(patterns, left, np.arange(capacity + 1) / capacity)
        cols = patterns[chosen]
        for row, n in zip(cols.tolist(), rounded(cols, x, left).tolist(), strict=True):
            if n:
                made.append((tuple((length, row.count(length)) for length in dict.fromkeys(row) if length), n))
    made += best_fit(left, capacity)
    slots, first = [], 0
    for pattern, n in made:
        offset = 0
        for length, copies in pattern:
            slots.append((length, first, copies, offset, n * copies))
            offset += length * copies
        first += n
    table = np.array(slots, np.int64).reshape(-1, 5)
    table = table[np.argsort(table[:, 0], kind="stable")]
    bases = np.cumsum(counts) - counts
    keys = np.cumsum(table[:, 4]) - table[:, 4]
    return Plan(bases.astype(np.int64), keys, table[:, 1], table[:, 2], table[:, 3], first)


def pieces(docs: DataFrame, path: str, capacity: int = 4096, end: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids (binary, little-endian unsigned 32-bit) of every document, cut only above capacity."""
    kinds = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary())])

    def run(batches):
        tokens = word_tokens(path)
        for batch in batches:
            for some in slices(batch, "text", 1 << 22):
                out: list[list] = [[] for _ in kinds]
                for doc, raw in zip(some.column(0).to_pylist(), tokens.encode(some.column(1).to_pylist()), strict=True):
                    ids = np.append(np.frombuffer(raw, "<u2"), np.uint16(end)).astype("<u4")
                    for piece, start in enumerate(range(0, len(ids), capacity)):
                        part = ids[start : start + capacity]
                        for column, value in zip(out, (doc, piece, start, len(part), part.tobytes()), strict=True):
                            column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, kinds, strict=True)], schema=kinds)

    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return texts.mapInArrow(run, "doc_id bigint, piece int, start bigint, length bigint, ids binary")


def assign(rows: DataFrame, capacity: int = 4096) -> DataFrame:
    """All columns of ``rows``, one row a piece with its ``length`` (1 to capacity), and sequence_id and offset."""
    part, number, row, total = (free_name(rows, x) for x in ("_part", "_number", "_row", "_total"))
    rows = cut(rows)
    tasks = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // PER_TASK))
    spread = cut(rows.withColumn(row, F.monotonically_increasing_id()).repartitionByRange(tasks, "length", row).drop(row))
    spread = spread.withColumn(part, F.spark_partition_id())
    # Ranges follow each other: no more entries than there are lengths and tasks.
    counts = cut(spread.groupBy(part, "length").agg(F.count("*").alias(total)))
    histogram = np.zeros(capacity + 1, np.int64)
    for length, n in counts.groupBy("length").agg(F.sum(total)).collect():
        if not 0 < length <= capacity:
            raise ValueError(f"a piece of {length} tokens")
        histogram[length] = n
    made = plan(histogram, capacity)
    before = F.sum(total).over(Window.partitionBy("length").orderBy(part)) - F.col(total)
    placed = spread.join(F.broadcast(counts.select(part, "length", before.alias(number))), [part, "length"]).select(*rows.columns, number)
    schema = StructType([*rows.schema.fields, StructField("sequence_id", LongType()), StructField("offset", LongType())])
    at, names = rows.columns.index("length"), [*rows.columns, "sequence_id", "offset"]

    def run(batches):
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            length = batch.column(at).to_numpy(zero_copy_only=False).astype(np.int64)
            order = np.argsort(length, kind="stable")
            ordered = length[order]
            first = np.searchsorted(ordered, ordered, "left")
            inside = np.empty(len(length), np.int64)
            inside[order] = np.arange(len(length)) - first
            found = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False) + seen[length] + inside
            seen += np.bincount(length, minlength=capacity + 1)
            sequence, offset = made.place(length, found)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sequence), pa.array(offset)], names=names)

    return placed.mapInArrow(run, schema)


def pack(docs: DataFrame, path: str, capacity: int = 4096, end: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces with ids, sequence_id and offset."""
    return assign(pieces(docs, path, capacity, end, id_col, text_col), capacity)
