"""All pairs of vectors with a cosine of at least a threshold, by dual traversal of cover trees.

Of unit vectors, cosine >= c means distance <= sqrt(2 - 2c). The top of the tree is a net over a bounded sample, with
nested levels and halving radii; every vector goes to its nearest centre there, a leaf, and a leaf's vectors are dealt into
blocks of bounded size, so a leaf with a third of all rows is many blocks. Each block holds a cover tree of its own. Pairs
of leaves, then of blocks, and in a pair of blocks the pairs of nodes level by level, are dropped when their centres are
further apart than both covering radii and the distance asked for. Covering radii are measured, so the top's sample only
matters for speed. What is left is compared in double precision: no pair is lost and none is guessed.

Equal vectors are one node with a count. A pair of blocks returns counts and, instead of its links, one link of each node
to the smallest node of its component among the two blocks.

Cases: vectors that are null, empty, zero or hold null or non-finite components, and rows with a null id, link with nothing;
vectors of another length link only among themselves; repeated rows are other vectors and count; other columns are not read.
"""

from __future__ import annotations

import math
import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import cut
from gridloom.llm.components import components

#: Vectors at most that the top of the tree is chosen from, and leaves of it at most.
SAMPLE, LEAVES = 4096, 1024
#: Vectors in a block, about.
BLOCK = 2000
#: Rounding of distances between unit vectors, far above what double precision needs.
SLACK = 1e-9


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=-1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=-1, keepdims=True))


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2 - 2 * (a @ b.T)))


def net(x: np.ndarray, radius: float, most: int, start: list[int]) -> list[int]:
    """Indices of points, ``start`` first, so that each point is within the radius of one; stops beyond ``most``."""
    chosen = list(start)
    far = distances(x, x[chosen]).min(axis=1)
    while len(chosen) <= most and far.max() > radius:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, distances(x, x[chosen[-1:]])[:, 0])
    return chosen


def top_centres(x: np.ndarray, wanted: int) -> np.ndarray:
    """The finest level, radii halving from 2, that has no more than ``wanted`` centres; nested in those above."""
    chosen, radius = [0], 2.0
    while radius > 1e-6:
        radius /= 2
        more = net(x, radius, wanted, chosen)
        if len(more) > wanted:
            # This level would be too fine: it is filled up to the number wanted, farthest first.
            return x[more[:wanted]]
        chosen = more
    return x[chosen]


def tree(x: np.ndarray, narrow: float) -> tuple[np.ndarray, list[dict]]:
    """An order of the points and the levels of a cover tree. Each node is a range of the order: centre (a point), covering
    radius, start, stop, and its parent's number in the level above."""
    order = np.arange(len(x))
    levels, radius = [], 2.0
    level = {"centre": np.array([0]), "start": np.array([0]), "stop": np.array([len(x)]), "parent": np.array([0])}
    while True:
        level["radius"] = np.array([distances(x[order[a:b]], x[c : c + 1]).max() for c, a, b in zip(level["centre"], level["start"], level["stop"], strict=True)])
        if len(levels) > 1 and len(level["centre"]) < 1.2 * len(levels[-1]["centre"]):
            # Hardly finer than the level above: it takes that one's place.
            level["parent"] = levels.pop()["parent"][level["parent"]]
        levels.append(level)
        # A node far narrower than the distance asked for prunes as well as its children would.
        split = (level["stop"] - level["start"] > 1) & (level["radius"] > narrow)
        if radius < 1e-6 or not split.any():
            return order, levels
        radius /= 2
        rows = []
        for number, (c, a, b) in enumerate(zip(level["centre"], level["start"], level["stop"], strict=True)):
            if not split[number]:
                rows.append((c, a, b, number))
                continue
            own = order[a:b].copy()
            here = int(np.flatnonzero(own == c)[0])
            picked = net(x[own], radius, b - a, [here])
            nearest = distances(x[own], x[own[picked]]).argmin(axis=1)
            nearest[picked] = np.arange(len(picked))  # a centre is its own, whatever lies on top of it
            by = np.argsort(nearest, kind="stable")
            order[a:b] = own[by]
            stops = a + np.cumsum(np.bincount(nearest, minlength=len(picked)))
            starts = np.concatenate([[a], stops[:-1]])
            rows += [(own[p], s, e, number) for p, s, e in zip(picked, starts, stops, strict=True) if e > s]
        level = {k: np.array(v) for k, v in zip(("centre", "start", "stop", "parent"), zip(*rows, strict=True), strict=True)}


def pack_block(ids: list[int], copies: list[int], raw: list[bytes], narrow: float) -> bytes:
    x = np.stack([np.frombuffer(r, "<f8") for r in raw])
    order, levels = tree(unit(x), narrow)
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    for level in levels:
        level["centre"] = place[level["centre"]]
    small = x.astype("<f4")
    stored = small if (small == x).all() else x  # float32 input needs no more
    return pickle.dumps((np.array(ids, np.int64)[order], np.array(copies, np.int64)[order], stored[order], levels))


def linked_pairs(one: tuple, two: tuple, reach: float, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Positions i, j of the links between two unpacked blocks."""
    _, _, raw_x, levels_x = one
    _, _, raw_y, levels_y = two
    raw_x, raw_y = raw_x.astype("<f8"), raw_y.astype("<f8")
    x, y = unit(raw_x), unit(raw_y)
    allowed = np.ones((1, 1), bool)
    for k in range(max(len(levels_x), len(levels_y))):
        a, b = levels_x[min(k, len(levels_x) - 1)], levels_y[min(k, len(levels_y) - 1)]
        if k:
            allowed = allowed[a["parent"] if k < len(levels_x) else slice(None)][:, b["parent"] if k < len(levels_y) else slice(None)]
        # Distance <= bound, as a product of unit vectors; in single precision, with more slack than that needs.
        bound = a["radius"].astype("f4")[:, None] + (b["radius"] + reach + 1e-3).astype("f4")[None, :]
        bound *= bound
        bound *= -0.5
        bound += 1.0
        allowed = allowed & (x[a["centre"]].astype("f4") @ y[b["centre"]].astype("f4").T >= bound)
        if not allowed.any():
            break
    found_i, found_j = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    a, b = levels_x[-1], levels_y[-1]
    for n in np.flatnonzero(allowed.any(axis=1)):
        rows = np.arange(a["start"][n], a["stop"][n])
        columns = np.concatenate([np.arange(b["start"][m], b["stop"][m]) for m in np.flatnonzero(allowed[n])])
        cosine = x[rows] @ y[columns].T
        # All within rounding of the threshold, from either side, so that the unit vectors' rounding decides nothing.
        i, j = np.nonzero(cosine >= least - SLACK)
        edge = np.flatnonzero(np.abs(cosine[i, j] - least) < SLACK)
        i, j = rows[i], columns[j]
        # Next to the threshold, from the vectors as they are.
        p, q = raw_x[i[edge]], raw_y[j[edge]]
        exact = (p * q).sum(1) / (np.sqrt((p * p).sum(1)) * np.sqrt((q * q).sum(1)))
        keep = np.ones(len(i), bool)
        keep[edge] = exact >= least
        found_i.append(i[keep])
        found_j.append(j[keep])
    return np.concatenate(found_i), np.concatenate(found_j)


def smallest_reachable(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For nodes 0..n-1, the smallest number of each one's component."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def prepared(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """vec_id, raw: the components as little-endian doubles, null where the vector cannot link."""
    kinds = pa.schema([("vec_id", pa.int64()), ("raw", pa.binary())])

    def run(batches):
        for batch in batches:
            raw = []
            for vector, i in zip(batch.column(1).to_pylist(), batch.column(0).to_pylist(), strict=True):
                ok = vector and i is not None and None not in vector
                x = np.array(vector, "<f8") + 0.0 if ok else np.zeros(1)
                raw.append(x.tobytes() if np.isfinite(x).all() and x.any() else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(raw, pa.binary())], schema=kinds)

    return vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v")).mapInArrow(run, "vec_id bigint, raw binary")


def leaves(nodes: DataFrame, n: int) -> tuple[DataFrame, dict]:
    """nodes with leaf and distance to its centre, and the centres by length of the vectors."""
    rows = nodes.select("raw", F.xxhash64("raw").alias("h")).filter(F.pmod("h", F.lit(1_000_000)) < math.ceil(1e6 * min(1.0, 0.9 * SAMPLE / max(n, 1)))).select("raw").limit(2 * SAMPLE).collect()
    by_length: dict[int, list] = {}
    for row in rows:
        by_length.setdefault(len(row.raw) // 8, []).append(np.frombuffer(row.raw, "<f8"))
    wanted = max(1, min(LEAVES, -(-n // BLOCK)))
    centres, first = {}, 0
    for length in sorted(by_length):
        found = top_centres(unit(np.stack(by_length[length])), wanted)
        centres[length] = (first, found)
        first += len(found)
    kinds = pa.schema([("node", pa.int64()), ("copies", pa.int64()), ("raw", pa.binary()), ("leaf", pa.int64()), ("away", pa.float64())])

    def run(batches):
        for batch in batches:
            leaf, away = [], []
            for raw in batch.column(2).to_pylist():
                # A length that the sample does not have is one leaf without a centre.
                got = centres.get(len(raw) // 8)
                if got is None:
                    leaf.append(-len(raw) // 8)
                    away.append(2.0)
                else:
                    d = distances(unit(np.frombuffer(raw, "<f8"))[None], got[1])[0]
                    leaf.append(got[0] + int(d.argmin()))
                    away.append(float(d.min()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(leaf, pa.int64()), pa.array(away)], schema=kinds)

    return nodes.select("node", "copies", "raw").mapInArrow(run, "node bigint, copies bigint, raw binary, leaf bigint, away double"), centres


def near_vectors(vectors: DataFrame, least: float = 0.9, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """Every row: vec_id, n_links, component_id, kept."""
    reach = math.sqrt(2 - 2 * least)
    rows = cut(prepared(vectors, id_col, vec_col))
    nodes = cut(rows.filter("raw IS NOT NULL").groupBy("raw").agg(F.min("vec_id").alias("node"), F.count("*").alias("copies")))
    n = nodes.count()
    placed, centres = leaves(nodes, n)
    placed = cut(placed)
    # One row for each leaf, LEAVES at most for each length of vectors.
    measured = {r.leaf: r for r in placed.groupBy("leaf").agg(F.max("away").alias("radius"), F.count("*").alias("n")).collect()}
    partners: dict[int, list[int]] = {leaf: [leaf] for leaf in measured if leaf < 0}
    for first, found in centres.values():
        own = [k for k in range(len(found)) if first + k in measured]
        radius = np.array([measured[first + k].radius for k in own])
        near = distances(found[own], found[own]) <= radius[:, None] + radius[None, :] + reach + SLACK
        for a, k in enumerate(own):
            partners[first + k] = [first + own[b] for b in np.flatnonzero(near[a]) if b >= a]
    counts = {leaf: max(1, -(-r.n // BLOCK)) for leaf, r in measured.items()}
    spark = vectors.sparkSession
    sizes = spark.createDataFrame(list(counts.items()), "leaf bigint, blocks bigint")
    keys = sizes.select("leaf", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    pairs = spark.createDataFrame([(a, b) for a, bs in partners.items() for b in bs], "leaf bigint, other bigint")
    pairs = pairs.join(keys, "leaf").join(keys.select(F.col("leaf").alias("other"), F.col("block").alias("other_block")), "other")
    pairs = pairs.filter("leaf < other OR block <= other_block").select("leaf", "block", "other", "other_block")
    dealt = placed.join(F.broadcast(sizes), "leaf").withColumn("block", F.pmod(F.xxhash64("node", "raw"), "blocks"))

    def build(key, table):
        data = pack_block(table["node"].to_pylist(), table["copies"].to_pylist(), table["raw"].to_pylist(), reach / 4)
        return pa.table({"leaf": [key[0].as_py()], "block": [key[1].as_py()], "data": [data]}, schema=pa.schema([("leaf", pa.int64()), ("block", pa.int64()), ("data", pa.binary())]))

    blocks = cut(dealt.select("leaf", "block", "node", "copies", "raw").groupBy("leaf", "block").applyInArrow(build, "leaf bigint, block bigint, data binary"))
    left = blocks.withColumnRenamed("data", "x")
    right = blocks.select(F.col("leaf").alias("other"), F.col("block").alias("other_block"), F.col("data").alias("y"))
    both = pairs.join(left, ["leaf", "block"]).join(right, ["other", "other_block"])
    kinds = pa.schema([("node", pa.int64()), ("links", pa.int64()), ("low", pa.int64())])

    def compare(batches):
        for batch in batches:
            for leaf, block, other, other_block, x, y in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                one, two = pickle.loads(x), pickle.loads(y)
                i, j = linked_pairs(one, two, reach, least)
                same = (leaf, block) == (other, other_block)
                if same:
                    i, j = i[i < j], j[i < j]
                if not len(i):
                    continue
                ids, copies = (one[0], one[1]) if same else (np.concatenate([one[0], two[0]]), np.concatenate([one[1], two[1]]))
                j = j if same else j + len(one[0])
                links = np.bincount(i, copies[j], len(ids)) + np.bincount(j, copies[i], len(ids))
                order = np.argsort(ids, kind="stable")
                rank = np.empty(len(ids), np.int64)
                rank[order] = np.arange(len(ids))
                low = ids[order][smallest_reachable(len(ids), rank[i], rank[j])[rank]]
                at = np.flatnonzero(links)
                yield pa.RecordBatch.from_arrays([pa.array(ids[at]), pa.array(links[at].astype(np.int64)), pa.array(low[at])], schema=kinds)

    work = both.select("leaf", "block", "other", "other_block", "x", "y")
    found = cut(work.mapInArrow(compare, "node bigint, links bigint, low bigint"))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    joined = components(found.select(F.col("node").alias("a"), F.col("low").alias("b")))
    named = nodes.join(links, "node", "left").join(joined, "node", "left")
    named = named.select("raw", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "node").alias("component_id"))
    good = rows.filter("raw IS NOT NULL").join(named, "raw").select("vec_id", "n_links", "component_id")
    bad = rows.filter("raw IS NULL").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return good.unionByName(bad).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
