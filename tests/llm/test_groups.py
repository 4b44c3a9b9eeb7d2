"""Sharding, exact dedup, the n-gram join and the cover tree against brute force."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.llm import common, cover_tree, exact_dedup, jaccard_join, sharding
from gridloom.llm.components import are_stars, components


def roots(links, nodes):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_permutation_is_a_bijection():
    for n in (1, 2, 3, 7, 64, 1000, 4097):
        got = sharding.permute(np.arange(n), n, seed=3)
        assert sorted(got) == list(range(n))
    assert list(sharding.permute(np.arange(50), 50, 1)) != list(sharding.permute(np.arange(50), 50, 2))


def test_shards_are_even_and_gapless(make, monkeypatch):
    monkeypatch.setattr(sharding, "RUN", 7)  # copies are numbered in many runs
    rows = make([(i % 97 if i % 5 else None, f"t{i % 13}") for i in range(500)] + [(1, "same")] * 300, extra=True)
    plan = sharding.shard_plan(rows, ["doc_id", "text"], 7).toPandas()
    sizes = plan.groupby("shard").size()
    assert len(plan) == 800 and sizes.max() - sizes.min() <= 1
    for _, part in plan.groupby("shard"):
        assert sorted(part.slot) == list(range(len(part)))
    again = sharding.shard_plan(rows.repartition(11), ["doc_id", "text"], 7).toPandas()
    key = ["doc_id", "text", "shard", "slot"]
    assert sorted(map(str, plan[key].values.tolist())) == sorted(map(str, again[key].values.tolist()))
    assert sharding.shard_plan(make([]), ["doc_id", "text"], 7).count() == 0


@pytest.mark.parametrize("k", [2, 1000])
def test_exact_groups(make, k):
    rng = random.Random(1)
    texts = [None, "", " \n", "a b", "ab", "a  b ", "x y", "xy"] + [rng.choice(["hot text", "hot  text", "rare"]) + " " * rng.randint(0, 3) for _ in range(300)]
    rows = list(enumerate(texts))
    got = exact_dedup.exact_groups(make(rows, extra=True), k=k).toPandas().set_index("doc_id")
    norm = {i: "".join(c for c in (t or "") if c not in " \t\n\x0b\x0c\r") for i, t in rows}
    for i, _ in rows:
        group = [j for j, _ in rows if norm[j] == norm[i]]
        keep = min(group, key=lambda j: (-len(texts[j] or ""), j))
        assert (got.keep_id[i], got.group_size[i], got.kept[i]) == (keep, len(group), keep == i)
        assert got.digest[i] == hashlib.sha256(norm[i].encode()).digest()


def test_keep_one_of_repeated_rows(make):
    rows = [(1, "a b"), (1, "a b"), (1, "other"), (2, "ab"), (3, None), (4, ""), (None, "alone")]
    kept = exact_dedup.keep_one(make(rows, extra=True))
    assert "node" in kept.columns
    assert sorted(map(str, kept.select("doc_id", "text").toPandas().values.tolist())) == sorted(map(str, [[1.0, "a b"], [1.0, "other"], [3.0, None], [float("nan"), "alone"]]))
    assert exact_dedup.exact_groups(make([])).count() == 0 and exact_dedup.keep_one(make([])).count() == 0


def test_components(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 40)] + [(rng.randint(200, 300), rng.randint(200, 300)) for _ in range(60)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    want = roots(links, {n for link in links for n in link})
    assert got == {n: r for n, r in want.items() if any(n in link and link[0] != link[1] for link in links)}


def test_links_that_are_stars_need_no_round(spark, monkeypatch):
    made = []
    monkeypatch.setattr("gridloom.llm.components.cut", lambda df: made.append(0) or common.cut(df))
    frame = lambda links: spark.createDataFrame(links, "u bigint, v bigint")
    assert all(are_stars(frame(x)) for x in ([], [(2, 1)], [(2, 1), (3, 1), (5, 4)]))
    assert not any(are_stars(frame(x)) for x in ([(2, 1), (3, 2)], [(3, 1), (3, 2)], [(2, 1), (5, 4), (5, 3)]))
    got = components(frame([(1, i) for i in range(2, 40)] + [(50, 60)]), "u", "v")
    assert {r.node: r.component for r in got.collect()} == {i: 1 for i in range(1, 40)} | {50: 50, 60: 50}
    assert len(made) == 1


def near_texts():
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(4))
    texts = [None, "", " ", "one", "ONE", "one two three", "One  two\nthree", "a b c d", "é É"]
    for size in (6, 9, 14, 25, 60, 300):
        for _ in range(6):
            base = [word() for _ in range(size)]
            texts.append(" ".join(base))
            for edits in range(1, 6):
                other = list(base)
                for _ in range(edits):
                    other[rng.randrange(len(other))] = word()
                texts.append(" ".join(other))
            texts.append(" ".join([*base, word()]))
            texts.append(" ".join(base[1:]).upper())
    return texts


def brute_components(texts, scheme):
    sets = [jaccard_join.elements((t or "").encode(), scheme.n) for t in texts]
    links = [(i, j) for i in range(len(sets)) for j in range(i) if (n := len(sets[i] & sets[j])) and 100 * n >= scheme.percent * (len(sets[i]) + len(sets[j]) - n)]
    return sets, roots(links, range(len(sets))), links


@pytest.mark.parametrize("scheme", [jaccard_join.Scheme(), jaccard_join.Scheme(5, 80)])
def test_near_groups_equal_brute_force(make, scheme):
    texts = near_texts()
    sets, want, links = brute_components(texts, scheme)
    got = jaccard_join.near_groups(make(list(enumerate(texts)), extra=True), scheme).toPandas().set_index("doc_id")
    assert len(links) > 100
    assert got.component_id.to_dict() == want
    assert got.n_shingles.to_dict() == {i: len(s) for i, s in enumerate(sets)}


def test_near_groups_odd_rows(make):
    rows = [(1, "a b c d e"), (1, "v w x y z"), (2, "A B C D E"), (3, "v w x y z"), (None, "a b c d e"), (5, None)]
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.near_groups(make(rows)).collect()}
    assert got == {(1, 2, 1), (2, 2, 1), (3, 2, 1), (None, 2, None), (5, 0, 5)}
    assert jaccard_join.near_groups(make([])).count() == 0


def test_keys_lose_no_pair():
    """Every linked pair of sets shares a key, in each band and next to its ends."""
    scheme, rng = jaccard_join.Scheme(), np.random.default_rng(6)
    for size in [*range(1, 40), 80, 81, 105, 106, 300, 517, 518, 700]:
        for _ in range(12):
            base = np.unique(rng.integers(0, 1 << 63, size, np.uint64))
            gone = int(rng.integers(0, 1 + scheme.most_different(2 * size)))
            left = np.delete(base, rng.permutation(len(base))[: gone // 2])
            right = np.unique(np.concatenate([base[: len(base)], rng.integers(0, 1 << 63, gone - gone // 2, np.uint64)]))
            both = len(np.intersect1d(left, right))
            if both and 100 * both >= scheme.percent * (len(left) + len(right) - both):
                assert len(np.intersect1d(jaccard_join.keys_of(left, scheme), jaccard_join.keys_of(right, scheme)))
            differ = np.abs(jaccard_join.folded([jaccard_join.histogram(left)], 16) - jaccard_join.folded([jaccard_join.histogram(right)], 16)).sum()
            assert differ <= len(left) + len(right) - 2 * both


def test_long_texts_hash_as_one():
    text = b" ".join(b"w%d" % (i * 7919) for i in range(400_000))
    parts = jaccard_join.word_hashes(text)
    assert len(text) > jaccard_join.LONG and len(parts) == 400_000
    assert (parts[:5] == jaccard_join.word_hashes(text[:40])[:5]).all()


def test_words_that_power_sums_confuse_stay_apart(spark):
    """A Thue-Morse word and its complement have the same power sum modulo 2**64 of any two letters."""
    word = "a"
    while len(word) < 1024:
        word += word.translate({97: 98, 98: 97})
    other = word.translate({97: 98, 98: 97})
    assert jaccard_join.word_hashes(word.encode()) != jaccard_join.word_hashes(other.encode())
    docs = spark.createDataFrame([(1, f"{word} x y z"), (2, f"{other} x y z"), (3, f"{word.upper()} x y z")], "doc_id bigint, text string")
    got = jaccard_join.near_groups(docs).toPandas().set_index("doc_id")
    assert got.component_id.to_dict() == {1: 1, 2: 2, 3: 1}


def test_word_hashes_depend_on_the_word_alone():
    text = b"one two " + b"long" * 100 + b" one  ab ba"
    found = jaccard_join.word_hashes(text)
    assert [int(jaccard_join.word_hashes(w)[0]) for w in text.split()] == found.tolist()
    assert found[0] == found[3] and len(set(found.tolist())) == 5 and not len(jaccard_join.word_hashes(b" "))


@pytest.mark.parametrize("block", [40, 2000])
def test_cover_tree_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(cover_tree, "BLOCK", block)
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(12, 16))
    x = np.concatenate([c + rng.normal(scale=s, size=(20, 16)) for c in centres for s in (0.1, 0.4)]).astype(np.float32)
    x[50:60] = x[40]
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    odd = [(900, None), (901, []), (902, [0.0] * 16), (903, [float("nan")] * 16), (904, [1.0, None]), (905, [1.0, 2.0]), (906, [2.0, 4.0]), (None, [1.0] * 16)]
    table = spark.createDataFrame(rows + odd, "vec_id bigint, embedding array<float>").withColumn("node", F.lit("x")).repartition(5)
    got = cover_tree.near_vectors(table, 0.9).toPandas()
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    want = roots([(i, j) for i, j in zip(*np.nonzero(near), strict=True) if i != j], range(len(x)))
    by = got.dropna(subset=["vec_id"]).set_index("vec_id")
    assert [by.n_links[i] for i in range(len(x))] == (near.sum(1) - 1).tolist()
    assert [by.component_id[i] for i in range(len(x))] == [want[i] for i in range(len(x))]
    assert [by.n_links[i] for i in range(900, 907)] == [0, 0, 0, 0, 0, 1, 1] and by.component_id[906] == 905
    assert len(got) == len(rows) + len(odd)
    assert cover_tree.near_vectors(table.limit(0)).count() == 0


def test_keys_of_the_index_are_dealt_by_bucket_without_copies():
    import tracemalloc

    rng = np.random.default_rng(9)
    keys = [rng.integers(0, 1 << 63, 1000, np.uint64) * np.uint64(2) for _ in range(200)]
    tracemalloc.start()
    bucket, data = jaccard_join.by_bucket(list(range(200)), keys, 16)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    data.validate(full=True)
    got = {(b, int(k), int(n)) for b, x in zip(bucket.to_pylist(), data.to_pylist(), strict=True) for k, n in np.frombuffer(x, np.dtype([("key", "<u8"), ("node", "<i8")]))}
    assert got == {(int(k) >> 60, int(k), n) for n, some in enumerate(keys) for k in some}
    assert peak < 3 * 16 * 200_000, "the pairs are held once, beside what sorts them"
