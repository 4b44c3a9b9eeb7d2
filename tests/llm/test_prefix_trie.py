"""The trie of conversations against a plain one, with shards, bands and queues of every size."""

import hashlib
import random
import zlib
from collections import defaultdict

import pyarrow.parquet as pq
import pytest
from pyspark import cloudpickle

from gridloom.llm import prefix_trie as pt
from gridloom.llm import workload

SMALL = "/root/testdata/sf0.001"
SCHEMA = "conv_id bigint, turn bigint, role string, text string"
NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain(rows):
    """Rows (conv_id, turn, role, text) with distinct turn numbers, as the query's result."""
    own = defaultdict(list)
    for c, t, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        own[c].append((role or "", text or ""))
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(set)
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 6
        seq = tuple(own.get(c - c % 100, [])[:h] + own[c][h:])
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
            if d:
                children[seq[: d - 1]].add(seq[:d])
        ends[seq].append(c)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[k] for k in children[node]) or 1
        saved[node] = sum(saved[k] for k in children[node]) + ((len(members[node]) - 1) * len(node[-1][1]) if node else 0)
    digest = lambda ids: hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    return sorted((m[0], len(n), members[n[:-1]][0] if n else -1, len(m), len(children[n]), leaves[n], saved[n], digest(ends[n])) for n, m in members.items())


def query(spark, df, tmp_path):
    df.write.mode("overwrite").parquet(str(tmp_path / "conversations.parquet"))
    got = workload.op11_prefix_trie(spark, str(tmp_path))
    assert got.columns == NAMES
    return sorted(tuple(-1 if x is None else x for x in r) for r in got.collect())


def talks(seed, convs=60, longest=9, words=2):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(700), convs) + [0, 100, 200]:
        for t in range(rng.randint(1, longest)):
            rows.append((c, t * 3 - 4, rng.choice(["user", None]), rng.choice(["x", "yy", None, "é🙂"][: words + 1])))
    return list({(r[0], r[1]): r for r in rows}.values())


@pytest.fixture
def tiny(monkeypatch):
    """Every limit at its smallest; functions go to the workers with these values."""
    cloudpickle.register_pickle_by_value(pt)
    yield lambda **kw: [monkeypatch.setattr(pt, name, value) for name, value in kw.items()]
    cloudpickle.unregister_pickle_by_value(pt)


@pytest.mark.parametrize("extra", [False, True])
def test_query_equals_a_plain_trie(spark, make, tmp_path, extra):
    rows = talks(1)
    assert query(spark, make(rows, SCHEMA, extra=extra), tmp_path) == plain(rows)


@pytest.mark.parametrize("band, light", [(3, 4), (2, 1), (1, 2), (4, 10_000)])
def test_bands_shards_and_queues_change_nothing(spark, make, tmp_path, tiny, band, light):
    tiny(BAND=band, LIGHT=light, IN_MEMORY=2, IDS=2, PER_TASK=40)
    rows = talks(band, convs=40, longest=14)
    assert query(spark, make(rows, SCHEMA), tmp_path) == plain(rows)


def test_one_conversation_and_one_beginning_hold_a_third(spark, make, tmp_path, tiny):
    tiny(BAND=16, LIGHT=20, PER_TASK=100)
    rows = [(5, t, "user", f"turn {t % 7}") for t in range(300)] + [(c, t, "user", "hello" if t == 0 else f"{c % 40} {t}") for c in range(1000, 1100) for t in range(3)]
    assert query(spark, make(rows, SCHEMA), tmp_path) == plain(rows)


def test_repeats_ties_and_missing_ids(spark, make, tmp_path):
    base = [(7, None, "user", "first"), (7, 0, None, None), (7, 1, "user", ""), (300, 1, "a", "t"), (301, 1, "a", "t")]
    assert query(spark, make([*base, (None, 1, "user", "lost")], SCHEMA), tmp_path) == plain(base)
    twice = query(spark, make([(1, 0, "u", "x")] * 3 + [(2, 4, "u", "x")], SCHEMA), tmp_path)
    assert twice == plain([(1, i, "u", "x") for i in range(3)] + [(2, 4, "u", "x")])
    tied = [(11, 0, "u", "b"), (11, 0, "u", "a"), (11, 0, "v", "a"), *((11, i, "u", "c") for i in range(1, 7))]
    assert query(spark, make(tied, SCHEMA), tmp_path) == query(spark, make(tied[::-1], SCHEMA), tmp_path)
    assert len({r[2] for r in pt.turns(make(tied[:3], SCHEMA)).collect()}) == 3


def test_empty_table_and_turnless_conversations(spark, make, tmp_path):
    assert query(spark, make([], SCHEMA), tmp_path) == []
    short = [(c, 0, "u", "only") for c in range(1, 60)]  # many lose their only turn to a conversation that is not there
    got = query(spark, make(short, SCHEMA), tmp_path)
    assert got == plain(short) and got[0][:4] == (1, 0, -1, 59)


def test_role_and_text_are_kept_apart_and_long_texts_count(spark, make, tmp_path):
    rows = [(1, 0, "ab", "c"), (2, 0, "a", "bc"), (3, 0, "", "abc"), *((c, 1, "u", "long " * 300_000) for c in range(1000, 1003))]
    assert query(spark, make(rows, SCHEMA), tmp_path) == plain(rows)


def test_queue_merges_what_it_has_written():
    rng = random.Random(2)
    for limit in (1, 3, 50):
        queue, held, out, want = pt.SpillingQueue(limit), [], [], []
        for _ in range(4000):
            if held and rng.random() < 0.45:
                assert queue.first() == min(held)
                out.append(queue.pop())
                want.append(min(held))
                held.remove(want[-1])
            else:
                item = (rng.randint(-50, 50), rng.randint(0, 3), 1)
                queue.push(item)
                held.append(item)
        while queue.first() is not None:
            out.append(queue.pop())
        assert out == want + sorted(held) and len(queue) == 0


def test_given_tables(spark):
    rows = list(zip(*pq.read_table(f"{SMALL}/conversations.parquet", columns=["conv_id", "turn", "role", "text"]).to_pydict().values(), strict=True))
    got = workload.op11_prefix_trie(spark, SMALL).collect()
    assert sorted(tuple(-1 if x is None else x for x in r) for r in got) == plain(rows)
