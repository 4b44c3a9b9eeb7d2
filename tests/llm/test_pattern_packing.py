"""Pattern packing against the tokenizer library, a plain best fit and the least number of sequences."""

import zlib

import numpy as np
import public_tokenizers as public
import pyarrow.parquet as pq
import pytest

from gridloom.llm import pattern_packing as pp
from gridloom.llm import workload

WORDS = public.path("word_bpe_49k.json")
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(WORDS)
    t.encode_special_tokens = True
    return lambda text: [*t.encode(text or "", add_special_tokens=False).ids, 1]


def plain_best_fit(lengths, capacity):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [i for i, room in enumerate(rooms) if room >= n]
        if fits:
            rooms[min(fits, key=rooms.__getitem__)] -= n
        else:
            rooms.append(capacity - n)
    return len(rooms)


def gapless(rows, capacity):
    """Number of sequences; every sequence is filled from 0 on without a gap."""
    by = rows.sort_values(["sequence_id", "offset"])
    expected = by.groupby("sequence_id").length.cumsum() - by.length
    assert (by.offset == expected).all()
    assert (by.groupby("sequence_id").length.sum() <= capacity).all()
    return by.sequence_id.nunique()


@pytest.mark.parametrize("seed", range(6))
def test_plan_uses_every_piece_once_and_few_sequences(seed):
    rng = np.random.default_rng(seed)
    capacity = int(rng.choice([1, 2, 7, 64, 100]))
    lengths = np.clip(rng.lognormal(2.5, 1.0, 600).astype(int), 1, capacity)
    if seed % 2:
        lengths[:200] = lengths[0]  # a third of all pieces have one length
    counts = np.bincount(lengths, minlength=capacity + 1)
    made = pp.plan(counts, capacity)
    spans = []
    for length in np.flatnonzero(counts):
        sequence, offset = made.place(np.full(counts[length], length), np.arange(counts[length]))
        spans += [(int(s), int(o), int(length)) for s, o in zip(sequence, offset, strict=True)]
    spans.sort()
    at, last = 0, -1
    for sequence, offset, length in spans:
        at = at if sequence == last else 0
        assert offset == at and offset + length <= capacity
        at, last = at + length, sequence
    assert len({s for s, _, _ in spans}) == made.sequences <= plain_best_fit(lengths, capacity) + 1
    assert made.sequences >= -(-int(lengths.sum()) // capacity)


def test_least_squares_meets_a_histogram_of_patterns():
    """Three long and three short lengths that only pair up one way: the fit is exact and nothing is left for best fit."""
    counts = np.zeros(101, np.int64)
    for a, n in ((90, 40), (75, 7), (60, 13)):
        counts[a] = counts[100 - a] = n
    patterns = pp.patterns_of(np.flatnonzero(counts), 100)
    assert sorted(map(tuple, patterns.tolist()))[-3:] == [(60, 40, 0), (75, 25, 0), (90, 10, 0)]
    chosen, x = pp.fitted(patterns, counts, np.ones(101))
    left = counts.copy()
    assert pp.rounded(patterns[chosen], x, left).sum() >= 55
    assert pp.plan(counts, 100).sequences == 60


def test_enumeration_is_complete():
    lengths = np.array([1, 2, 3, 5, 8, 13])
    want = {(a, b, 16 - a - b) for a in lengths for b in lengths if b <= a and 16 - a - b in {*lengths.tolist(), 0} and 16 - a - b <= b}
    assert {tuple(p) for p in pp.patterns_of(lengths, 16).tolist()} == want


@pytest.mark.parametrize("extra", [False, True])
def test_pack_keeps_documents_whole(make, library, extra):
    texts = [None, "", "  ", "x", "The same text. " * 9, "The same text. " * 9, "word " * 300, "l'été 日本語 🙂", *("some words " * i for i in range(1, 40))]
    rows = [(i if i != 3 else None, t) for i, t in enumerate(texts)] + [(0, "again")] * 30
    got = pp.pack(make(rows, extra=extra), WORDS, capacity=64).toPandas()
    assert list(got.columns) == ["doc_id", "piece", "start", "length", "ids", "sequence_id", "offset"]
    gapless(got, 64)
    whole = {}
    for r in got[got.doc_id > 0].sort_values(["doc_id", "piece"]).itertuples():
        assert r.start == len(whole.setdefault(r.doc_id, b"")) // 4 == r.piece * 64 and len(r.ids) == 4 * r.length
        whole[r.doc_id] += r.ids
    for i, text in enumerate(texts):
        if i not in (0, 3):
            assert np.frombuffer(whole[i], "<u4").tolist() == library(text)
    assert len(got[got.doc_id.isna()]) == 1 and len(got[got.doc_id == 0]) == 31
    cut_ones = got.groupby("doc_id").length.agg(["sum", "size"]).query("doc_id > 0")
    assert (cut_ones["size"] == -(-cut_ones["sum"] // 64)).all()


def test_empty_table_and_wrong_lengths(make, spark):
    assert pp.pack(make([]), WORDS).count() == 0
    with pytest.raises(ValueError, match="a piece of 9 tokens"):
        pp.assign(spark.createDataFrame([(9,)], "length bigint"), 8)


def test_columns_of_any_name_are_kept(spark):
    rows = spark.createDataFrame([(i, 1 + i % 5, "x") for i in range(50)], "_part int, length bigint, _number string")
    got = pp.assign(rows, 8).toPandas()
    assert sorted(got._part) == list(range(50)) and gapless(got, 8) == -(-int(got.length.sum()) // 8)


def test_a_long_text_is_cut_into_full_pieces(make, library):
    text = "many long words here " * 60_000
    got = pp.pack(make([(1, text), (2, "short")]), WORDS).toPandas().sort_values(["doc_id", "piece"])
    mine = got[got.doc_id == 1]
    assert (mine.length.iloc[:-1] == 4096).all() and b"".join(mine.ids) == np.array(library(text), "<u4").tobytes()


def test_query(spark, library):
    got = workload.op13_pattern_packing(spark, SMALL).toPandas()
    want = {}
    for doc, text in zip(*pq.read_table(f"{SMALL}/documents.parquet", columns=["doc_id", "text"]).to_pydict().values(), strict=True):
        ids = np.array(library(text), "<u4")
        for piece, start in enumerate(range(0, len(ids), 4096)):
            some = ids[start : start + 4096]
            want[doc, piece] = (start, len(some), zlib.crc32(some.tobytes()))
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in got.itertuples()} == want
    assert gapless(got, 4096) <= plain_best_fit(got.length.tolist(), 4096)
