"""Alignment of two tokenizers against the libraries and plain loops over bytes."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as public
import pyarrow.parquet as pq
import pytest

from gridloom.llm import token_alignment as ta
from gridloom.llm import workload

A, B = public.path("byte_bpe_50k.json"), public.path("piece_bpe_32k.model")
SMALL = "/root/testdata/sf0.001"
ODD = [
    None, "", " ", "  ", "\n", "\xa0", "a", " a", "a ", "\n a \n\n b\t c  ", "x = {};\r\n\r\ny();\r", "l'été don't I'LL", "İstanbul ΣΣ ẞ", "x\x1cy\x85z\xa0w \xa0q",
    "日本語 テスト 123", "🙂🙂 👍🏽!!!", "<|endoftext|> <s> </s> <unk> <0x0A> x", "has ▁ in it", "▁", "\x00\x01 b", "a" * 3000 + " " * 300 + "b", "é" * 50, "Ã©", "﻿x ‍",
]


def noise(n=120):
    rng = random.Random(11)
    return ["".join(rng.choice("ab'sd \n\t.,é1 \r\xa0ß中\U0001f600;)}") for _ in range(50)) for _ in range(n)]


class Plain:
    """What the libraries give, and groups and links by walking over bytes."""

    def __init__(self):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(A)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=B)
        self.chars = ta.byte_level()

    def ids(self, text):
        return self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text, num_threads=1)

    def tokens(self, text):
        a, b = self.ids(text)
        bytes_a = [bytes(self.chars[c] for c in self.a.id_to_token(i)) for i in a]
        bytes_b = [bytes([int(self.b.id_to_piece(i)[3:-1], 16)]) if self.b.is_byte(i) else self.b.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not text or not (b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode()):
            return [], []
        spans = []
        for ids, parts in ((a, bytes_a), (b, bytes_b)):
            ends = np.cumsum([0, *map(len, parts)]).tolist()
            spans.append(list(zip(ids, ends, ends[1:], strict=False)))
        return spans

    def links(self, a, b):
        return [(i, j) for i, s, e in a for j, t, f in b if s < f and t < e]

    def groups(self, a, b):
        common = sorted({e for _, _, e in a} & {e for _, _, e in b})
        part = lambda tokens, lo, hi: ",".join(str(i) for i, s, e in tokens if lo <= s and e <= hi)
        return [f"{part(a, lo, hi)}|{part(b, lo, hi)}" for lo, hi in zip([0, *common], common, strict=False)]

    def all(self, texts):
        found = [self.tokens(t or "") for t in texts]
        links = [self.links(*x) for x in found]
        held = Counter(p for x in links for p in set(x))
        highest = defaultdict(int)
        for (a, _), n in held.items():
            highest[a] = max(highest[a], n)
        rows = []
        for (a, b), mine in zip(found, links, strict=True):
            groups = self.groups(a, b)
            rows.append((len(a), len(b), len(groups), len(mine), sum(held[p] == highest[p[0]] for p in mine), sum(held[p] for p in mine), ";".join(groups)))
        return rows, held, highest


@pytest.fixture(scope="module")
def plain():
    return Plain()


NAMES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]


def rows_by_id(df):
    return {r.doc_id: tuple(getattr(r, n) for n in NAMES) for r in df.toPandas().itertuples()}


def test_ids_equal_the_libraries(plain):
    texts = [t for t in ODD if t] + noise()
    for a, b, text in zip(*(x.to_pylist() for x in ta.tokenizers(A, B).encode([" " + t for t in texts])), texts, strict=True):
        assert (a, b) == plain.ids(text)


@pytest.mark.parametrize("extra", [False, True])
def test_alignment_equals_plain_loops(make, plain, extra):
    texts = [*ODD, *noise(40), *["the same words, here and there"] * 9]
    docs, pairs = ta.correspondences(make(list(enumerate(texts)), extra=extra), A, B)
    want, held, highest = plain.all(texts)
    assert rows_by_id(docs) == dict(enumerate(want))
    assert {(r.a, r.b): (r.n, r.best) for r in pairs.toPandas().itertuples()} == {p: (n, n == highest[p[0]]) for p, n in held.items()}


def test_small_blocks_tasks_and_memories_change_nothing(make, plain, monkeypatch):
    """Every batch, chunk, salt and partial count is at its smallest; functions go to the workers with these values."""
    from pyspark import cloudpickle

    for name, value in {"BATCH": 60, "CHUNK": 100, "PER_TASK": 20, "PARTIAL": 3, "WORDS": 5}.items():
        monkeypatch.setattr(ta, name, value)
    cloudpickle.register_pickle_by_value(ta)
    try:
        texts = [*ODD[:12], *noise(20), *["the same words, here and there"] * 12]
        docs, _ = ta.correspondences(make(list(enumerate(texts))), A, B)
        assert rows_by_id(docs) == dict(enumerate(plain.all(texts)[0]))
    finally:
        cloudpickle.unregister_pickle_by_value(ta)


def test_repeated_and_null_ids_are_rows_of_their_own(make, plain):
    texts = ["one two", "one two", "three", None, "one"]
    docs, _ = ta.correspondences(make([(None, texts[0]), (None, texts[1]), (7, texts[2]), (7, texts[3]), (7, texts[4])]), A, B, digest=True)
    got = sorted(tuple(getattr(r, n) for n in NAMES) for r in docs.toPandas().itertuples())
    assert got == sorted((*r[:6], hashlib.sha256(r[6].encode()).hexdigest() if r[6] else "") for r in plain.all(texts)[0])


def test_no_rows_and_no_tokens(make):
    docs, pairs = ta.correspondences(make([]), A, B)
    assert docs.count() == 0 and pairs.count() == 0
    docs, pairs = ta.correspondences(make([(1, None), (2, "▁")]), A, B)
    assert rows_by_id(docs) == {1: (0,) * 6 + ("",), 2: (0,) * 6 + ("",)} and pairs.count() == 0


def test_a_long_text(make, plain):
    text = "some words, und noch 'was; " * 20_000
    docs, _ = ta.correspondences(make([(1, text), (2, "x")]), A, B)
    got = rows_by_id(docs)[1]
    a, b = plain.ids(text)
    assert got[:2] == (len(a), len(b)) and got[3] == len(a) + len(b) - got[2] and got[6].count(";") == got[2] - 1
    assert [int(i) for g in got[6].split(";") for i in g.split("|")[0].split(",")] == a


def test_blocks_give_back_what_they_hold():
    rng = np.random.default_rng(3)
    doc, pair = (x.astype(t) for x, t in zip(np.unique(rng.integers(0, [[60_000], [1 << 32]], (2, 5000)), axis=1), (np.int32, np.uint32), strict=True))
    n = rng.integers(1, 1 << 31, len(doc))
    got = []
    made, counts = ta.blocks(doc, pair, n)
    for bucket, data in made:
        distinct, held, docs, times = ta.unpacked(data)
        assert (ta.bucket_of(distinct) == bucket).all()
        got += zip(docs.tolist(), np.repeat(distinct, held).tolist(), times.tolist(), strict=True)
    assert sorted(got) == sorted(zip(doc.tolist(), pair.tolist(), n.tolist(), strict=True))
    assert dict(zip(*counts.to_pydict().values(), strict=True)) == Counter(pair.tolist())


def test_query(spark, plain):
    got = workload.op12_token_alignment(spark, SMALL).toPandas().set_index("doc_id")
    table = pq.read_table(f"{SMALL}/documents.parquet", columns=["doc_id", "text"]).to_pydict()
    want, *_ = plain.all(table["text"]) if sum(map(len, table["text"])) < 200_000 else (None,)
    assert len(got) == len(table["doc_id"]) and list(got.columns) == [*NAMES[:-1], "groups_sha256"]
    for k, (i, text) in enumerate(zip(table["doc_id"], table["text"], strict=True)):
        if want:
            assert tuple(got.loc[i])[:6] == want[k][:6] and got.groups_sha256[i] == hashlib.sha256(want[k][6].encode()).hexdigest()
        else:
            a, b = plain.ids(text)
            assert (got.n_a[i], got.n_b[i]) == (len(a), len(b)) and got.n_links[i] == len(a) + len(b) - got.n_groups[i]
