"""Packing and byte-level BPE against the tokenizer libraries."""

import base64
import random
import zlib

import numpy as np
import public_tokenizers as public
import pytest

from gridloom.llm import byte_bpe, packing

ODD = [None, "", "  ", "a\tb \n\n c  ", "l'été don't I'LL", "İstanbul ΣΣ ẞ École Å ﬁ", "x\x1cy\x85z\xa0w", "日本語 テスト 123", "🙂🙂 👍🏽!!!", "<|endoftext|> x", "\x00\x01", "a" * 3000 + " " * 300 + "b", "ǅ ᾳ Ω K"]
WORDS = public.path("word_bpe_49k.json")
RANKS = public.path("byte_bpe_50k.tiktoken")


def noise(n=150):
    rng = random.Random(7)
    return ["".join(rng.choice("ab'sd \n\t.,é1 　ß中\U0001f600") for _ in range(60)) for _ in range(n)]


def library_ids(text):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(WORDS)
    t.encode_special_tokens = True
    return t.encode(text, add_special_tokens=False).ids


def test_word_tokens_equal_the_library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(WORDS)
    t.encode_special_tokens = True
    texts = [x or "" for x in ODD] + noise()
    want = [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u2").tolist() for x in packing.word_tokens(WORDS).encode(texts)] == want


@pytest.mark.parametrize("extra", [False, True])
def test_pack_cuts_without_gaps(make, extra):
    texts = [*ODD, "The same text. " * 40, "The same text. " * 40, "word " * 3000]
    rows = [(i if i != 3 else None, t) for i, t in enumerate(texts)] + [(0, "again")]
    pieces = packing.pack(make(rows, extra=extra), WORDS, window=256).toPandas()
    by = pieces.sort_values(["sequence_id", "offset"])
    assert by.groupby("sequence_id").length.sum().iloc[:-1].eq(256).all() and by.sequence_id.nunique() == by.sequence_id.max() + 1
    at = 0
    for r in by.itertuples():
        assert r.sequence_id * 256 + r.offset == at
        at += r.length
    whole = {}
    for r in pieces[pieces.doc_id.between(1, 99)].sort_values(["doc_id", "start"]).itertuples():
        whole[r.doc_id] = whole.get(r.doc_id, b"") + r.ids
        assert r.length * 4 == len(r.ids)
    for i, t in enumerate(texts):
        if i not in (0, 3):
            assert np.frombuffer(whole[i], "<u4").tolist() == [*library_ids(t or ""), 1]


def test_sequences_are_padded_at_the_end_only(make):
    pieces = packing.pack(make([(i, "some words here " * i) for i in range(30)]), WORDS, window=64)
    made = packing.sequences(pieces, window=64).toPandas().sort_values("sequence_id")
    assert (made.ids.map(len) == 256).all() and (made.n_padding.iloc[:-1] == 0).all()
    first = pieces.toPandas().sort_values(["sequence_id", "offset"])
    assert zlib.crc32(b"".join(first.ids)) == zlib.crc32(b"".join(r.ids[: 4 * r.n_tokens] for r in made.itertuples()))


def test_empty_tables(make):
    empty = make([])
    assert packing.pack(empty, WORDS).count() == 0
    assert byte_bpe.encode_and_decode(empty, RANKS, public.PATTERN).count() == 0


@pytest.fixture(scope="module")
def tiktoken_encoding():
    import tiktoken

    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_the_library(make, tiktoken_encoding):
    texts = [*ODD, *noise()]
    rows = byte_bpe.encode_and_decode(make(list(enumerate(texts)), extra=True), RANKS, public.PATTERN).toPandas().set_index("doc_id")
    for i, text in enumerate(texts):
        assert np.frombuffer(rows.ids[i], "<u4").tolist() == tiktoken_encoding.encode_ordinary(text or "")
        assert rows.decoded[i] == (text or "").encode() and rows.n_tokens[i] * 4 == len(rows.ids[i])


def test_prefix_table_appends_and_edits():
    ranks = byte_bpe.encoder(RANKS, public.PATTERN).ranks
    rng = random.Random(5)
    for _ in range(60):
        data = bytes(rng.choice(b"abcdeing the") for _ in range(rng.randint(0, 120)))
        table = byte_bpe.Prefixes(ranks)
        for i in range(0, len(data), 7):
            table.append(data[i : i + 7])
        assert table.last == byte_bpe.Prefixes(ranks, data).last
        at = rng.randint(0, len(data))
        removed, added = rng.randint(0, len(data) - at), bytes(rng.choice(b"xyz the") for _ in range(rng.randint(0, 9)))
        table.edit(at, removed, added)
        fresh = byte_bpe.Prefixes(ranks, data[:at] + added + data[at + removed :])
        assert table.data == fresh.data and table.last == fresh.last
        assert fresh.tokens() == ranks.merged(fresh.data)
