"""Byte-level BPE by dynamic programming over prefixes.

Of the encodings of a byte string, exactly one is what merging by rank gives, and its last token depends on the prefix
alone. So for each prefix the one valid last token is stored: a token t that ends there is it if t is a token that merging
makes, and if merging would leave t and the last token of the prefix before t apart. The encoding is read off backwards.
A stored table can be appended to exactly, and an edit only asks for prefixes from the edit on.

Texts are parted by the pattern first; each match is encoded by itself. Words with equal beginnings share the table: the
new matches of a batch are sorted, and each goes on from what it has in common with the one before.

Cases: null counts as empty and has no ids; empty tables give no rows; copies are encoded each by itself, and a table of
distinct words, bounded and without influence on results, saves most of the work; other columns are not read.
"""

from __future__ import annotations

import base64
import re
import struct
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import Recent, no_cycles

#: Distinct matches and token pairs that a worker remembers in each of two generations.
MATCHES, PAIRS = 300_000, 400_000
#: The ASCII and Latin-1 characters of the classes in a pattern: letters, numbers, white space.
LATIN = {r"\p{L}": "A-Za-zªµºÀ-ÖØ-öø-ÿ", r"\p{N}": "0-9²³¹¼½¾", r"\s": "\\t-\\r \x85\xa0"}


class Ranks:
    """A vocabulary of byte strings by rank, with what the dynamic programme needs of it."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.longest = max(map(len, ranks))
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.bytes_of[i] = token
        # White space as Unicode has it, whatever the regular expression library takes for it.
        self.split = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
        # Every end of a token, with the token's id if it is one that merging makes, else -1.
        self.ends: dict[bytes, int] = {}
        for token in ranks:
            for i in range(len(token)):
                self.ends.setdefault(token[i:], -1)
        for token, i in ranks.items():
            if self.merged(token) == [i]:
                self.ends[token] = i
        self.apart = Recent(PAIRS)

    def merged(self, data: bytes) -> list[int]:
        """Plain merging, lowest rank first; for strings of one or two tokens."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            best = min(((self.ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in self.ranks), default=None)
            if best is None:
                break
            i = best[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[p] for p in parts]

    def stay_apart(self, left: int, right: int) -> bool:
        pair = left << 32 | right
        known = self.apart.young.get(pair)
        if known is None:
            if unknown := self.apart.lacking({pair}):
                self.apart.young[unknown[0]] = self.merged(self.bytes_of[left] + self.bytes_of[right]) == [left, right]
            known = self.apart.young[pair]
        return known


class Prefixes:
    """The last token of each prefix of one byte string."""

    def __init__(self, ranks: Ranks, data: bytes = b""):
        self.ranks, self.data, self.last = ranks, b"", [-1]
        self.append(data)

    def append(self, more: bytes) -> None:
        """Exact: what is stored for the prefixes so far holds on."""
        ranks, ends, last = self.ranks, self.ranks.ends, self.last
        start = len(self.data)
        self.data = data = self.data + more
        for i in range(start + 1, len(data) + 1):
            found, j = [], i - 1
            while j >= 0 and (token := ends.get(data[j:i])) is not None:
                if token >= 0:
                    found.append((j, token))
                j -= 1
            for j, token in reversed(found):
                if j == 0 or ranks.stay_apart(last[j], token):
                    last.append(token)
                    break
            else:
                raise ValueError("the vocabulary lacks single bytes")

    def keep(self, n: int) -> None:
        """Back to the first n bytes."""
        self.data = self.data[:n]
        del self.last[n + 1 :]

    def edit(self, at: int, removed: int, added: bytes) -> None:
        """Replace bytes; only prefixes that end after the edit's start are asked for again. Behind the edit, once both
        the tokens and the bytes of the longest token's reach agree with what was stored, the old table holds on."""
        old, tail, shift = self.last, self.data[at + removed :], len(added) - removed
        self.data, self.last = self.data[:at], old[: at + 1]
        self.append(added)
        agree, reach = 0, self.ranks.longest
        for k in range(len(tail)):
            if agree >= reach:
                self.data += tail[k:]
                self.last += old[at + removed + k + 1 :]
                return
            self.append(tail[k : k + 1])
            agree = agree + 1 if self.last[-1] == old[len(self.data) - shift] else 0

    def tokens(self) -> list[int]:
        out, i = [], len(self.data)
        while i:
            out.append(self.last[i])
            i -= len(self.ranks.bytes_of[self.last[i]])
        return out[::-1]


def latin(pattern: str) -> re.Pattern:
    """The pattern for texts without other characters, with its classes spelled out, inside brackets or not."""
    inside = re.sub(r"\[[^\]]*\]", lambda m: re.sub(r"\\p\{[LN]\}|\\s", lambda k: LATIN[k[0]], m[0]), pattern)
    plain = re.sub(r"\\p\{[LN]\}|\\s(?![^\[]*\])", lambda k: f"[{LATIN[k[0]]}]", inside)
    return re.compile(plain.replace(r"\S", f"[^{LATIN[chr(92) + 's']}]"))


class Encoder:
    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as file:
            self.ranks = Ranks({base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}, pattern)
        self.latin = latin(pattern)
        self.matches = Recent(MATCHES)

    def learn(self, new: list[str]) -> None:
        ranks, table, known = self.ranks, Prefixes(self.ranks), self.matches.young
        for data, match in sorted((m.encode("utf-8", "replace"), m) for m in new):
            if (whole := ranks.ranks.get(data)) is not None:
                ids = [whole]
            else:
                same, most = 0, min(len(data), len(table.data))
                while same < most and data[same] == table.data[same]:
                    same += 1
                table.keep(same)
                table.append(data[same:])
                ids = table.tokens()
            known[match] = struct.pack(f"<{len(ids)}I", *ids)

    def split(self, text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.ranks.split.findall(text)
        return self.latin.findall(text)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        with no_cycles():
            found = [self.split(text) for text in texts]
            self.learn(self.matches.lacking(set().union(*found)))
            known = self.matches.young.__getitem__
            return [b"".join(map(known, some)) for some in found]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.ranks.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@cache
def encoder(path: str, pattern: str) -> Encoder:
    return Encoder(path, pattern)


def encode_and_decode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (binary, little-endian unsigned 32-bit), n_tokens, decoded (binary): ids turned back into bytes."""
    kinds = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("n_tokens", pa.int64()), ("decoded", pa.binary())])

    def run(batches):
        tool = encoder(path, pattern)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                some = batch.slice(start, 256)
                ids = tool.encode(some.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(ids, pa.binary()), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array([tool.decode(x) for x in ids], pa.binary())], schema=kinds)

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, ids binary, n_tokens bigint, decoded binary")
