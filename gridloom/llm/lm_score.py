"""Cross-entropy difference: how much better a target model predicts a text than a background model, per token.

Both are bigram models with unigram backing, over one vocabulary: every word of the corpus, by 63 bits of its hash, and one more
for words that it lacks. The background is every document, the target is every document that a condition picks; both are
counted in full. With p(w|v) = (c(v,w) + A * p(w)) / (c(v) + A) and
p(w) = (c(w) + B) / (n + B * words), a text's score is the mean over its tokens of ln p_background - ln p_target: below 0
for texts that look like the target.

Counts of words and bigrams grow with the corpus and are never gathered. Only words that make up at least 1/VOCABULARY of
all tokens are broadcast with their counts, VOCABULARY words at most. A document's bigrams are dealt out in packed parts, by their
second word where that is a rarer one, else by bigram: so all tokens of a rarer word meet, and the word is counted there,
for its backing and for what follows it. Where bigrams meet they are counted, and each gives its share of the loss back to
its document (whose own counts are left out of both models), packed by the part of the input that it came from. Bigrams
that some part of the input has as often as 1/VOCABULARY are candidates; those whose counts in such parts reach that share of
all are counted exactly first, and scored where they are.
No bigram that meets in one task has more than 2/VOCABULARY of all tokens.

Cases: a null, empty or blank text has no tokens and the score 0; ids may be null or repeated, each row is scored by itself;
rows equal in text get equal scores if the target model counts both or neither; with no target row the target model is the
background's backing with no counts; other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import cut, raw_text
from gridloom.llm.jaccard_join import LOWER, mix, word_hashes

#: Words and bigrams with 1/VOCABULARY of all tokens are scored where they are, others where they meet.
VOCABULARY = 1 << 18
A, B = 5.0, 0.5
#: Bigrams in one bucket, about.
PER_BUCKET = 1_000_000
#: Words of an entry are numbers if they are broadcast, else hashes with this bit.
RARE = np.uint64(1 << 63)
ENTRY = np.dtype([("word", "<u8"), ("before", "<u8"), ("doc", "<u4")])
SHARE = np.dtype([("doc", "<u4"), ("loss", "<f8")])
INFO = np.dtype([("id", "<i8"), ("null", "?"), ("tokens", "<i8"), ("loss", "<f8")])
#: In an entry's document number: the target model counts it; a word follows in the text.
MARK, FOLLOWED = np.uint32(1 << 31), np.uint32(1 << 30)


def hashed(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of some texts, one after another, and the number of words of each."""
    lows = [raw.translate(LOWER) for raw in raws]
    return (word_hashes(b" ".join(lows)) if lows else np.zeros(0, np.uint64)), np.array([len(x.split()) for x in lows], np.int64)


def pieces(batch: pa.RecordBatch, column: str, most: int = 1 << 20):
    """Parts of a batch with some ``most`` bytes of text each."""
    sizes = np.array([len(x) for x in batch.column(column).to_pylist()], np.int64)
    ends = np.cumsum(sizes)
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + most, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def totals(keys: list[np.ndarray], weights: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and sums of weight rows."""
    flat, rows = np.concatenate(keys), np.concatenate(weights)
    order = np.argsort(flat, kind="stable")
    flat, rows = flat[order], rows[order]
    starts = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]])) if len(flat) else np.zeros(0, np.int64)
    return flat[starts], np.add.reduceat(rows, starts, axis=0) if len(flat) else rows


def counted(docs: DataFrame, of, buckets: int) -> DataFrame:
    """key, n, target: keys of each text by ``of`` (hashes, counts) counted in each task, then over tasks."""
    kinds = pa.schema([("bucket", pa.int32()), ("data", pa.binary())])
    entry = np.dtype([("key", "<u8"), ("n", "<i8"), ("target", "<i8")])

    def packed(keys, weights):
        key, sums = totals(keys, weights)
        flat = np.empty(len(key), entry)
        flat["key"], flat["n"], flat["target"] = key, sums[:, 0], sums[:, 1]
        bucket = (key >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)  # in order, as the keys are
        starts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else np.zeros(0, np.int64)
        data = [flat[a:b].tobytes() for a, b in zip(starts, [*starts[1:], len(flat)], strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(bucket[starts].astype(np.int32)), pa.array(data, pa.binary())], schema=kinds)

    def run(batches):
        keys, weights, held = [], [], 0
        for batch in batches:
            for some in pieces(batch, "text"):
                words, sizes = hashed(some.column(0).to_pylist())
                target = np.repeat(np.array(some.column(1).to_pylist(), np.int64), sizes)
                key, target = of(words, sizes, target)
                key, sums = totals([key], [np.stack([np.ones(len(key), np.int64), target], 1)])
                keys.append(key)
                weights.append(sums)
                held += len(key)
                if held > 2_000_000:
                    key, sums = totals(keys, weights)
                    keys, weights, held = [key], [sums], len(key)
                    if held > 1_000_000:
                        yield packed(keys, weights)
                        keys, weights, held = [], [], 0
        if held:
            yield packed(keys, weights)

    def merge(batches):
        bucket, rows = None, []

        def done():
            flat = np.concatenate([np.frombuffer(x, entry) for x in rows])
            key, sums = totals([flat["key"]], [np.stack([flat["n"], flat["target"]], 1)])
            return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(sums[:, 0]), pa.array(sums[:, 1])], names=["key", "n", "target"])

        for batch in batches:
            for b, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if b != bucket and rows:
                    yield done()
                    rows = []
                bucket = b
                rows.append(data)
        if rows:
            yield done()

    parts = docs.select("text", "target").mapInArrow(run, "bucket int, data binary")
    return parts.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(merge, "key bigint, n bigint, target bigint")


def as_arrays(rows: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Collected keys in order with both counts; for tables that a share of all tokens bounds to VOCABULARY rows."""
    got = rows.toArrow()
    key = got["key"].to_numpy().view(np.uint64)
    order = np.argsort(key)
    return key[order], got["n"].to_numpy()[order], got["target"].to_numpy()[order]


def words_kept(words: np.ndarray, vocabulary: np.ndarray) -> np.ndarray:
    """Numbers of words: 1 and up for those broadcast, 0 for rarer ones."""
    place = np.searchsorted(vocabulary, words)
    place[place == len(vocabulary)] = 0
    return np.where(vocabulary[place] == words, place + 1, 0) if len(vocabulary) else np.zeros(len(words), np.int64)


def bigrams(numbers: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The pair of each token with the one before it in its text; at a text's start with the number VOCABULARY + 1."""
    before = np.concatenate([[0], numbers[:-1]])
    before[(np.cumsum(sizes) - sizes)[sizes > 0]] = VOCABULARY + 1
    return before.astype(np.uint64) << np.uint64(32) | numbers.astype(np.uint64)


class Models:
    """Unigram counts of both models, and the loss differences that bigram counts give. ``vocabulary``: the words that are
    broadcast, of ``words`` in all."""

    def __init__(self, vocabulary: np.ndarray, n: np.ndarray, target: np.ndarray, words: int, all_n: int, all_target: int, texts: int, target_texts: int):
        self.vocabulary, self.words, self.all = vocabulary, words, (all_n, all_target)
        self.count = []
        for counts, starts in ((n, texts), (target, target_texts)):
            own = np.zeros(VOCABULARY + 2)
            own[1 : len(counts) + 1] = counts
            own[VOCABULARY + 1] = starts
            self.count.append(own)

    def after(self, n: np.ndarray, target: np.ndarray) -> np.ndarray:
        """What a bigram's loss has from both counts of its first word."""
        return np.log(target + A) - np.log(n + A)

    def before(self, n: np.ndarray, target: np.ndarray, word_n: np.ndarray, word_target: np.ndarray) -> np.ndarray:
        """What a bigram's loss has from its own counts and those of its second word."""
        backing = [(word + B) / (everything + B * (self.words + 1)) for word, everything in zip((word_n, word_target), self.all, strict=True)]
        return np.log(n + A * backing[0]) - np.log(target + A * backing[1])

    def difference(self, pairs: np.ndarray, n: np.ndarray, target: np.ndarray) -> np.ndarray:
        """ln p_background - ln p_target of the second word of each pair of broadcast words, given both counts of the pair."""
        v, w = (pairs >> np.uint64(32)).astype(np.int64), (pairs & np.uint64(0xFFFFFFFF)).astype(np.int64)
        return self.before(n, target, *(own[w] for own in self.count)) + self.after(*(own[v] for own in self.count))


def score(docs: DataFrame, target: Column, id_col: str = "doc_id", text_col: str = "text", heavy_own: bool = True) -> DataFrame:
    """Every row: doc_id, score, n_tokens. ``target`` says of a row of docs whether the target model counts it. With
    ``heavy_own``, bigrams scored where they are keep a document's own counts; without it one rule holds for all bigrams."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), raw_text(text_col).alias("text"), F.coalesce(target, F.lit(False)).cast("int").alias("target"))
    size = rows.agg(F.sum(F.octet_length("text")), F.count("*"), F.sum("target"), F.sum(((F.octet_length("text") > 0)).cast("int"))).first()
    buckets = max(256, (size[0] or 0) // (6 * PER_BUCKET))
    words = cut(counted(rows, lambda words, sizes, target: (words, target), buckets))
    all_n, all_target = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("target"), F.lit(0))).first()
    # A word with 1/VOCABULARY of all tokens: there are VOCABULARY such words at most.
    kept = as_arrays(words.filter(F.col("n") * VOCABULARY >= all_n))
    models = Models(*kept, words.count(), all_n, all_target, size[1] or 0, size[2] or 0)

    heavy = as_arrays(frequent(rows, models, all_n))
    parts = rows.mapInArrow(dealer(models, heavy, heavy_own, buckets), "bucket bigint, part bigint, data binary")
    shares = parts.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(meeting(models), "part bigint, info boolean, data binary")
    return shares.repartition("part").sortWithinPartitions("part").mapInArrow(gathering, "doc_id bigint, score double, n_tokens bigint")


def frequent(rows: DataFrame, models: Models, all_n: int) -> DataFrame:
    """key, n, target of bigrams that make up 1/VOCABULARY of all, counted exactly: VOCABULARY rows at most."""
    kinds = pa.schema([("key", pa.int64()), ("n", pa.int64()), ("target", pa.int64())])

    def often(batches):
        def found():
            key, sums = totals(keys, counts)
            # A bigram that is frequent has frequent words.
            frequent_words = (key >> np.uint64(32) > 0) & (key & np.uint64(0xFFFFFFFF) > 0)
            often = frequent_words & (sums * VOCABULARY >= tokens) & (sums > 1)
            return pa.RecordBatch.from_arrays([pa.array(key[often].view(np.int64)), pa.array(sums[often]), pa.array(sums[often])], schema=kinds)

        keys, counts, tokens, held = [], [], 0, 0
        for batch in batches:
            for some in pieces(batch, "text"):
                words, sizes = hashed(some.column(1).to_pylist())
                key, n = np.unique(bigrams(words_kept(words, models.vocabulary), sizes), return_counts=True)
                keys.append(key)
                counts.append(n)
                tokens += len(words)
                held += len(key)
                if held > 1_500_000:
                    yield found()
                    keys, counts, tokens, held = [], [], 0, 0
        if held:
            yield found()

    # A candidate has 1/VOCABULARY of the tokens of some stretch; what stretches without it add stays below that of all.
    seen = rows.mapInArrow(often, "key bigint, n bigint, target bigint").groupBy("key").agg(F.sum("n").alias("n"), F.sum("target").alias("target"))
    candidates = as_arrays(seen.filter(F.col("n") * VOCABULARY >= all_n))[0]

    def exact(batches):
        sums = np.zeros((len(candidates) + 1, 2), np.int64)
        for batch in batches:
            for some in pieces(batch, "text"):
                words, sizes = hashed(some.column(1).to_pylist())
                pair = bigrams(words_kept(words, models.vocabulary), sizes)
                target = np.repeat(np.array(some.column(2).to_pylist(), np.int64), sizes)
                place = places(pair, candidates)
                sums[:, 0] += np.bincount(place, minlength=len(sums))
                sums[:, 1] += np.bincount(place[target > 0], minlength=len(sums))
        has = sums[:-1, 0] > 0
        yield pa.RecordBatch.from_arrays([pa.array(candidates.view(np.int64)[has]), pa.array(sums[:-1, 0][has]), pa.array(sums[:-1, 1][has])], schema=kinds)

    return rows.mapInArrow(exact, "key bigint, n bigint, target bigint").groupBy("key").agg(F.sum("n").alias("n"), F.sum("target").alias("target"))


def places(keys: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Where each key stands in a sorted array; its length for those that it lacks."""
    if not len(among):
        return np.zeros(len(keys), np.int64)
    place = np.minimum(np.searchsorted(among, keys), len(among) - 1)
    return np.where(among[place] == keys, place, len(among))


def squeezed(entries: np.ndarray) -> bytes:
    """Compressed byte by byte of the entries: high bytes of numbers and documents hardly vary."""
    return zlib.compress(entries.view(np.uint8).reshape(-1, ENTRY.itemsize).T.tobytes(), 1)


def restored(data: bytes) -> np.ndarray:
    flat = np.frombuffer(zlib.decompress(data), np.uint8).reshape(ENTRY.itemsize, -1)
    return np.ascontiguousarray(flat.T).reshape(-1).view(ENTRY)


def dealer(models: Models, counts: tuple[np.ndarray, np.ndarray, np.ndarray], heavy_own: bool, buckets: int):
    """Bigrams to be counted go out by bucket; a part's documents, with what is known of them, to a bucket below 0."""
    names = ["bucket", "part", "data"]
    heavy, heavy_n, heavy_target = counts
    known = np.concatenate([models.difference(*counts), [0.0]]) if heavy_own else None

    def without_own(doc: np.ndarray, place: np.ndarray, marked: np.ndarray) -> np.ndarray:
        """Loss of each document over its frequent bigrams, its own counts left out."""
        pairs, own = np.unique(doc * max(1, len(heavy)) + place, return_counts=True)
        doc, place = np.divmod(pairs, max(1, len(heavy)))
        loss = own * models.difference(heavy[place], heavy_n[place] - own, heavy_target[place] - own * marked[doc])
        return np.bincount(doc, loss, len(marked))

    def run(batches):
        part, row = TaskContext.get().partitionId(), 0
        for batch in batches:
            for some in pieces(batch, "text"):
                ids, n = some.column(0), some.num_rows
                words, sizes = hashed(some.column(1).to_pylist())
                doc = np.repeat(np.arange(n), sizes)
                numbers = words_kept(words, models.vocabulary)
                pair = bigrams(numbers, sizes)
                place = places(pair, heavy)
                rare = place == len(heavy)
                # The first word is looked up here if it is broadcast; else where its tokens meet.
                first = (pair >> np.uint64(32)).astype(np.int64)
                after = np.where(rare & (first > 0), models.after(*(own[first] for own in models.count)), 0.0)
                info = np.zeros(n, INFO)
                info["id"] = ids.fill_null(0).to_numpy(zero_copy_only=False)
                info["null"] = ids.is_null().to_numpy(zero_copy_only=False)
                info["tokens"] = sizes
                marked = np.array(some.column(2).to_pylist(), np.int64)
                if heavy_own:
                    info["loss"] = np.bincount(doc, known[place] + after, n)
                else:
                    info["loss"] = np.bincount(doc, after, n) + without_own(doc[~rare], place[~rare], marked)
                # The numbers of documents go on through the part, so the first is sent before them.
                data, bucket = [np.int64(row).tobytes() + info.tobytes()], [np.array([-1 - part], np.int64)]
                ends = np.cumsum(sizes)[sizes > 0]
                code = np.where(numbers > 0, numbers.astype(np.uint64), words | RARE)
                before = np.where(first > 0, first.astype(np.uint64), np.concatenate([np.zeros(1, np.uint64), code[:-1]])[: len(code)])
                followed = np.ones(len(words), bool)
                followed[ends - 1] = False
                entries = np.empty(np.count_nonzero(rare), ENTRY)
                entries["word"], entries["before"] = code[rare], before[rare]
                mark = marked.astype(np.uint32) * MARK
                entries["doc"] = (row + doc[rare]).astype(np.uint32) | mark[doc[rare]] | followed[rare] * FOLLOWED
                key = np.where(entries["word"] < RARE, mix(entries["word"]) ^ entries["before"], entries["word"])
                own = (mix(key) >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
                order = np.argsort(own, kind="stable")
                entries, own = entries[order], own[order].astype(np.int64)
                if len(entries):
                    starts = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
                    data += [squeezed(entries[a:b]) for a, b in zip(starts, [*starts[1:], len(entries)], strict=True)]
                    bucket.append(own[starts])
                bucket = np.concatenate(bucket)
                yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(np.full(len(bucket), part, np.int64)), pa.array(data, pa.binary())], names=names)
                row += n

    return run


def meeting(models: Models):
    """All entries of a bigram are in one bucket: counted, each gives its share to its document, summed by document."""
    names = ["part", "info", "data"]

    def shares(rows: list[tuple[int, bytes]]):
        found = [restored(d) for _, d in rows]
        parts = np.repeat(np.array([p for p, _ in rows], np.int64), [len(x) for x in found])
        entries = np.concatenate(found)
        doc = parts.astype(np.uint64) << np.uint64(32) | (entries["doc"] & ~(MARK | FOLLOWED)).astype(np.uint64)
        order = np.lexsort((doc, entries["before"], entries["word"]))
        word, before, doc, flags = entries["word"][order], entries["before"][order], doc[order], entries["doc"][order]
        new_word = np.concatenate([[True], word[1:] != word[:-1]])
        new_pair = new_word | np.concatenate([[True], before[1:] != before[:-1]])
        starts = np.flatnonzero(new_pair | np.concatenate([[True], doc[1:] != doc[:-1]]))
        own = np.diff(np.concatenate([starts, [len(word)]]))
        followed = np.add.reduceat((flags & FOLLOWED > 0).astype(np.int64), starts)
        word, doc, marked = word[starts], doc[starts], flags[starts] & MARK > 0
        of_pair, of_word = np.cumsum(new_pair[starts]) - 1, np.cumsum(new_word[starts]) - 1
        # What a document has itself does not count for it, in either model.
        n = np.bincount(of_pair, own)[of_pair] - own
        target = np.bincount(of_pair, own * marked)[of_pair] - own * marked
        # All tokens of a word that is not broadcast are here.
        number = np.where(word < RARE, word, 0).astype(np.int64)
        word_n, word_target = (
            np.where(number > 0, known[number], np.bincount(of_word, count)[of_word]) for known, count in zip(models.count, (own, own * marked), strict=True)
        )
        loss = own * models.before(n, target, word_n, word_target) + np.where(number > 0, 0, followed) * models.after(word_n, word_target)
        doc, which = np.unique(doc, return_inverse=True)
        sums = np.empty(len(doc), SHARE)
        sums["doc"], sums["loss"] = (doc & np.uint64(0xFFFFFFFF)).astype(np.uint32), np.bincount(which, loss, len(doc))
        part = (doc >> np.uint64(32)).astype(np.int64)
        starts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        data = [sums[a:b].tobytes() for a, b in zip(starts, [*starts[1:], len(sums)], strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(part[starts]), pa.array([False] * len(data)), pa.array(data, pa.binary())], names=names)

    def run(batches):
        bucket, rows = None, []
        for batch in batches:
            for b, part, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if b < 0:
                    yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([True]), pa.array([data], pa.binary())], names=names)
                    continue
                if b != bucket and rows:
                    yield shares(rows)
                    rows = []
                bucket = b
                rows.append((part, data))
        if rows:
            yield shares(rows)

    return run


def gathering(batches):
    """A part's documents with the sum of their losses, known and given back."""
    names = ["doc_id", "score", "n_tokens"]

    def done(rows: list[tuple[bool, bytes]]):
        infos = sorted((int(np.frombuffer(d[:8], np.int64)[0]), d[8:]) for info, d in rows if info)
        info = np.concatenate([np.frombuffer(d, INFO) for _, d in infos])
        loss = info["loss"].copy()
        given = [np.frombuffer(d, SHARE) for is_info, d in rows if not is_info]
        if given:
            given = np.concatenate(given)
            # In one order, so that sums of equal numbers are equal.
            given = given[np.lexsort((given["loss"], given["doc"]))]
            loss += np.bincount(given["doc"], given["loss"], len(info))
        ids = pa.array(info["id"], pa.int64(), mask=info["null"])
        return pa.RecordBatch.from_arrays([ids, pa.array(loss / np.maximum(1, info["tokens"])), pa.array(info["tokens"])], names=names)

    part, rows = None, []
    for batch in batches:
        for p, info, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if p != part and rows:
                yield done(rows)
                rows = []
            part = p
            rows.append((info, data))
    if rows:
        yield done(rows)
