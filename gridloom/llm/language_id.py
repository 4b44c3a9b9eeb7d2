"""Language by the nearest centroid: cosine of TF-IDF vectors of character n-grams with several centroids a language.

N-grams of one to three lower-case letters and blanks are hashed into DIMENSIONS cells; document frequencies are counted
over all documents. The classifier is fitted on at most PER_LANGUAGE labelled training rows of each language, by spherical
k-means in each. These rows also give the least cosine a language has by length of text; a text that stays below MARGIN of
it is rejected. Short texts have low cosines, so limits never rise as texts get shorter, and a text shorter (in powers of
two) than all training rows of its language is not rejected.

Cases: a null text and one without a letter are ``und``, score 0 and rejected; any other text gets a learned value; equal
texts get equal results; very long texts are counted whole, one at a time; with no labelled row to learn from, every text is ``und`` and none is rejected; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridloom.llm.common import crc_of, slices

DIMENSIONS = 4096
#: Training rows of a language at most, and centroids of it.
PER_LANGUAGE, CENTROIDS = 800, 4
#: Part of the least cosine of training rows that a text of their length needs.
MARGIN = 0.6


def counts(text: str) -> np.ndarray:
    """Hashed n-gram counts of a whole text; other characters than letters count as one blank."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), "<u4").astype(np.uint64)
    plain = codes < 128
    letter = np.where(plain, (codes >= 97) & (codes <= 122), codes >= 192)
    codes = np.where(letter, codes, np.uint64(32))
    keep = np.concatenate([[True], (codes[1:] != 32) | (codes[:-1] != 32)])[: len(codes)]
    codes = np.concatenate([[32], codes[keep], [32]]).astype(np.uint64)
    out = np.zeros(DIMENSIONS)
    total = np.zeros(len(codes), np.uint64)
    with np.errstate(over="ignore"):
        for n in (1, 2, 3):
            total = total[: len(codes) - n + 1] * np.uint64(0x100000001B3) + codes[n - 1 :]
            mixed = (total + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
            out += np.bincount((mixed >> np.uint64(52)).astype(np.int64), minlength=DIMENSIONS)
    return out


def weighed(found: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(found) * idf
    return x / (np.sqrt((x * x).sum(-1, keepdims=True)) + 1e-300)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def inverse_frequencies(docs: DataFrame, text_col: str) -> np.ndarray:
    """Over all documents; each task sends DIMENSIONS numbers at most."""
    kinds = pa.schema([("cell", pa.int32()), ("n", pa.int64())])

    def run(batches):
        seen = np.zeros(DIMENSIONS + 1, np.int64)
        for batch in batches:
            for some in slices(batch, "text"):
                for text in some.column(0).to_pylist():
                    seen[:-1] += counts(text) > 0
                    seen[-1] += 1
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(DIMENSIONS + 1, dtype=np.int32)), pa.array(seen)], schema=kinds)

    rows = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text")).mapInArrow(run, "cell int, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    seen = np.zeros(DIMENSIONS + 1)
    for cell, n in rows:
        seen[cell] = n
    return np.log((1 + seen[-1]) / (1 + seen[:-1])) + 0.1


def clusters(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means from points that are far apart."""
    picked = [int((x @ x.mean(0)).argmax())]
    while len(picked) < min(k, len(x)):
        picked.append(int((x @ x[picked].T).max(1).argmin()))
    centres = x[picked]
    for _ in range(rounds):
        own = (x @ centres.T).argmax(1)
        centres = np.stack([x[own == i].mean(0) if (own == i).any() else centres[i] for i in range(len(centres))])
        centres /= np.sqrt((centres * centres).sum(1, keepdims=True)) + 1e-300
    return centres


def length_bin(total: int) -> int:
    """The power of two of a number of n-grams."""
    return int(total).bit_length()


def limits(cosines: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """The least cosine to be kept for each length_bin: MARGIN of the least that training rows as long or longer have."""
    out = np.zeros(65)
    low = np.inf
    for size in range(64, -1, -1):
        here = cosines[[length_bin(n) == size for n in totals]]
        low = min(low, *here, np.inf)
        out[size] = MARGIN * low
    longest, shortest = (f(length_bin(n) for n in totals) for f in (max, min))
    out[longest:], out[:shortest] = out[longest], 0.0
    return np.maximum(out, 0.0)


def sampled(docs: DataFrame, training, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """lang, text of the labelled rows to learn from, PER_LANGUAGE of each language at most."""
    draw = F.xxhash64(F.col(id_col), F.col(text_col))
    labelled = docs.filter(training).filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), draw.alias("draw"))
    sizes = {r.lang: r.n for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    share = F.lit(0.0)
    for lang, n in sizes.items():
        share = F.when(F.col("lang") == lang, F.lit(1e6 * min(1.0, 0.9 * PER_LANGUAGE / n))).otherwise(share)
    # The share takes about as many as are wanted; rows that draw alike may be more, so the first ones are counted off.
    place = F.row_number().over(Window.partitionBy("lang").orderBy("draw"))
    return labelled.filter(F.pmod("draw", F.lit(1_000_000)) < share).withColumn("place", place).filter(F.col("place") <= PER_LANGUAGE).select("lang", "text")


def trained(found: list[bytes], idf: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Centres and limits from the counts of one language's rows, in whatever order they come."""
    rows = [np.frombuffer(row, "<u4") for row in sorted(found)]
    x = np.empty((len(rows), DIMENSIONS))
    for i, row in enumerate(rows):
        x[i] = weighed(row.astype(np.float32), idf)
    centres = clusters(x, k)
    return centres, limits((x @ centres.T).max(1), np.array([row.sum() for row in rows]))


def fit(docs: DataFrame, training, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> dict:
    """idf, centres, their languages and the least cosine of each. ``training``: a condition on rows that may be learned from.
    A task fits a language on its sample; only centres and limits come to the driver."""
    idf, k = inverse_frequencies(docs, text_col), CENTROIDS
    kinds = pa.schema([("lang", pa.string()), ("x", pa.binary())])

    def run(batches):
        for part in (some for batch in batches for some in slices(batch, "text")):
            keep = [(lang, counts(text).astype("<u4").tobytes()) for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True) if has_letter(text)]
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keep], pa.string()), pa.array([k[1] for k in keep], pa.binary())], schema=kinds)

    def one(rows: pa.Table) -> pa.Table:
        centres, least = trained(rows.column("x").to_pylist(), idf, k)
        made = [rows.column("lang")[0].as_py()], [centres.tobytes()], [least.tobytes()]
        return pa.table([pa.array(v, t) for v, t in zip(made, (pa.string(), pa.binary(), pa.binary()), strict=True)], names=["lang", "centres", "least"])

    vectors = sampled(docs, training, id_col, text_col, lang_col).mapInArrow(run, "lang string, x binary")
    centres, langs, least = [], [], []
    for row in sorted(vectors.groupBy("lang").applyInArrow(one, "lang string, centres binary, least binary").collect(), key=lambda r: r.lang):
        own = np.frombuffer(row.centres).reshape(-1, DIMENSIONS)
        centres.append(own)
        langs += [row.lang] * len(own)
        least += [np.frombuffer(row.least)] * len(own)
    return {"idf": idf, "centres": np.concatenate(centres) if centres else np.zeros((0, DIMENSIONS)), "langs": langs, "least": np.array(least).reshape(-1, 65)}


def predict(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score (cosine, 0 to 1), rejected."""
    kinds = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_())])

    def run(batches):
        for batch in batches:
            for some in slices(batch, "text"):
                rows = [judge(text, model) for text in some.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([some.column(0), *(pa.array([r[i] for r in rows], kinds.field(i + 1).type) for i in range(3))], schema=kinds)

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id bigint, lang_pred string, score double, rejected boolean")


def judge(text: str | None, model: dict) -> tuple[str, float, bool]:
    if not has_letter(text):
        return "und", 0.0, True
    if not model["langs"]:
        return "und", 0.0, False
    found = counts(text)
    cosine = model["centres"] @ weighed(found, model["idf"])
    best = int(cosine.argmax())
    return model["langs"][best], float(min(1.0, max(0.0, cosine[best]))), bool(cosine[best] < model["least"][best, length_bin(found.sum())])


def held_out(id_col: str = "doc_id"):
    return F.pmod(crc_of(id_col), F.lit(3)) == 1
