"""Toxicity by a weighted finite-state grammar over clauses.

Words pass transducers that turn them into symbols: insult, threat, target, negation, reported speech; all else is a
filler. Insults are a small fixed list and what labelled texts teach: words and word beginnings that mark toxic texts,
chosen one after another by how many toxic texts each explains that none before did. Patterns over a clause's symbols, a
few fillers apart, tell plain insults from aimed, negated and reported ones, and threats at a target from other mentions.
A logistic model over a text's matched clauses, fitted on a bounded sample of labelled rows, gives the score.

Only clauses around an insult or threat are read symbol by symbol; an automaton over the whole text finds them.

Cases: null and empty texts match nothing and get the score of such texts; equal texts get equal scores; labels of null or
both values for one id count as they come; with no labelled row a fixed model stands in; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import crc_of, slices

#: Labelled rows of either label that the model is fitted on, at most.
PER_LABEL = 2000
#: Lengths of word beginnings that may be learned, and the least number of distinct toxic texts that a new mark explains.
BEGINNINGS, LEAST = (4, 5, 6), 4
INSULTS = ("idiot", "stupid", "moron", "loser", "scum", "trash", "pathetic", "worthless", "disgusting", "clown", "dumb", "imbecile", "bastard", "arschloch", "dummkopf", "abschaum", "connard", "imbécile", "ordure", "gilipollas", "imbécil", "escoria")
THREATS = ("kill", "murder", "hurt", "destroy", "strangle", "umbringen", "töten", "tuer", "matar")
TARGETS = ("you", "your", "yours", "he", "she", "they", "them", "him", "her", "those", "these", "du", "dich", "ihr", "sie", "tu", "toi", "vous", "ils", "tú", "usted", "ustedes", "ellos")
NEGATIONS = ("not", "no", "never", "nor", "isn't", "aren't", "nicht", "kein", "keine", "nie", "pas", "jamais", "nunca", "ni")
REPORTS = ("said", "says", "called", "wrote", "claimed", "reported", "sagte", "nannte", "dit", "appelé", "dijo", "llamó")
WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
END = re.compile(r"[.!?;:\n]")
#: Patterns over a clause's symbols, each with what may lie between: the features of a text count the clauses that match.
PATTERNS = {name: re.compile(p) for name, p in {"insult": "I", "aimed": "G.{0,4}I|I.{0,3}G", "negated": "N.{0,2}I", "reported": "R.{0,6}I", "repeated": "I.{0,6}I", "threat": "H", "aimed_threat": "H.{0,3}G", "negated_threat": "N.{0,2}H"}.items()}
FIXED = {"bias": -3.5, "weights": np.array([5.0, 0.8, -2.0, -0.8, 0.5, 0.5, 3.0, -1.0, 0.5])}


class Grammar:
    """Transducers from words to symbols, and the automaton that finds where to look."""

    def __init__(self, words: tuple[str, ...], beginnings: tuple[str, ...]):
        self.words, self.beginnings = frozenset(words), beginnings
        self.symbol = {w: s for s, group in (("G", TARGETS), ("N", NEGATIONS), ("R", REPORTS), ("H", THREATS), ("I", words)) for w in group}
        self.find = ahocorasick.Automaton()
        for w in (*words, *THREATS, *beginnings):
            self.find.add_word(w, len(w))
        self.find.make_automaton()
        self.begins = re.compile("|".join(map(re.escape, sorted(beginnings))) or r"(?!)")

    def symbols(self, clause: str) -> str:
        out = []
        for word in WORD.findall(clause):
            known = self.symbol.get(word) or (word.endswith("s") and self.symbol.get(word[:-1]))
            out.append(known or ("I" if self.begins.match(word) else "o"))
        return "".join(out)

    def clauses(self, text: str) -> list[str]:
        """Symbols of the clauses that hold an insult or a threat."""
        low, out, done = text.lower(), [], -1
        for end, size in self.find.iter(low):
            start = end - size + 1
            if start < done or (start and low[start - 1].isalpha()):
                continue
            stop = END.search(low, end)
            stop = stop.start() if stop else len(low)
            begin = max(done, 0)
            for mark in ".!?;:\n":
                begin = max(begin, low.rfind(mark, begin, start) + 1)
            symbols = self.symbols(low[begin:stop])
            if "I" in symbols or "H" in symbols:
                out.append(symbols)
                done = stop
        return out

    def features(self, text: str) -> np.ndarray:
        matched = Counter(name for s in self.clauses(text) for name, p in PATTERNS.items() if p.search(s))
        found = [min(1.0, matched[name]) for name in PATTERNS]
        return np.array([*found, np.log1p(matched["insult"])])


@cache
def grammar(words: tuple[str, ...], beginnings: tuple[str, ...]) -> Grammar:
    return Grammar(words, beginnings)


def marks(text: str) -> set[str]:
    """The words of a text, and as ``beginning*`` the beginnings of its longer words."""
    words = set(WORD.findall(text.lower()))
    return words | {f"{w[:n]}*" for w in words for n in BEGINNINGS if len(w) > n}


def learn_marks(toxic: list[str], clean: list[str]) -> list[str]:
    """Marks in the order chosen: the most toxic texts explained that none before explains, less ten for every clean text
    that has the mark. Then come beginnings that no clean text has, with several endings (so not one text's copies)."""
    bad, good, endings = Counter(), Counter(), {}
    for text in toxic:
        bad.update(marks(text))
    bad = {m: n for m, n in bad.items() if n >= LEAST}
    for text in clean:
        good.update(m for m in marks(text) if m in bad)
    rate = (len(toxic) + 1) / (len(clean) + 1)
    may = {m for m, n in bad.items() if n / (good[m] + 0.5) >= 20 * rate}
    texts = [marks(text) & may for text in toxic]
    for mark in (m for s in texts for m in s if not m.endswith("*")):
        for n in BEGINNINGS:
            endings.setdefault(f"{mark[:n]}*", set()).add(mark)
    left, chosen = Counter(m for s in texts for m in s), []
    enough = max(LEAST, len(toxic) // 400)
    while left:
        # Of marks that explain as many, the whole word first, then the longer beginning.
        mark, n = max(left.items(), key=lambda x: (x[1] - 10 * rate * good[x[0]], not x[0].endswith("*"), len(x[0]), x[0]))
        if n - 10 * rate * good[mark] < enough:
            break
        chosen.append(mark)
        for s in texts:
            if mark in s:
                left.subtract(s)
                s.clear()
        left = +left
    stems = [m for m in may if m.endswith("*") and not good[m] and bad[m] >= max(5, len(toxic) // 100) and len(endings.get(m, ())) >= 5]
    for mark in sorted(stems, key=lambda m: (-bad[m], -len(m), m)):
        if not any(mark[:-1].startswith(c[:-1]) or c.startswith(mark[:-1]) for c in chosen):
            chosen.append(mark)
    return chosen


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, start: dict, ridge: float = 0.05) -> dict:
    """Newton steps towards the labels; the ridge pulls towards a fixed model, which decides what the labels do not."""
    z = np.concatenate([np.ones((len(x), 1)), x], 1)
    prior = np.concatenate([[start["bias"]], start["weights"]])
    w = prior.copy()
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ (weight * (p - y)) + ridge * len(x) / 100 * (w - prior)
        hess = (z * (weight * p * (1 - p))[:, None]).T @ z + ridge * len(x) / 100 * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return {"bias": float(w[0]), "weights": w[1:]}


def fit(docs: DataFrame, labels: DataFrame, training, id_col: str = "doc_id", text_col: str = "text") -> dict:
    """words, beginnings, bias and weights. ``training``: a condition on the ids of labels that may be learned from."""
    known = labels.filter(training).filter("toxic IN (0, 1)").select(F.col(id_col).alias("_id"), "toxic", F.pmod(F.xxhash64(id_col), F.lit(1_000_000)).alias("draw"))
    sizes = {r.toxic: r.n for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    share = F.when(F.col("toxic") == 1, F.lit(1e6 * min(1.0, 0.95 * PER_LABEL / sizes.get(1, 1)))).otherwise(1e6 * min(1.0, 0.95 * PER_LABEL / sizes.get(0, 1)))
    # The drawn ids are 2 * PER_LABEL at most, about, so they can be broadcast.
    drawn = F.broadcast(known.filter(F.col("draw") < share).select("_id", "toxic"))
    own = docs.select(F.col(id_col).alias("own_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = own.join(drawn, F.col("own_id") == F.col("_id")).select("toxic", "text").collect()
    texts = sorted({(r.text, r.toxic) for r in rows})
    toxic, clean = [t for t, y in texts if y], [t for t, y in texts if not y]
    found = learn_marks(toxic, clean)
    words = tuple(sorted({*INSULTS, *(m for m in found if not m.endswith("*"))}))
    beginnings = tuple(sorted(m[:-1] for m in found if m.endswith("*")))
    model = {"words": words, "beginnings": beginnings} | FIXED
    if toxic and clean:
        # A fixed word that many clean texts have is not an insult here.
        seen = Counter(w for t in clean for w in set(WORD.findall(t.lower())) & {*INSULTS})
        words = tuple(w for w in words if seen[w] <= 0.002 * len(clean) + 1)
        model["words"] = words
        tool = grammar(words, beginnings)
        x = np.stack([tool.features(t) for t, _ in texts])
        y = np.array([y for _, y in texts], float)
        # Rows of a label stand for as many as it has among all labels.
        weight = np.where(y == 1, sizes[1] / len(toxic), sizes[0] / len(clean))
        model |= fit_logistic(x, y, weight / weight.mean(), FIXED)
    return model


def probabilities(texts: list[str | None], model: dict) -> tuple[np.ndarray, np.ndarray]:
    """Scores and numbers of clauses of texts; null counts as empty."""
    tool = grammar(model["words"], model["beginnings"])
    x = np.stack([tool.features(t or "") for t in texts])
    return 1 / (1 + np.exp(-(x @ model["weights"] + model["bias"]))), np.expm1(x[:, -1]).round().astype(np.int64)


def score(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score, n_clauses."""
    kinds = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("n_clauses", pa.int64())])

    def run(batches):
        for batch in batches:
            for some in slices(batch, "text"):
                p, clauses = probabilities(some.column(1).to_pylist(), model)
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(p), pa.array(clauses)], schema=kinds)

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).mapInArrow(run, "doc_id bigint, score double, n_clauses bigint")


def held_out(id_col: str = "doc_id"):
    return F.pmod(crc_of(id_col), F.lit(4)) == 2
