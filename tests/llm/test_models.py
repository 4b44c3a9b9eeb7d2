"""Toxicity, language, HTML extraction, LM scoring and the pipeline."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.llm import html_extract, jaccard_join, language_id, lm_score, toxicity, workload

SF = "/root/testdata/sf0.001"

SYLLABLES = {"aa": ["the", "ing", "er", "on"], "bb": ["der", "sch", "ung", "ein"]}


def prose(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n)) + "."


def test_grammar_patterns():
    tool = toxicity.grammar(("idiot",), ("blor",))
    names = list(toxicity.PATTERNS)
    matched = lambda text: {n for n, v in zip(names, tool.features(text), strict=False) if v}
    assert matched("You are an idiot. Fine.") == {"insult", "aimed"}
    assert matched("Not an idiot!") == {"insult", "negated"}
    assert matched("A man called it the work of an idiot") == {"insult", "reported"}
    assert matched("I will kill you") == {"threat", "aimed_threat"}
    assert matched("Blorting words; idiots") == {"insult"}
    assert matched("idiotic, unblor, skill") == set() and matched("") == set()


def test_toxicity_learns_words_and_beginnings(spark, make):
    rng = random.Random(3)
    rows, labels = [(None, None), (9000, ""), (9001, None)], [(None, 1), (9000, 0), (9001, None)]
    for i in range(400):
        bad = i % 4 == 0
        extra = rng.choice(["grumf", "zorki" + rng.choice("abcdefgh") + "x", "zorki" + rng.choice("ijklmnop") + "y"]) if bad else ""
        rows.append((i, f"{prose(rng, 'aa', 20)} {extra} {prose(rng, 'aa', 20)}"))
        labels.append((i, int(bad)))
    docs, known = make(rows, extra=True), spark.createDataFrame(labels, "doc_id bigint, toxic int")
    model = toxicity.fit(docs, known, ~toxicity.held_out())
    assert "grumf" in model["words"] and any("zorki".startswith(b) or b.startswith("zorki") for b in model["beginnings"])
    got = toxicity.score(docs, model).toPandas().set_index("doc_id")
    assert [got.score[i] >= 0.3 for i in range(400)] == [i % 4 == 0 for i in range(400)]
    assert len(got) == len(rows) and got.score.between(0, 1).all()
    empty = toxicity.fit(make([]), known.limit(0), ~toxicity.held_out())
    assert toxicity.score(make([]), empty).count() == 0


def test_language(make):
    rng = random.Random(4)
    rows = [(i, prose(rng, lang, 40), lang) for i, lang in enumerate(["aa", "bb"] * 60)] + [(500, None, "aa"), (501, " 12 !", "bb"), (502, prose(rng, "aa", 3), None), (None, prose(rng, "bb", 9), "bb")]
    docs = make(rows, "doc_id bigint, text string, lang string", extra=True)
    model = language_id.fit(docs, ~language_id.held_out())
    got = language_id.predict(docs, model).toPandas()
    by = got.dropna(subset=["doc_id"]).set_index("doc_id")
    assert [by.lang_pred[i] for i in range(120)] == ["aa", "bb"] * 60
    assert by.lang_pred[500] == by.lang_pred[501] == "und" and by.rejected[500] and not any(by.rejected[i] for i in range(120))
    assert len(got) == len(rows) and by.score.between(0, 1).all()
    none = language_id.fit(docs.limit(0), F.lit(True))
    assert language_id.predict(docs, none).filter("lang_pred <> 'und'").count() == 0


def test_unlearned_languages_and_letter_noise_are_rejected(make):
    rng = random.Random(5)
    rows = [(i, prose(rng, lang, n), lang) for i, (lang, n) in enumerate([(lang, n) for n in (30, 120, 400) for lang in ("aa", "bb")] * 60)]
    model = language_id.fit(make(rows, "doc_id bigint, text string, lang string"), ~language_id.held_out())
    fresh = [(i, prose(rng, lang, n), lang) for i, (lang, n) in enumerate([(lang, n) for n in (30, 120, 400) for lang in ("aa", "bb")] * 20)]
    noise = "".join(rng.choice("qwxzjkvQWXZJKV") for _ in range(300))
    strange = [(1000, "Все люди рождаются свободными и равными в своем достоинстве. " * 9, None), (1001, noise, None), (1002, " ".join(noise[i : i + 5] for i in range(0, 300, 5)), None)]
    got = language_id.predict(make(fresh + strange, "doc_id bigint, text string, lang string"), model).toPandas().set_index("doc_id")
    assert not any(got.rejected[i] for i in range(120)) and all(got.rejected[i] for i in (1000, 1001, 1002))
    assert language_id.judge("ab", model)[2] is False, "shorter than all that was learned from"


def test_limits_rise_with_length():
    low = language_id.limits(np.array([0.2, 0.5, 0.4]), np.array([10, 100, 5000]))
    assert (np.diff(low) >= 0).all() and low[language_id.length_bin(10) - 1] == 0
    assert [round(float(low[language_id.length_bin(n)]), 6) for n in (10, 100, 5000, 10**9)] == [0.12, 0.24, 0.24, 0.24]


def test_rows_of_one_id_do_not_exceed_the_sample(make, monkeypatch):
    monkeypatch.setattr(language_id, "PER_LANGUAGE", 10)
    taken = []
    monkeypatch.setattr(language_id, "clusters", lambda x, k: taken.append(len(x)) or x[:1])
    rng = random.Random(6)
    rows = [(None, "the same text", "aa")] * 300 + [(None, prose(rng, "aa", 5), "aa") for _ in range(50)] + [(7, prose(rng, "bb", 5), "bb") for _ in range(50)]
    language_id.fit(make(rows, "doc_id bigint, text string, lang string"), F.lit(True))
    assert len(taken) <= 2 and all(n <= 10 for n in taken)


def test_the_sample_of_a_language_is_bounded(make, monkeypatch):
    monkeypatch.setattr(language_id, "PER_LANGUAGE", 10)
    rng = random.Random(6)
    rows = [(None, "the same text", "aa")] * 300 + [(None, prose(rng, "aa", 5), "aa") for _ in range(50)] + [(7, prose(rng, "bb", 5), "bb") for _ in range(50)]
    drawn = language_id.sampled(make(rows, "doc_id bigint, text string, lang string"), F.lit(True), "doc_id", "text", "lang")
    assert all(0 < n <= 10 for n in Counter(r.lang for r in drawn.collect()).values())


def test_only_centres_and_limits_of_a_language_come_to_the_driver(make, monkeypatch):
    rng = random.Random(7)
    docs = make([(i, prose(rng, lang, 40), lang) for i, lang in enumerate(["aa", "bb"] * 60)], "doc_id bigint, text string, lang string")
    sent, collect = [], type(docs).collect
    monkeypatch.setattr(type(docs), "collect", lambda self: sent.append(got := collect(self)) or got)
    model = language_id.fit(docs, F.lit(True))
    moved = sum(len(v) for rows in sent for row in rows for v in row if isinstance(v, (bytes, bytearray)))
    assert moved == model["centres"].nbytes + 2 * 65 * 8, "the rows' own counts stay on the executors"
    assert model["langs"] == ["aa"] * 4 + ["bb"] * 4


def test_a_language_is_learned_the_same_in_any_order_of_rows():
    rng = random.Random(8)
    found = [language_id.counts(prose(rng, "aa", 30)).astype("<u4").tobytes() for _ in range(20)]
    idf = np.linspace(0.1, 3, language_id.DIMENSIONS)
    (a, low), (b, same) = language_id.trained(found, idf, 4), language_id.trained(found[::-1], idf, 4)
    assert np.array_equal(a, b) and np.array_equal(low, same) and a.shape == (4, language_id.DIMENSIONS)


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a="</p>";</script></head><body>
<nav><ul><li><a href=/x>Menu</a></ul></nav><div class="ad">Buy &amp; save</div>
<article><h1>Head&nbsp;line</h1><p>One <b>bold</b>
 two<br><p>Three &lt;four&gt;<aside>Side</aside><form>Mail <input></form><div class="comments"><p>I think</p></div></article>
<footer>&copy; us</footer>"""


def test_extraction(spark):
    want = "Head line\nOne bold two\nThree <four>"
    rows = [(i, f"u{i}", PAGE) for i in range(12)] + [(50, None, None), (51, "u", ""), (52, "u", "just text"), (53, "u", "<p>open <!-- never closed"), (None, "u", PAGE)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("text", F.lit(1))
    for model in (html_extract.FIXED, html_extract.fit(pages)):
        got = html_extract.extract(pages, model).toPandas()
        assert (got[got.page_id < 12].text == want).all() and len(got) == len(rows)
        by = got.dropna(subset=["page_id"]).set_index("page_id")
        assert (by.text[50], by.text[51], by.text[52]) == ("", "", "just text") and by.n_chars[0] == len(want)
    assert html_extract.extract(pages.limit(0), html_extract.fit(pages.limit(0))).count() == 0


def test_marginals_sum_over_all_states():
    """Message passing gives the marginals of the joint distribution."""
    nodes, _ = html_extract.parse("<body><div class=ad>x<p>yy</p></div><main><p>zzz</p><p>w</p></main></body>")
    model, n = html_extract.FIXED, len(nodes)
    total, on = 0.0, [0.0] * n
    for state in range(1 << n):
        s = [state >> i & 1 for i in range(n)]
        p = math.exp(s[0] * model["root"])
        for i in range(1, n):
            x = sum(model["node"].get(f, 0.0) * (1.0 if f[0] in "tn" else 0.5) for f in html_extract.features(nodes[i], i / n))
            keep1, keep0 = model["edge"][html_extract.kind(nodes[nodes[i].parent])]
            above = s[nodes[i].parent]
            p *= math.exp(s[i] * x) * ((keep1 if s[i] else 1 - keep1) if above else (1 - keep0 if s[i] else keep0))
        total += p
        for i in range(n):
            on[i] += p * s[i]
    assert html_extract.marginals(nodes, model) == pytest.approx([x / total for x in on])


def test_lm_score_equals_brute_force(make):
    rng = random.Random(6)
    rows = [(i, prose(rng, "aa" if i % 3 else "bb", 25), i % 3 == 0) for i in range(60)] + [(90, None, True), (91, "", False), (92, " \n", True), (None, "the the", False), (60, "the er", False), (60, "the er", False)]
    docs = make(rows, "doc_id bigint, text string, good boolean", extra=True).coalesce(1)
    got = lm_score.score(docs, F.col("good")).toPandas()
    texts = [(t or "").lower().split() for _, t, _ in rows]
    uni, bi = [Counter(), Counter()], [Counter(), Counter()]
    own = [Counter(zip([None, *t], t, strict=False)) for t in texts]
    for (_, _, good), t, o in zip(rows, texts, own, strict=True):
        for m in (0, 1) if good else (0,):
            uni[m].update(t)
            bi[m].update(o)
    starts = [len(rows), sum(r[2] for r in rows)]
    n, words = [sum(u.values()) for u in uni], len(uni[0])
    seen = Counter(p for o in own for p in o.elements())
    total = sum(seen.values())
    want = []
    for (_, _, good), t, o in zip(rows, texts, own, strict=True):
        loss = 0.0
        for (v, w), k in o.items():
            # Frequent bigrams are scored with all counts; in one part this small, that is all that come twice.
            p = []
            for m in (0, 1):
                c = bi[m][v, w] - (k if (m == 0 or good) and not (seen[v, w] > 1 and seen[v, w] * lm_score.VOCABULARY >= total) else 0)
                backing = (uni[m][w] + lm_score.B) / (n[m] + lm_score.B * (words + 1))
                p.append((c + lm_score.A * backing) / ((uni[m][v] if v is not None else starts[m]) + lm_score.A))
            loss += k * (math.log(p[0]) - math.log(p[1]))
        want.append((len(t), loss / max(1, len(t))))
    have, want = sorted(zip(got.n_tokens, got.score, strict=True)), sorted(want)
    assert [n for n, _ in have] == [n for n, _ in want]
    assert sorted(x for _, x in have) == pytest.approx(sorted(x for _, x in want))
    assert lm_score.score(docs.limit(0), F.col("good")).count() == 0


def many_words():
    """800,000 tokens, half of them of words that come two times about: no word with fewer than four is broadcast."""
    rng = random.Random(8)
    word = lambda: f"c{rng.randrange(500)}" if rng.random() < 0.5 else f"r{rng.randrange(200_000)}"
    return [(i, " ".join(word() for _ in range(2000)), i % 3 == 0) for i in range(400)]


def brute_scores(rows, heavy_own):
    """Scores by id; ``heavy_own``: bigrams with 1/2^18 of all tokens, twice at least, are scored with all counts."""
    texts = [t.lower().split() for _, t, _ in rows]
    own = [Counter(zip([None, *t], t, strict=False)) for t in texts]
    uni, bi = [Counter(), Counter()], [Counter(), Counter()]
    for (_, _, good), t, o in zip(rows, texts, own, strict=True):
        for m in (0, 1) if good else (0,):
            uni[m].update(t)
            bi[m].update(o)
    starts, n, words = [len(rows), sum(r[2] for r in rows)], [sum(u.values()) for u in uni], len(uni[0])
    want = {}
    for (i, _, good), t, o in zip(rows, texts, own, strict=True):
        loss = 0.0
        for (v, w), k in o.items():
            heavy = bi[0][v, w] > 1 and bi[0][v, w] << 18 >= n[0]
            for m, sign in (0, 1), (1, -1):
                c = bi[m][v, w] - (k if (m == 0 or good) and not (heavy and heavy_own) else 0)
                backing = (uni[m][w] + lm_score.B) / (n[m] + lm_score.B * (words + 1))
                loss += sign * k * math.log((c + lm_score.A * backing) / ((uni[m][v] if v is not None else starts[m]) + lm_score.A))
        want[i] = loss / max(1, len(t))
    return want


def test_lm_score_knows_rare_words(make):
    rows = [*many_words(), *((1000 + i, f"c1 c2 only{i} c3 only{i}", i == 0) for i in range(3)), (1003, "c4 only0 c4", False), (1004, "c4 only1 c4", False)]
    got = {r.doc_id: r.score for r in lm_score.score(make(rows, "doc_id bigint, text string, good boolean").coalesce(1), F.col("good")).collect()}
    assert got == pytest.approx(brute_scores(rows, heavy_own=True))
    assert got[1003] < got[1004] - 0.01


def test_lm_score_leaves_out_own_counts_of_all_bigrams(spark, make, tmp_path):
    """A text that repeats itself does not predict itself, and files laid out in another way give the same scores."""
    rows = [*many_words()[:60], (1000, "so it goes on " * 200, True), (1001, "and on it went " * 200, False)]
    schema = "doc_id bigint, text string, good boolean"
    want = brute_scores(rows, heavy_own=False)
    for parts in (1, 7):
        folder = tmp_path / str(parts)
        docs = make(rows, schema)
        docs.select("doc_id", "text").repartition(parts).write.parquet(f"{folder}/documents.parquet")
        docs.selectExpr("doc_id", "int(good) AS quality", "0 AS toxic").coalesce(1).write.parquet(f"{folder}/labels.parquet")
        got = {r.doc_id: r.score for r in workload.op10_lm_score(spark, str(folder)).collect()}
        assert got == pytest.approx(want), parts


def test_pipeline_stages_keep_columns_and_clean_rows(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        made = stage(spark, out, SF)
        assert made.columns == docs.columns, name
        out = made.checkpoint()
        assert out.select("doc_id").distinct().count() == out.count() > 100
    pieces = corpus_pipeline.STAGES[-1][1](spark, out, SF)
    assert pieces.select("doc_id").distinct().count() == out.count()


def test_pipeline_near_stage_links_at_five_words_and_0_8(spark, make):
    import corpus_pipeline

    words = [f"w{i}" for i in range(500)]
    more = [*words, *(f"x{i}" for i in range(100))]
    other = [f"{w}y" for w in words]
    edited = [f"z{i}" if i % 45 == 20 else w for i, w in enumerate(other)]
    assert sum(a != b for a, b in zip(other, edited, strict=True)) == 11
    rows = [(1, " ".join(words)), (2, " ".join(more)), (3, " ".join(other)), (4, " ".join(edited)), (5, " ".join(f"v{i}" for i in range(50)))]
    assert {r.doc_id for r in corpus_pipeline.near_stage(spark, make(rows, extra=True), "").collect()} == {1, 3, 5}
    # Neither pair links by the rule of op3.
    assert {r.component_id for r in jaccard_join.near_groups(make(rows)).collect()} == {1, 2, 3, 4, 5}


def test_op4_query_keeps_one_row_a_group(spark):
    got = workload.op4_exact_dedup(spark, SF)
    assert got.filter("kept").count() == got.select("text_sha256").distinct().count()
