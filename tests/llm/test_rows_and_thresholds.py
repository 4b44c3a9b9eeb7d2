"""Pairs exactly on a threshold, and pipeline stages on null and repeated ids."""

import itertools
import time
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.llm import common, cover_tree

SF = "/root/testdata/sf0.001"


def test_pairs_on_the_threshold_are_decided_by_the_direct_formula(spark):
    """Small whole numbers with a cosine of exactly 9/10, in every order and scale: none is lost to the rounding of unit vectors."""
    base = [(1, 0, 0, 0), (9, 3, 3, 1), (0, 1, 0, 0), (9, 3, 3, -1), (9, 1, 3, 3)]
    vectors = sorted({tuple(k * x for x in p) for v in base for p in itertools.permutations(v) for k in (1, 3, 7)})
    x = np.array(vectors, float)
    direct = (x[:, None, :] * x[None, :, :]).sum(-1) / (np.sqrt((x * x).sum(1))[:, None] * np.sqrt((x * x).sum(1))[None, :])
    links = direct >= 0.9
    assert np.isclose(direct, 0.9, atol=1e-12, rtol=0).sum() > 100
    rows = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(vectors)], "vec_id bigint, embedding array<double>")
    got = cover_tree.near_vectors(rows).toPandas().set_index("vec_id")
    assert [got.n_links[i] for i in range(len(x))] == (links.sum(1) - 1).tolist()


@pytest.mark.parametrize("extra", [False, True])
def test_stages_judge_rows_by_their_own_text(spark, extra):
    """A rejected text goes under every id it has; a clean row stays whatever id it shares."""
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet").filter("toxic = 1").join(docs, "doc_id")
    bad = labels.select("text").first()[0]
    clean = docs.join(spark.read.parquet(f"{SF}/labels.parquet").filter("toxic = 0"), "doc_id").orderBy("doc_id").first()["text"]
    more = [(None, bad, "a"), (10_001, bad, "b"), (10_001, clean, "c"), (None, clean, "d"), (None, None, "e"), (10_002, "12 34", "f"), (10_002, clean, "g")]
    table = docs.selectExpr("doc_id", "text", "lang", "'x' AS mark").unionByName(spark.createDataFrame(more, "doc_id bigint, text string, mark string"), allowMissingColumns=True)
    table = table.selectExpr("*", "'y' AS _dropped") if extra else table
    kept = corpus_pipeline.toxicity_stage(spark, table, SF)
    assert kept.columns == table.columns
    assert {r.mark for r in kept.select("mark").collect()} - {"x"} == {"c", "d", "e", "f", "g"}
    kept = corpus_pipeline.language_stage(spark, table, SF)
    assert {r.mark for r in kept.select("mark").collect()} - {"x"} == {"a", "b", "c", "d", "g"}


def test_an_empty_table_goes_through_every_stage(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0
    assert corpus_pipeline.packing_stage(spark, docs, SF).count() == 0


def test_a_long_text_passes_the_scoring_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    clean = docs.join(spark.read.parquet(f"{SF}/labels.parquet").filter("toxic = 0"), "doc_id").orderBy("doc_id").first()["text"]
    table = docs.union(spark.createDataFrame([(20_000, (clean + " ") * (2_000_000 // len(clean)), None)], "doc_id bigint, text string, lang string"))
    for stage in (corpus_pipeline.toxicity_stage, corpus_pipeline.language_stage):
        assert stage(spark, table, SF).filter("doc_id = 20000").count() == 1


def test_run_packs_what_the_stages_leave(spark):
    """All stages through files, against the stages called one by one."""
    import corpus_pipeline

    got = corpus_pipeline.run(spark, SF).toPandas()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF).checkpoint()
    left = {r.doc_id for r in docs.select("doc_id").collect()}
    assert set(got.doc_id) == left and got.groupby("doc_id").length.sum().sum() == got.drop_duplicates("doc_id").doc_tokens.sum()
    by = got.sort_values(["sequence_id", "offset"])
    assert (by.groupby("sequence_id").length.sum().iloc[:-1] == 2048).all()


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n")
    return {f for f in files if "/shuffle_" in f}


def test_shuffle_files_behind_a_checkpoint_go(spark):
    counted = spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count()
    for before in (None, "false"):
        if before is not None:
            spark.conf.set(common.RELEASE, before)
        there = shuffle_files(spark)
        made = common.cut(counted)
        until = time.time() + 20
        while shuffle_files(spark) - there and time.time() < until:
            time.sleep(0.1)
        assert not shuffle_files(spark) - there
        assert spark.conf.get(common.RELEASE, None) == before
        assert sorted(map(tuple, made.collect())) == sorted(map(tuple, counted.collect())) == [(k, 100) for k in range(10)]
    spark.conf.unset(common.RELEASE)


def test_a_cluster_needs_a_shared_checkpoint_folder():
    assert common.checkpoint_folder("yarn", "hdfs:///kept") == "hdfs:///kept" and common.checkpoint_folder("local[8]", "/kept") == "/kept"
    assert Path(common.checkpoint_folder("local[8]", None)).is_dir()
    for master in ("yarn", "spark://host:7077", "local-cluster[3,2,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            common.checkpoint_folder(master, None)
