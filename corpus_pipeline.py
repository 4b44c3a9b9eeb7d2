"""A cleaning pipeline over documents: each stage is one operator of gridloom.llm, written and read again in between.

toxic documents go; documents without a language go; of equal texts one stays; of each group of near copies one stays; what
is left is packed into sequences. All stages but the last keep the columns that documents came with, others included.
Toxicity and language judge a text, so each row goes or stays by its own text, whatever its id is: null, or that of other rows,
too. The near stage knows documents by id: rows that share one are one document there, and rows without one stay.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm import exact_dedup, jaccard_join, language_id, toxicity
from gridloom.llm.common import cut, free_name, ship, slices, table
from gridloom.llm.workload import packed

#: What near copies are here.
NEAR = jaccard_join.Scheme(5, 80)


def kept(docs: DataFrame, judge: Callable[[list[str | None]], list[bool]]) -> DataFrame:
    """The rows whose text ``judge`` keeps. Each row is judged where it is: nothing is shuffled and no id is looked at."""
    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            for some in slices(batch, "text"):
                yield some.filter(pa.array(judge(some.column(at).to_pylist()), pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """docs but those whose id is in ``dropped``, a table of one column."""
    name = free_name(docs, "_dropped")
    return docs.join(dropped.toDF(name).distinct(), F.col("doc_id") == F.col(name), "left_anti")


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text scores 0.3 or more go."""
    ship(spark)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), ~toxicity.held_out())
    return kept(docs, lambda texts: [p < 0.3 for p in toxicity.probabilities(texts, model)[0].tolist()])


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text has no letter or is like no learned language go."""
    ship(spark)
    model = language_id.fit(docs, ~language_id.held_out())
    return kept(docs, lambda texts: [not language_id.judge(text, model)[2] for text in texts])


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (white space aside), the longest stays, then the smallest id."""
    ship(spark)
    return exact_dedup.keep_one(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by near copies (sets of five-word shingles with a Jaccard similarity of 0.8 or more), the smallest
    id stays. Query op3 has its own rule: four words, 0.85."""
    ship(spark)
    bad = jaccard_join.near_groups(docs, NEAR).filter("doc_id <> component_id").select(F.col("doc_id").alias("_id"))
    return without(docs, cut(bad))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences, as of query op1_packing."""
    ship(spark)
    return packed(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("language", language_stage),
    ("exact dedup", exact_stage),
    ("near dedup", near_stage),
    ("packing", packing_stage),
]

#: Learned models and tokenizers are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir, with Parquet files in the shared folder between them."""
    docs = table(spark, sf_dir, "documents")
    cut(spark.range(1))  # a checkpoint folder is set from here on
    folder = spark.sparkContext.getCheckpointDir()
    for number, (_, stage) in enumerate(STAGES):
        made = stage(spark, docs, sf_dir)
        if number == len(STAGES) - 1:
            return made
        path = f"{folder}/pipeline-{uuid.uuid4().hex}"
        made.write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
