"""The queries of this subpackage over the given tables, and SQL for those that it can express."""

from __future__ import annotations

import hashlib

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm import byte_bpe, cover_tree, exact_dedup, html_extract, jaccard_join, language_id, lm_score, packing, pattern_packing, prefix_trie, sharding, token_alignment, toxicity
from gridloom.llm.common import raw_text, table

SHARDS = 40


def packed(docs: DataFrame) -> DataFrame:
    pieces = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_text()
    keys = table(spark, sf_dir, "documents").select("doc_id", (F.octet_length(raw) + 16).cast("bigint").alias("size"), F.crc32(raw).alias("text_crc32"))
    plan = sharding.shard_plan(keys, ["doc_id", "size", "text_crc32"], SHARDS)
    return plan.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_groups(table(spark, sf_dir, "documents"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact_dedup.exact_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = byte_bpe.encode_and_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return done.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op5_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.near_vectors(table(spark, sf_dir, "embeddings"), 0.9)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels, ~toxicity.held_out())
    found = toxicity.score(docs, model)
    return found.select("doc_id", toxicity.held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), "n_clauses")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.fit(docs, ~language_id.held_out())
    return language_id.predict(docs, model).select("doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score", "rejected")


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_extract.extract(pages, html_extract.fit(pages))


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target model counts the documents of quality 1. Their ids are broadcast if they are counted to be few; else
    both sides are dealt out by id."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    good = labels.filter("quality = 1").select(F.col("doc_id").alias("_good")).distinct()
    good = F.broadcast(good) if good.count() <= jaccard_join.BROADCAST_IDS else good.hint("merge")
    marked = docs.select("doc_id", "text").join(good, F.col("doc_id") == F.col("_good"), "left")
    return lm_score.score(marked, F.col("_good").isNotNull(), heavy_own=False)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    sequences, convs = prefix_trie.forked(prefix_trie.turns(table(spark, sf_dir, "conversations")))
    nodes, ends = prefix_trie.build(sequences, convs)
    found = nodes.join(prefix_trie.digests(ends), prefix_trie.NODE, "left").withColumnRenamed("saved", "saved_tokens")
    named = F.coalesce("sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256")
    return found.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", named)


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = (public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    docs, _ = token_alignment.correspondences(table(spark, sf_dir, "documents"), *paths, digest=True)
    return docs.withColumnRenamed("groups", "groups_sha256")


def op13_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only what is returned of a piece goes through the shuffle by length, not its ids."""
    pieces = pattern_packing.pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pattern_packing.assign(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


QUERIES = {
    "op1_packing": op1_packing,
    "op2_sharding": op2_sharding,
    "op3_ngram_jaccard_join": op3_ngram_jaccard_join,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_cover_tree": op5_cover_tree,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_toxicity": op7_toxicity,
    "op8_language_id": op8_language_id,
    "op9_html_extraction": op9_html_extraction,
    "op10_lm_score": op10_lm_score,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_token_alignment": op12_token_alignment,
    "op13_pattern_packing": op13_pattern_packing,
}

ORACLES = {
    # The checksum of a decimal number, bit by bit; a node is the list of its turns' digests.
    "op11_prefix_trie": """
        WITH t AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS k,
                   sha256(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS d, length(coalesce(text, '')) AS n
                   FROM conversations WHERE conv_id IS NOT NULL),
             ids AS (SELECT c, c - c % 100 AS base, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
                   lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))) AS r
                   FROM (SELECT DISTINCT c FROM t)),
             h AS (SELECT c, base, xor(r, 4294967295) % 6 AS h FROM ids),
             rows AS (SELECT h.c, t.k AS o, d, n FROM h JOIN t ON t.c = h.base AND t.k <= h UNION ALL SELECT h.c, t.k AS o, d, n FROM h JOIN t ON t.c = h.c AND t.k > h),
             seq AS (SELECT c, row_number() OVER w AS depth, string_agg(d, '') OVER w AS key, n, count(*) OVER (PARTITION BY c) AS total FROM rows WINDOW w AS (PARTITION BY c ORDER BY o)),
             every AS (SELECT c, depth, key, n, depth = total AS last FROM seq
                   UNION ALL SELECT c, 0, '', 0, NOT EXISTS (SELECT 1 FROM seq WHERE seq.c = h.c) FROM h),
             nodes AS (SELECT key, any_value(depth) AS depth, min(c) AS conv_id, count(*) AS n_convs, any_value(n) AS n,
                   sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE last), '')) AS ends FROM every GROUP BY key),
             own AS (SELECT *, (n_convs - 1) * n AS own, NOT EXISTS (SELECT 1 FROM nodes m WHERE m.depth = nodes.depth + 1 AND m.key[:64 * nodes.depth] = nodes.key) AS leaf FROM nodes),
             up AS (SELECT key[:64 * e.e] AS key, sum(leaf::INT) AS n_leaves, sum(own) AS saved FROM own, LATERAL (SELECT unnest(range(0, depth + 1)) AS e) e GROUP BY 1)
        SELECT v.conv_id, v.depth, p.conv_id AS parent_conv_id, v.n_convs, (SELECT count(*) FROM nodes m WHERE m.depth = v.depth + 1 AND m.key[:64 * v.depth] = v.key) AS n_children,
               u.n_leaves::BIGINT AS n_leaves, u.saved::BIGINT AS saved_tokens, v.ends AS ends_sha256
        FROM nodes v JOIN up u ON u.key = v.key LEFT JOIN nodes p ON p.depth = v.depth - 1 AND p.key = v.key[:64 * (v.depth - 1)]""",
    "op4_exact_dedup": r"""
        WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS h, length(coalesce(text, '')) AS n FROM documents)
        SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
               row_number() OVER w = 1 AS kept, h AS text_sha256
        FROM t WINDOW w AS (PARTITION BY h ORDER BY n DESC, doc_id)""",
}
