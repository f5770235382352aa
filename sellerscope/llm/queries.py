"""The queries of this package: opN_<name> over whole tables, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sellerscope.llm import (ann, classlm, exact_dedup, langid, licenses, linededup, maxscore, mixing, near_dedup, packing, quality,
                            rtree, trie)
from sellerscope.llm.common import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def op7_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_groups(read_table(spark, sf_dir, "documents"))


SQL["op7_exact_dedup"] = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = first_value(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM d WINDOW w AS (PARTITION BY norm ORDER BY points DESC, doc_id)
"""


@query
def op3_minhash_near_dedup(spark, sf_dir):
    return near_dedup.near_groups(read_table(spark, sf_dir, "documents"))


@query
def op2_best_fit_packing(spark, sf_dir):
    import public_tokenizers

    return packing.pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op5_pfair_mixing(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source")
    return mixing.mix(docs).select("doc_id", "source", F.col("_component").alias("component"), F.col("_block").alias("block"),
                                   F.col("_release").alias("release"), F.col("_turn").alias("turn"),
                                   F.col("_deadline").alias("deadline"), F.col("_slot").alias("slot"), F.col("_place").alias("place"))


@query
def op6_quality_classifier(spark, sf_dir):
    return quality.quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def _fold(folds: int):
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(folds))


@query
def op1_kneser_ney_langid(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    out = langid.identify(docs, langid.fit(docs, _fold(4) != 2))
    return out.select("doc_id", (_fold(4) == 2).alias("held_out"), "lang_pred", "score", "bits", "rejected")


@query
def op8_class_lm_scoring(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    out = classlm.score(docs, _fold(7) != 2)
    return out.withColumn("held_out", _fold(7) == 2).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op9_hnsw_neighbours(spark, sf_dir):
    vectors = read_table(spark, sf_dir, "embeddings")
    return ann.search(vectors, vectors.where("vec_id % 100 = 0"))


@query
def op10_line_dedup(spark, sf_dir):
    return linededup.line_groups(read_table(spark, sf_dir, "documents"))


@query
def op4_license_scan(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    return licenses.scan(docs, licenses.fit(docs))


@query
def op11_prefix_trie(spark, sf_dir):
    return trie.prefix_trie(read_table(spark, sf_dir, "conversations"))


SQL["op11_prefix_trie"] = r"""
WITH t AS (
  SELECT conv_id AS c, turn, coalesce(text, '') AS text,
         sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS tid
  FROM conversations WHERE conv_id IS NOT NULL),
numbered AS (
  SELECT c, tid, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words,
         row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, tid) AS i
  FROM t),
convs AS (  -- crc32 bit by bit: a decimal digit enters before every eighth step
  SELECT c, c - c % 20 AS base,
         xor(list_reduce([4294967295::BIGINT] || list_transform(range(8 * length(c::VARCHAR)), lambda i:
               CASE WHEN i % 8 = 0 THEN ascii(substr(c::VARCHAR, (i // 8 + 1)::INT, 1))::BIGINT ELSE 0::BIGINT END),
             lambda a, b: xor(xor(a, b) >> 1, CASE WHEN xor(a, b) % 2 = 1 THEN 3988292384::BIGINT ELSE 0::BIGINT END)), 4294967295::BIGINT) % 4 AS h
  FROM (SELECT DISTINCT c FROM t)),
rebuilt AS (
  SELECT convs.c, 0 AS own, i, tid, words FROM convs JOIN numbered n ON n.c = base AND i <= h
  UNION ALL
  SELECT convs.c, 1, i, tid, words FROM convs JOIN numbered n ON n.c = convs.c AND i > h),
chain AS (
  SELECT c, row_number() OVER w AS depth, string_agg(tid, '') OVER w AS node, words
  FROM rebuilt WINDOW w AS (PARTITION BY c ORDER BY own, i ROWS UNBOUNDED PRECEDING)),
member AS (
  SELECT c, depth, node, words FROM chain
  UNION ALL SELECT c, 0, '', 0 FROM convs),
own AS (SELECT c, max(depth) AS whole FROM member GROUP BY c),
nodes AS (
  SELECT node, depth, min(c) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
         coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE depth = whole), '') AS ends
  FROM member JOIN own USING (c) GROUP BY node, depth),
child AS (SELECT substr(node, 1, 64 * (depth - 1)) AS node, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
full_node AS (SELECT nodes.*, coalesce(child.n, 0) AS n_children FROM nodes LEFT JOIN child USING (node)),
below AS (  -- every node counts for each of its prefixes
  SELECT substr(node, 1, (64 * d)::INT) AS node, sum((n_children = 0)::INT) AS n_leaves, sum((n_convs - 1) * words) AS saved
  FROM full_node, unnest(range(depth + 1)) AS up(d) GROUP BY 1)
SELECT f.conv_id, f.depth, p.conv_id AS parent_conv_id, f.n_convs, f.n_children::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves,
       saved::BIGINT AS saved_tokens, sha256(f.ends) AS ends_sha256
FROM full_node f JOIN below USING (node) LEFT JOIN full_node p ON f.depth > 0 AND p.node = substr(f.node, 1, (64 * (f.depth - 1))::INT)
"""


@query
def op12_maxscore_topk(spark, sf_dir):
    vectors = read_table(spark, sf_dir, "embeddings")
    return maxscore.search(vectors, vectors.where("vec_id % 100 = 0"))


_INTEGERS = r"""
  SELECT DISTINCT vec_id, {label} AS label, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"""
_PRODUCT = "coalesce(list_sum(list_transform(range(len({0})), lambda i: {0}[i + 1] * {1}[i + 1])), 0)::BIGINT"

SQL["op12_maxscore_topk"] = f"""
WITH v AS ({_INTEGERS.format(label=0, scale=1024)}),
asked AS (SELECT vec_id AS query_id, min(v) AS q FROM v WHERE vec_id % 100 = 0 GROUP BY vec_id),
pairs AS (
  SELECT query_id, vec_id, {_PRODUCT.format("q", "v")} AS score FROM asked JOIN v ON query_id <> vec_id AND len(q) = len(v))
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
FROM pairs QUALIFY rank <= 10
"""


@query
def op13_rtree_negatives(spark, sf_dir):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding", label.alias("label"))
    return rtree.mine(vectors, vectors.where("vec_id % 100 = 0"))


SQL["op13_rtree_negatives"] = f"""
WITH v AS (SELECT * FROM ({_INTEGERS.format(label="CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END", scale=256)}) WHERE label IS NOT NULL),
anchor AS (SELECT vec_id AS anchor_id, unnest(min({{'l': label, 'q': v}})) FROM v WHERE vec_id % 100 = 0 GROUP BY vec_id),
pairs AS (
  SELECT anchor_id, vec_id, label = l AS same, {_PRODUCT.format("q", "v")} AS score
  FROM anchor JOIN v ON anchor_id <> vec_id AND len(q) = len(v)),
positive AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INT AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positive JOIN pairs USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY rank <= 5
"""
