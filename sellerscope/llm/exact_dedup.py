"""Exact dedup by content-defined chunk recipes, in DataFrame functions only.

A text, without its ASCII white space, is cut where its own content says so, so equal
passages give equal chunks wherever they stand. Every chunk's content is moved once, to
a dictionary that verifies that a 64-bit chunk hash names one content; where it does
not, the contents get ordinals. Documents are then compared by their ordered lists of
verified identifiers: two documents are equal exactly if their lists are equal. Long
texts are not moved again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sellerscope.llm.common import WHITE, cut, text_or_empty, unused

#: chunk lengths in characters, and the characters after which a chunk may end
MIN_CHUNK, MAX_CHUNK, CUTS = 256, 2048, "[.,;:!?|%#&$*]"


def chunk_pattern(least: int = MIN_CHUNK, most: int = MAX_CHUNK) -> str:
    return rf"(?s).{{{least},{most - 1}}}?{CUTS}|.{{1,{most}}}"


def chunk_hash(chunk: Column) -> Column:
    return F.xxhash64(chunk)


def exact_groups(docs: DataFrame, least: int = MIN_CHUNK, most: int = MAX_CHUNK,
                 hashed: Callable[[Column], Column] = chunk_hash) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, keep_id, group_size, kept, text_sha256.

    Null texts count as empty, and empty texts equal one another. Of equal texts the row
    with the most code points in its original text stays, then the smallest doc_id; null
    doc_ids come last. Repeated rows of one doc_id are counted each and share ``kept``.
    Other columns of ``docs`` are not read. An empty table gives an empty result.
    """
    docs = docs.select("doc_id", text_or_empty().alias("text"))
    chunked = docs.select("doc_id", F.char_length("text").alias("points"), F.translate("text", WHITE, "").alias("norm"))
    chunked = chunked.select("doc_id", "points", F.sha2("norm", 256).alias("text_sha256"),
                             F.regexp_extract_all("norm", F.lit(chunk_pattern(least, most)), F.lit(0)).alias("chunks"))
    # recipes: one small row per document
    recipes = cut(chunked.select("doc_id", "points", "text_sha256",
                                 F.transform("chunks", hashed).alias("recipe")), "recipes")
    # the dictionary: every content is moved once, combined before the shuffle
    contents = chunked.select(F.explode("chunks").alias("chunk")).select(hashed(F.col("chunk")).alias("h"), "chunk").distinct()
    ambiguous = cut(contents.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"), "ambiguous")
    if ambiguous.isEmpty():
        recipes = recipes.withColumn("ordinals", F.array().cast("array<int>"))
    else:
        recipes = _with_ordinals(recipes, chunked, contents, ambiguous, hashed)
    groups = (recipes.groupBy("recipe", "ordinals")
              .agg(F.min(F.struct(-F.col("points"), F.col("doc_id").isNull(), "doc_id")).alias("best"),
                   F.count("*").alias("group_size"))
              .select(F.col("recipe").alias("r"), F.col("ordinals").alias("o"),
                      F.col("best.doc_id").alias("keep_id"), "group_size"))
    return (recipes.join(groups, (F.col("recipe") == F.col("r")) & (F.col("ordinals") == F.col("o")))
            .select("doc_id", "keep_id", "group_size",
                    F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"))


def _with_ordinals(recipes, chunked, contents, ambiguous, hashed) -> DataFrame:
    """Complete the identifiers of hashes that name several contents by the content's rank."""
    number = F.row_number().over(Window.partitionBy("h").orderBy("chunk"))
    named = contents.join(ambiguous, "h", "left_semi").withColumn("ordinal", number)
    use = chunked.select("text_sha256", F.posexplode("chunks").alias("pos", "chunk")).withColumn("h", hashed(F.col("chunk")))
    use = use.join(named, ["h", "chunk"]).select("text_sha256", "pos", "ordinal").distinct()
    lists = use.groupBy("text_sha256").agg(F.sort_array(F.collect_list(F.struct("pos", "ordinal"))).alias("l"))
    lists = lists.select(F.col("text_sha256").alias("t"), F.transform("l", lambda x: x["ordinal"]).alias("found"))
    joined = recipes.join(lists, F.col("text_sha256") == F.col("t"), "left")
    return joined.select(*recipes.columns, F.coalesce("found", F.array().cast("array<int>")).alias("ordinals"))


def drop_exact_copies(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; one row of each doc_id and text.

    Repeated rows of a doc_id that stays: the one with the most code points, then the
    smallest text, remains.
    """
    groups = cut(exact_groups(docs, **options), "groups")
    kept_id, rows, rank = unused("kept_id"), unused("rows"), unused("rank")
    kept = groups.where("kept").groupBy(F.col("doc_id").alias(kept_id)).agg(F.count("*").alias(rows))
    same = F.col("doc_id").eqNullSafe(F.col(kept_id))
    once = docs.join(kept.where(F.col(rows) == 1), same, "left_semi")
    if kept.where(F.col(rows) > 1).isEmpty():
        return once
    order = Window.partitionBy("doc_id").orderBy(F.char_length(text_or_empty()).desc(), "text")
    more = docs.join(kept.where(F.col(rows) > 1), same, "left_semi").withColumn(rank, F.row_number().over(order))
    return once.unionByName(more.where(F.col(rank) == 1).drop(rank))
