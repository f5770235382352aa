"""The corpus pipeline: each stage applies one operator of ``sellerscope.llm`` to what its predecessor kept.

Rows that the quality classifier rejects go; of equal texts, then of near copies, one row
stays; the mixture puts the rows in order; packing gives each remaining document's pieces
their sequences. No stage but the last changes a column. SQL cannot state the classifier,
so there is no ORACLE_SQL; tests/llm/test_order.py holds each stage against brute force.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sellerscope.llm import exact_dedup, mixing, near_dedup, packing
from sellerscope.llm.common import cut, read_table
from sellerscope.llm.quality import drop_low_quality

TOKENIZER = "word_bpe_49k.json"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_low_quality(docs, read_table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_exact_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.drop_near_copies(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.in_order(mixing.mix(docs), docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``docs`` is the written mixture: its order is that of its files' numbers and of the rows inside them."""
    part, piece = (F.regexp_extract("_metadata.file_name", r"^part-(\d+)-.*-c(\d+)", i).cast("long") for i in (1, 2))
    docs = docs.withColumns({"_part": part * 1_000_000 + piece, "_row": F.col("_metadata.row_index")})
    return packing.pack(docs, public_tokenizers.path(TOKENIZER), order=("_part", "_row"))


STAGES = [("quality", quality), ("exact dedup", exact), ("near dedup", near), ("mixture", mixture), ("packing", packed)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
