"""Shards of integer vectors and the queries that visit them.

Vectors go to shards by a hash, a bounded number of components to each (and a shard to every
core at least). Every query is sent to every shard once; in a shard's task the vectors come
first, so that its index is built, and the queries then stream past it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: components of a shard's vectors
COMPONENTS = 4_000_000


def integer_vectors(embeddings: DataFrame, scale: int, *more: Column) -> DataFrame:
    """vec_id, vector (floor of ``scale`` times each component), and ``more``: rows with an id and a vector
    that holds neither nulls nor numbers that are not finite."""
    v = F.transform("embedding", lambda x: x.cast("double"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = embeddings.where("vec_id IS NOT NULL AND embedding IS NOT NULL").select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"), *more)
    return rows.where(~bad).withColumn("vector", F.transform("v", lambda x: F.floor(x * scale).cast("long"))).drop("v")


def of_equal(rows: DataFrame, by: list[str], most: int) -> DataFrame:
    """One row per distinct ``by``: its ``most`` smallest distinct vec_ids, as ids. No answer needs more
    of equal vectors, so a vector that a third of all rows have is one short row."""
    rank = F.row_number().over(Window.partitionBy(*by).orderBy("vec_id"))
    distinct = rows.groupBy("vec_id", *by).agg(F.lit(0).alias("one")).drop("one")
    return distinct.withColumn("r", rank).where(F.col("r") <= most).groupBy(*by).agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))


def shard_count(nodes: DataFrame, components: int = COMPONENTS) -> int:
    total = nodes.agg(F.sum(F.size("vector") + 1)).first()[0] or 0
    return max(nodes.sparkSession.sparkContext.defaultParallelism, -(-total // components))


def meet(nodes: DataFrame, asked: DataFrame, shards: int, build: Callable, answer: Callable, schema: str) -> DataFrame:
    """Answers of every shard to every query.

    ``nodes`` has ids, label and vector, ``asked`` has vec_id, label, vector and windows (an array of longs).
    ``build(vectors, labels, ids)`` makes the index of a shard's vectors of one length, and
    ``answer(index, vec_id, label, vector, windows)`` yields rows of ``schema``. Vectors meet vectors of their own length.
    """
    no = F.lit(None)
    rows = nodes.select(F.pmod(F.xxhash64("vector"), F.lit(shards)).cast("int").alias("shard"), F.lit(0).alias("asks"), no.cast("long").alias("vec_id"),
                        "ids", "label", "vector", no.cast("array<long>").alias("windows"))
    each = F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    asks = asked.select(each.alias("shard"), F.lit(1).alias("asks"), "vec_id", no.cast("array<long>").alias("ids"), "label", "vector", "windows")
    both = rows.union(asks).withColumn("size", F.size("vector")).repartitionById(shards, F.col("shard"))
    columns = [c.split()[0] for c in schema.split(", ")]

    def visit(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts: dict[int, list] = {}
        index: dict[int, object] = {}
        for pdf in batches:
            own = pdf[pdf["asks"] == 0]
            for size, part in own.groupby("size"):
                vectors = np.concatenate(part["vector"].tolist()).reshape(len(part), size)
                parts.setdefault(size, []).append((vectors, part["label"].to_numpy(), part["ids"].tolist()))
            out = []
            for row in pdf[pdf["asks"] == 1].itertuples(index=False):
                if row.size not in index:
                    held = parts.pop(row.size, None)
                    index[row.size] = held and build(np.concatenate([x[0] for x in held]), np.concatenate([x[1] for x in held]),
                                                     [i for x in held for i in x[2]])
                if index[row.size]:
                    out += answer(index[row.size], row.vec_id, row.label, row.vector, row.windows)
            if out:
                yield pd.DataFrame(out, columns=columns)

    return both.sortWithinPartitions("asks", "size").mapInPandas(visit, schema)


def queries(rows: DataFrame, *more: str) -> DataFrame:
    """One row per vec_id: a repeated id asks once, with the smallest of its rows."""
    s = F.min(F.struct(*more, "vector")).alias("s")
    return rows.groupBy("vec_id").agg(s).select("vec_id", "s.*")
