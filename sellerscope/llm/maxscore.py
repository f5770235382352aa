"""Exact top-k by inner product: MaxScore over the postings of integer vectors.

A coordinate and a sign are a term; its postings are the vectors with a component of that sign. A query's
term adds at most its bound, the query's component times the largest such component. Terms whose
bounds together stay below the k-th best score so far are non-essential: a vector in no essential posting cannot
reach it. So the essential postings are traversed, and what they found is probed in the other terms, strongest
first, while it is competitive: its sum and the bounds still to come reach the k-th score. Terms of
the sign against the query only lower a sum; their bound is 0. A shard's vectors are traversed in chunks with bounds of
their own, and the shards' best are merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sellerscope.llm.common import cut
from sellerscope.llm.shards import integer_vectors, meet, of_equal, queries, shard_count

SCALE, CHUNK = 1024, 2048


class Chunk:
    """Postings of some vectors: the places of positive and of negative components, and the extremes, by coordinate."""

    def __init__(self, vectors: np.ndarray, ids: list):
        self.columns, self.ids = np.ascontiguousarray(vectors.T), ids
        self.high, self.low = vectors.max(axis=0), vectors.min(axis=0)
        self.places = [(np.flatnonzero(c < 0), np.flatnonzero(c > 0)) for c in self.columns]

    def competitive(self, query: np.ndarray, least: int | None) -> tuple[np.ndarray, np.ndarray]:
        """(places, scores) of all vectors that may score ``least`` or more, and perhaps some others."""
        bound = np.maximum(np.maximum(query * self.high, query * self.low), 0)
        order = np.argsort(bound, kind="stable")
        before = np.cumsum(bound[order])
        if least is not None and (before[-1] if len(before) else 0) < least:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        total = np.zeros(len(self.ids), np.int64)
        if least is None or least <= 0:  # a vector in no posting of the query's signs may compete too
            rest, at = np.empty(0, np.int64), np.arange(len(self.ids))
            essential = order[::-1]
        else:
            parted = int(np.searchsorted(before, least))  # these terms together stay below
            rest, essential = order[:parted][::-1], order[parted:][::-1]
            at = None
        seen = np.zeros(len(self.ids), bool)
        for d in essential:
            if query[d]:
                places = self.places[d][int(query[d] > 0)]
                total[places] += query[d] * self.columns[d][places]
                seen[places] = True
        at = np.flatnonzero(seen) if at is None else at
        score = total[at]
        to_come = int(bound[rest].sum())

        def keep(at: np.ndarray, score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            if least is None:
                return at, score
            good = score + to_come >= least
            return (at, score) if good.all() else (at[good], score[good])

        at, score = keep(at, score)
        for d in essential:  # against the query's sign: only lower
            if query[d] and len(at):
                score = score + np.minimum(query[d] * self.columns[d][at], 0)
                at, score = keep(at, score)
        for d in rest:
            if len(at):
                score = score + query[d] * self.columns[d][at]
                to_come -= int(bound[d])
                at, score = keep(at, score)
        return at, score


def build(vectors: np.ndarray, labels: np.ndarray, ids: list, chunk: int = CHUNK) -> list[Chunk]:
    return [Chunk(vectors[i:i + chunk], ids[i:i + chunk]) for i in range(0, len(vectors), chunk)]


def best(index: list[Chunk], own: int, query: np.ndarray, k: int) -> list[tuple[int, int]]:
    """The ``k`` best (score, id) of a shard but ``own``, best first, ties to the smaller id."""
    found: list[tuple[int, int]] = []  # (-score, id)
    for chunk in index:
        least = -found[k - 1][0] if len(found) >= k else None
        at, score = chunk.competitive(query, least)
        if len(at) > k + 1:  # one of the best k + 1 may be the query itself
            good = score >= np.partition(score, -(k + 1))[-(k + 1)]
            at, score = at[good], score[good]
        new = [(-s, int(i)) for a, s in zip(at.tolist(), score.tolist()) for i in chunk.ids[a] if i != own]
        found = sorted(found + new)[:k]
    return [(-s, i) for s, i in found]


def search(embeddings: DataFrame, asked: DataFrame, k: int = 10, scale: int = SCALE) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` highest inner products of every query (vec_id, embedding) but its own.

    Components are floor(``scale`` * x). Rows with a null id, and vectors that are null or hold null or non-finite
    components, take no part; zero vectors do. Vectors of another length than the query's are no candidates.
    Ties go to the smaller vec_id. Rows of equal id and vector are one candidate, and a repeated id asks once, with the
    smallest of its vectors. Scores must fit a long. Other columns are not read; an empty table gives an empty result.
    """
    nodes = cut(of_equal(integer_vectors(embeddings, scale), ["vector"], k + 1).withColumn("label", F.lit(0).cast("long")), "vectors")
    ask = queries(integer_vectors(asked, scale)).select(
        "vec_id", F.lit(0).cast("long").alias("label"), "vector", F.lit(None).cast("array<long>").alias("windows"))

    def answer(index: list[Chunk], vec_id: int, label: int, vector: np.ndarray, windows) -> Iterator[tuple]:
        return ((vec_id, i, s) for s, i in best(index, vec_id, vector, k))

    found = meet(nodes, ask, shard_count(nodes), build, answer, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
