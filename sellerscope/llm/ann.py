"""Approximate nearest neighbours: a hierarchical navigable small-world graph per shard.

Equal vectors are one node with its smallest ids, so copies neither tangle a graph nor grow
it. Nodes go to shards by a hash, a bounded number to each; a task builds one shard's
graph and stores it as flat arrays: the vectors, and per level a row of neighbour places for
every node. Blocks of queries are then searched in every shard's graph, and the shards'
nearest are merged. Distances are Euclidean, in double precision on the original numbers.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sellerscope.llm.common import cut

#: nodes of a shard, links of a node (twice as many on the ground), widths of the searches
SHARD, LINKS, BUILD_WIDTH, WIDTH = 2048, 12, 64, 128
#: queries that one task searches in one shard
BLOCK = 512


class Graph:
    """Flat neighbour arrays: ``links[level][node]`` lists places, -1 where there is none."""

    def __init__(self, vectors: np.ndarray, links: list[np.ndarray], entry: int):
        self.vectors, self.links, self.entry = vectors, links, entry

    def search(self, query: np.ndarray, starts: list[int], width: int, level: int) -> list[tuple[float, int]]:
        """The ``width`` nearest found from ``starts``, as sorted (squared distance, place)."""
        seen = np.zeros(len(self.vectors), bool)
        seen[starts] = True
        d = ((self.vectors[starts] - query) ** 2).sum(axis=1)
        todo = sorted(zip(d.tolist(), starts))
        best = [(-a, b) for a, b in todo[:width]]
        heapq.heapify(best)
        while todo:
            near, at = heapq.heappop(todo)
            if len(best) == width and near > -best[0][0]:
                break
            around = self.links[level][at]
            around = around[around >= 0]
            around = around[~seen[around]]
            if not len(around):
                continue
            seen[around] = True
            d = ((self.vectors[around] - query) ** 2).sum(axis=1)
            for a, b in zip(d.tolist(), around.tolist()):
                if len(best) < width:
                    heapq.heappush(best, (-a, b))
                    heapq.heappush(todo, (a, b))
                elif a < -best[0][0]:
                    heapq.heapreplace(best, (-a, b))
                    heapq.heappush(todo, (a, b))
        return sorted((-a, b) for a, b in best)

    def nearest(self, query: np.ndarray, width: int) -> list[tuple[float, int]]:
        start = [self.entry]
        for level in range(len(self.links) - 1, 0, -1):
            start = [self.search(query, start, 1, level)[0][1]]
        return self.search(query, start, width, 0)


def _diverse(vectors: np.ndarray, near: list[tuple[float, int]], most: int) -> list[int]:
    """Of the nearest, those closer to the node than to any one already chosen; then the nearest others."""
    chosen: list[int] = []
    for d, c in near:
        if len(chosen) == most:
            break
        if not chosen or d <= ((vectors[chosen] - vectors[c]) ** 2).sum(axis=1).min():
            chosen.append(c)
    return (chosen + [c for _, c in near if c not in chosen])[:most]


def build(vectors: np.ndarray, links: int = LINKS, width: int = BUILD_WIDTH, seed: int = 3) -> Graph:
    n = len(vectors)
    height = np.minimum((-np.log(np.random.default_rng(seed).random(n)) / np.log(links)).astype(int), 6)
    g = Graph(vectors, [np.full((n, links * (2 if level == 0 else 1)), -1, np.int32) for level in range(height.max() + 1)], 0)
    top = height[0]
    for i in range(1, n):
        start = [g.entry]
        for level in range(top, height[i], -1):
            start = [g.search(vectors[i], start, 1, level)[0][1]]
        for level in range(min(top, height[i]), -1, -1):
            near = g.search(vectors[i], start, width, level)
            start = [b for _, b in near]
            rows, most = g.links[level], g.links[level].shape[1]
            for c in _diverse(vectors, near, links):
                rows[i, np.argmax(rows[i] < 0)] = c
                free = np.flatnonzero(rows[c] < 0)
                if len(free):
                    rows[c, free[0]] = i
                else:
                    of = np.append(rows[c], i)
                    d = ((vectors[of] - vectors[c]) ** 2).sum(axis=1)
                    rows[c] = _diverse(vectors, sorted(zip(d.tolist(), of.tolist())), most)
        if height[i] > top:
            g.entry, top = i, height[i]
    return g


def _built(pdf: pd.DataFrame) -> pd.DataFrame:
    vectors = np.array(pdf["vector"].tolist(), np.float64)
    g = build(vectors)
    return pd.DataFrame([(pdf["size"].iloc[0], pdf["shard"].iloc[0], vectors.ravel(), [x.ravel() for x in g.links], g.entry,
                          pdf["ids"].tolist())], columns=["size", "shard", "vectors", "links", "entry", "ids"])


def valid(embeddings: DataFrame) -> DataFrame:
    """vec_id, vector (double): rows whose vector is not null, empty or zero and holds finite numbers only."""
    v = F.transform("embedding", lambda x: x.cast("double"))
    ok = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (embeddings.where("vec_id is not null").select("vec_id", v.alias("vector")).where(F.col("vector").isNotNull())
            .where(ok & F.exists("vector", lambda x: x != 0)))


def index(embeddings: DataFrame, k: int, shard: int = SHARD) -> DataFrame:
    """One row per shard: size, shard, vectors, links by level, entry, and each node's smallest k + 1 ids."""
    rows = valid(embeddings).select("vec_id", F.transform("vector", lambda x: x + 0.0).alias("vector"))  # -0.0 is 0.0
    # a query needs at most k + 1 of equal vectors; the limit is applied before the shuffle too
    order = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    nodes = rows.withColumn("n", order).where(F.col("n") <= k + 1).groupBy("vector").agg(
        F.sort_array(F.collect_list("vec_id")).alias("ids"))
    nodes = cut(nodes.withColumn("size", F.size("vector")), "nodes")
    counts = {r["size"]: r["n"] for r in nodes.groupBy("size").agg(F.count("*").alias("n")).collect()}
    shards = F.lit(1).cast("long")
    for size, n in counts.items():  # one or a few lengths of vector
        shards = F.when(F.col("size") == size, F.lit(-(-n // shard)).cast("long")).otherwise(shards)
    kind = embeddings.schema["vec_id"].dataType.simpleString()
    return cut(nodes.withColumn("shard", F.pmod(F.xxhash64("vector"), shards)).groupBy("size", "shard").applyInPandas(
        _built, f"size int, shard long, vectors array<double>, links array<array<int>>, entry int, ids array<array<{kind}>>"), "graphs")


def search(embeddings: DataFrame, queries: DataFrame, k: int = 10, width: int = WIDTH, shard: int = SHARD) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found of every query (vec_id, embedding) but itself.

    Rows with a null id, and vectors that are null, empty, zero or not finite throughout, take
    no part; vectors of another length than the query's are no candidates. Ties go to the
    smaller vec_id; a repeated id is one candidate. An empty table gives an empty result.
    """
    graphs = index(embeddings, k, shard)
    asked = valid(queries).dropDuplicates(["vec_id"]).withColumn("size", F.size("vector"))
    block = F.pmod(F.xxhash64("vec_id"), F.lit(max(1, asked.count() // BLOCK)))
    asked = cut(asked.withColumn("block", block).groupBy("size", "block").agg(
        F.collect_list("vec_id").alias("q_ids"), F.flatten(F.collect_list("vector")).alias("q")), "queries")
    kind = embeddings.schema["vec_id"].dataType.simpleString()

    def found(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                size = row.size_
                g = Graph(np.asarray(row.vectors).reshape(-1, size),
                          [np.asarray(x).reshape(len(row.ids), -1) for x in row.links], row.entry)
                out = []
                for q, vector in zip(row.q_ids, np.asarray(row.q).reshape(-1, size)):
                    near = [(float(np.sqrt(d)), v) for d, at in g.nearest(vector, max(width, k + 1))[:k + 1] for v in row.ids[at]]
                    out += [(q, v, d) for d, v in sorted(x for x in set(near) if x[1] != q)[:k]]
                yield pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    # every block of queries meets every shard: rows are shards times blocks, spread over the tasks
    pairs = (graphs.withColumnRenamed("size", "size_").join(asked.withColumnRenamed("size", "q_size"), F.col("size_") == F.col("q_size"))
             .repartition("shard", "block"))
    near = pairs.mapInPandas(found, f"query_id {kind}, vec_id {kind}, score double").distinct()
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return near.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
