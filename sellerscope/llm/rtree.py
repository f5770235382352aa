"""Hard negatives by best-first search in STR-packed R-trees.

A shard's vectors are packed by sort-tile-recursive: by label first, then in slabs along the coordinates that vary
most, into leaves of equal size; leaves, and the nodes above them, have minimum bounding boxes (and the interval
of their labels). A box gives an interval of the inner product with an anchor, coordinate by coordinate. A queue
takes boxes by the greatest product they can hold, and leaves out those whose interval misses the score windows, or
lies strictly below the k-th found.

One search over all shards finds each anchor's positives; their scores then give the windows of a second one.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sellerscope.llm.common import cut
from sellerscope.llm.shards import integer_vectors, meet, of_equal, queries, shard_count

SCALE, LEAF, FAN, TILED = 256, 64, 16, 6
#: a negative scores from EASY hundredths of the positive's score up to it
EASY = 80


def packed(vectors: np.ndarray, labels: np.ndarray, leaf: int = LEAF, tiled: int = TILED) -> list[np.ndarray]:
    """Places of the vectors of every leaf, in the order of the tiles."""
    dims = np.argsort(-vectors.astype(np.float64).var(axis=0), kind="stable")[:tiled] if len(vectors) else []

    def tiles(at: np.ndarray, dims: np.ndarray) -> Iterator[np.ndarray]:
        if len(at) <= leaf or not len(dims):
            for i in range(0, len(at), leaf):
                yield at[i:i + leaf]
            return
        leaves = -(-len(at) // leaf)
        slab = leaf * -(-leaves // int(np.ceil(leaves ** (1 / len(dims)))))
        at = at[np.argsort(vectors[at, dims[0]], kind="stable")]
        for i in range(0, len(at), slab):
            yield from tiles(at[i:i + slab], dims[1:])

    order = np.argsort(labels, kind="stable")
    ends = [0, *(np.flatnonzero(np.diff(labels[order])) + 1), len(order)]
    out, few = [], []
    for a, b in zip(ends[:-1], ends[1:]):
        if b - a >= leaf:
            out += tiles(order[a:b], dims)
        else:
            few.append(order[a:b])  # rare labels share leaves
    return out + (list(tiles(np.concatenate(few), dims)) if few else [])


class Tree:
    """Levels of boxes, from the leaves up: ``low`` and ``high`` by coordinate, ``first`` and ``last`` label."""

    def __init__(self, vectors: np.ndarray, labels: np.ndarray, ids: list, leaf: int = LEAF, fan: int = FAN):
        self.leaves, self.fan = packed(vectors, labels, leaf), fan
        self.vectors, self.labels, self.ids = vectors, labels, ids
        edges = [(vectors[x].min(axis=0), vectors[x].max(axis=0), labels[x].min(), labels[x].max()) for x in self.leaves]
        self.levels = [tuple(np.array(x) for x in zip(*edges))]
        while len(self.levels[-1][0]) > fan:
            low, high, first, last = self.levels[-1]
            cuts = np.arange(0, len(low), fan)
            self.levels.append((np.minimum.reduceat(low, cuts), np.maximum.reduceat(high, cuts),
                                np.minimum.reduceat(first, cuts), np.maximum.reduceat(last, cuts)))

    def search(self, query: np.ndarray, label: int, same: bool, own: int, k: int, windows: list[tuple[int | None, int | None]]) -> list[list[tuple[int, int]]]:
        """For every window (least, most) of scores, its ``k`` best (-score, id) of the anchor's label, or of all others."""
        plus, minus = np.maximum(query, 0), np.minimum(query, 0)
        found: list[list[tuple[int, int]]] = [[] for _ in windows]
        floor = [least for least, _ in windows]  # what a product must reach: the window's least, then the k-th score
        ceiling = None if any(most is None for _, most in windows) else max(most for _, most in windows)

        def lowest() -> int | None:
            return None if None in floor else min(floor)

        def push(level: int, a: int, b: int) -> None:
            low, high, first, last = (x[a:b] for x in self.levels[level])
            most = high @ plus + low @ minus
            good = (first <= label) & (label <= last) if same else (first != label) | (last != label)
            if (least := lowest()) is not None:
                good &= most >= least
            if ceiling is not None:
                good &= low @ plus + high @ minus <= ceiling
            for i in np.flatnonzero(good).tolist():
                heapq.heappush(todo, (-int(most[i]), level, a + i))

        todo: list[tuple[int, int, int]] = []
        push(len(self.levels) - 1, 0, len(self.levels[-1][0]))
        while todo:
            most, level, i = heapq.heappop(todo)
            if (least := lowest()) is not None and -most < least:
                break
            if level:
                push(level - 1, i * self.fan, min((i + 1) * self.fan, len(self.levels[level - 1][0])))
                continue
            at = self.leaves[i]
            at = at[self.labels[at] == label] if same else at[self.labels[at] != label]
            score = self.vectors[at] @ query
            good = np.ones(len(at), bool)
            if least is not None:
                good &= score >= least
            if ceiling is not None:
                good &= score <= ceiling
            if not good.any():
                continue
            near = sorted((-s, j) for s, a in zip(score[good].tolist(), at[good].tolist()) for j in self.ids[a] if j != own)
            for w, (_, top) in enumerate(windows):
                new = [x for x in near if (top is None or -x[0] <= top) and (floor[w] is None or -x[0] >= floor[w])][:k]
                if new:
                    found[w] = sorted(found[w] + new)[:k]
                    if len(found[w]) == k:
                        floor[w] = max(-found[w][-1][0], floor[w] if floor[w] is not None else -found[w][-1][0])
        return found


def mine(embeddings: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 5, scale: int = SCALE, easy: int = EASY) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``embeddings`` and ``anchors`` have vec_id, embedding and label. An anchor's positives are the rows of its
    label with the highest inner products of floor(``scale`` * x); a positive's negatives are those of other labels
    whose score lies between ``easy`` hundredths of the positive's and the positive's own, highest first. Ties go to the
    smaller vec_id, and no row with the anchor's id takes part. Rows with a null id or label, a null vector, or null or
    non-finite components take no part; vectors meet vectors of their own length. Rows of equal id, label and vector
    are one candidate; a repeated id is one anchor, with the smallest of its rows. Scores must fit a long. Other columns are
    not read; an empty table gives an empty result.
    """
    label = F.col("label").cast("long").alias("label")
    rows = integer_vectors(embeddings.where("label IS NOT NULL"), scale, label)
    most = max(positives + 1, negatives + 1)
    nodes = cut(of_equal(rows, ["label", "vector"], most), "boxed")
    asked = cut(queries(integer_vectors(anchors.where("label IS NOT NULL"), scale, label), "label"), "anchors")
    shards = shard_count(nodes)

    def nearest(tree: Tree, vec_id: int, label: int, vector: np.ndarray, windows) -> Iterator[tuple]:
        return ((vec_id, i, -s) for s, i in tree.search(vector, label, True, vec_id, positives, [(None, None)])[0])

    found = meet(nodes, asked.withColumn("windows", F.lit(None).cast("array<long>")), shards, Tree, nearest,
                 "anchor_id long, positive_id long, positive_score long")
    rank = F.row_number().over(Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id"))
    pairs = cut(found.withColumn("rank", rank).where(F.col("rank") <= positives).drop("rank"), "positives")

    # a positive below zero has an empty window; equal scores have one window
    windows = pairs.where("positive_score >= 0").groupBy(F.col("anchor_id").alias("a")).agg(
        F.sort_array(F.collect_set("positive_score")).alias("windows"))
    again = asked.join(windows, F.col("vec_id") == F.col("a")).select("vec_id", "label", "vector", "windows")

    def below(tree: Tree, vec_id: int, label: int, vector: np.ndarray, tops) -> Iterator[tuple]:
        windows = [(-(-easy * int(s) // 100), int(s)) for s in tops]
        for (_, top), of in zip(windows, tree.search(vector, label, False, vec_id, negatives, windows)):
            yield from ((vec_id, top, i, -s) for s, i in of)

    hard = meet(nodes, again, shards, Tree, below, "a long, s long, negative_id long, negative_score long")
    rank = F.row_number().over(Window.partitionBy("a", "s").orderBy(F.desc("negative_score"), "negative_id"))
    hard = hard.withColumn("rank", rank).where(F.col("rank") <= negatives)
    return pairs.join(hard, (F.col("anchor_id") == F.col("a")) & (F.col("positive_score") == F.col("s"))).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
