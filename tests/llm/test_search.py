import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sellerscope.llm import maxscore, rtree, shards

SCHEMA = "vec_id long, embedding array<float>, label int"


def vectors(seed=5, n=900, size=12):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(6, size))
    rows = [(i, (centre[i % 6] + 0.6 * rng.normal(size=size)).astype(np.float32).tolist(), int(rng.integers(0, 8))) for i in range(n)]
    rows += [(1000 + i, rows[200][1], 3) for i in range(60)]  # copies, an anchor among them
    rows += [(2000 + 50 * i, rows[3][1], i % 2) for i in range(8)]
    rows += [(5000, [0.0] * size, 1), (5001, None, 1), (5002, [None] + [1.0] * (size - 1), 1), (5003, [math.nan] * size, 2),
             (5100, [math.inf] * size, 2), (None, rows[0][1], 1), (5200, [1.0, -2.0], 1), (5201, [0.5, 2.0], 1), (5202, [-0.5, 2.0], 2),
             (5203, [3.0, 0.1], None), (5300, [], 2), (5301, [], 1), (5400, (5 * centre[0]).astype(np.float32).tolist(), 2)]
    return [*rows, rows[100], rows[100], rows[101]]  # repeated rows


def frame(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for c in ("vector", "ids", "size", "shard", "asks", "rank", "windows", "v", "s"):
        df = df.withColumn(c, F.lit(1))
    return df


def usable(rows, scale):
    out = {(i, tuple(math.floor(scale * float(x)) for x in v), lab) for i, v, lab in rows
           if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    return sorted(out, key=str)


def dot(a, b):
    return sum(x * y for x, y in zip(a, b))


@pytest.mark.parametrize("components", [4_000_000, 2000])
def test_maxscore(spark, components, monkeypatch):
    monkeypatch.setattr(shards.shard_count, "__defaults__", (components,))
    rows = vectors()
    have = usable([(i, v, 0) for i, v, _ in rows], 1024)
    want = set()
    for q, v, _ in have:
        if q % 100 == 0:
            near = sorted((-dot(v, w), i) for i, w, _ in have if i != q and len(w) == len(v))
            want |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(near[:10])}
    df = frame(spark, rows)
    got = [tuple(r) for r in maxscore.search(df, df.where("vec_id % 100 = 0")).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_maxscore_leaves_vectors_out():
    """Essential postings and probes, with a threshold that is competitive from the first chunk on."""
    rng = np.random.default_rng(3)
    base = rng.normal(size=(4000, 16)) * (rng.random((4000, 16)) < 0.3)
    rows = np.floor(200 * base).astype(np.int64)
    chunk = maxscore.Chunk(rows, [[i] for i in range(len(rows))])
    for q in rows[:20]:
        exact = rows @ q
        least = int(np.sort(exact)[-10])
        at, score = chunk.competitive(q, least)
        assert len(at) < 200 and set(np.flatnonzero(exact >= least)) <= set(at.tolist())
        assert (exact[at] == score).all()


def brute_negatives(rows):
    have = usable([(i, v, lab) for i, v, lab in rows if lab is not None], 256)
    out = set()
    for a, v, lab in have:
        if a % 100:
            continue
        near = sorted((-dot(v, w), i) for i, w, other in have if other == lab and i != a and len(w) == len(v))[:5]
        for s, p in near:
            hard = sorted((-dot(v, w), i) for i, w, other in have if other != lab and i != a and len(w) == len(v))
            hard = [(x, i) for x, i in hard if 80 * -s <= 100 * -x <= 100 * -s][:5]
            out |= {(a, p, r + 1, i, -s, -x) for r, (x, i) in enumerate(hard)}
    return out


@pytest.mark.parametrize("components", [4_000_000, 3000])
def test_hard_negatives(spark, components, monkeypatch):
    monkeypatch.setattr(shards.shard_count, "__defaults__", (components,))
    rows = vectors(seed=8)
    df = frame(spark, rows)
    got = [tuple(r) for r in rtree.mine(df, df.where("vec_id % 100 = 0")).collect()]
    assert len(got) == len(set(got)) and set(got) == brute_negatives(rows)


def test_tree_prunes_and_packs():
    rng = np.random.default_rng(1)
    centre = rng.normal(size=(10, 8)) * 40
    labels = rng.integers(0, 10, 3000)
    points = np.floor(centre[labels] + rng.normal(size=(3000, 8))).astype(np.int64)
    tree = rtree.Tree(points, labels, [[i] for i in range(3000)])
    assert sorted(np.concatenate(tree.leaves).tolist()) == list(range(3000)) and max(map(len, tree.leaves)) <= rtree.LEAF
    seen = []
    leaves = tree.leaves
    class Counted(list):
        def __getitem__(self, i):
            seen.append(i)
            return list.__getitem__(self, i)
    tree.leaves = Counted(leaves)
    q, lab = points[0], int(labels[0])
    got = tree.search(q, lab, True, 0, 5, [(None, None)])[0]
    assert got == sorted((-int(points[i] @ q), i) for i in range(1, 3000) if labels[i] == lab)[:5]
    assert len(seen) < len(leaves) / 3


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert maxscore.search(df, df).count() == 0 and rtree.mine(df, df).count() == 0
    lone = spark.createDataFrame([(100, [1.0, 2.0], 1)], SCHEMA)
    assert maxscore.search(lone, lone).count() == 0 and rtree.mine(lone, lone).count() == 0
