"""Saved tree ensembles as tables: one row per node, scored by taking rows down the nodes.

``read_forest`` reads what a saved forest or boosted model wrote; nothing here
calls the model, so its scores can be checked without trusting ``transform``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_forest(spark: SparkSession, path: str) -> DataFrame:
    """(tree, node, feature, threshold, left, right, prediction, share, support, weight) of a
    saved ensemble. ``share`` is class 1's part of a classification node, ``left``
    is NULL at a leaf, ``support`` counts the node's training rows, ``weight`` is the tree's."""
    weights = spark.read.parquet(f"{path}/treesMetadata").toDF("tree", "_metadata", "weight").drop("_metadata")
    n = F.col("nodeData")
    inner = n["leftChild"] >= 0
    stats = n["impurityStats"]
    nodes = spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), n["id"].alias("node"), F.when(inner, n["split"]["featureIndex"]).alias("feature"),
        F.when(inner, n["split"]["leftCategoriesOrThreshold"][0]).alias("threshold"),
        F.when(inner, n["leftChild"]).alias("left"), F.when(inner, n["rightChild"]).alias("right"),
        n["prediction"].alias("prediction"), F.try_divide(stats[1], stats[0] + stats[1]).alias("share"), n["rawCount"].alias("support"))
    return nodes.join(weights, "tree")


def node_depths(nodes: DataFrame, most: int) -> DataFrame:
    """``nodes`` with their depth (the root's is 0), by joining children to parents ``most`` times;
    a node that no path of that length reaches has no row."""
    level = nodes.filter(F.col("node") == 0).select("tree", "node", "left", "right", F.lit(0).alias("depth"))
    out = level
    below = nodes.select("tree", "node", "left", "right")
    for depth in range(1, most + 1):
        children = level.select("tree", F.explode(F.array("left", "right")).alias("node")).filter(F.col("node").isNotNull())
        level = children.join(below, ["tree", "node"]).withColumn("depth", F.lit(depth))
        out = out.unionByName(level)
    return nodes.join(out.select("tree", "node", "depth"), ["tree", "node"])


def tree_scores(rows: DataFrame, key: str, values: str, nodes: DataFrame, trees: int, depth: int, boosted: bool = False) -> DataFrame:
    """(key, score): P(class 1) of every row of ``rows`` (``values`` is its array of features).

    Each row starts at every root and goes ``depth`` times to the child of its node. The node table, at most
    trees * 2^(depth + 1) rows whatever the rows, is sent to the tasks, so no row is shuffled once per tree and level. A
    forest's score is the mean share of the leaves; a boosted model's the logistic of
    twice the weighted sum of their predictions."""
    worth = F.col("weight") * F.col("prediction") if boosted else F.col("share")
    table = nodes.filter(F.col("tree") < trees).select("tree", "node", "feature", "threshold", "left", "right", worth.alias("worth")).toPandas()
    place = {at: i for i, at in enumerate(zip(table["tree"], table["node"]))}
    feature = table["feature"].fillna(0).to_numpy(np.int32)
    threshold, worth = table["threshold"].to_numpy(float), table["worth"].to_numpy(float)
    # a leaf is its own child
    left, right = (np.array([i if pd.isna(c) else place[t, int(c)] for i, (t, c) in enumerate(zip(table["tree"], table[side]))], np.int32)
                   for side in ("left", "right"))
    roots = np.array([i for (_, node), i in place.items() if node == 0], np.int32)

    def down(batches):
        for batch in batches:
            for first in range(0, len(batch), 2000):
                some = batch.iloc[first:first + 2000]
                x, row = np.array(some["_x"].tolist(), float), np.arange(len(some))[:, None]
                at = np.tile(roots, (len(some), 1))
                for _ in range(depth):
                    at = np.where(x[row, feature[at]] <= threshold[at], left[at], right[at])
                found = worth[at]
                yield pd.DataFrame({key: some[key], "_sum": np.nansum(found, axis=1), "_n": (~np.isnan(found)).sum(axis=1)})

    kind = rows.schema[key].dataType.simpleString()
    sums = rows.select(key, F.col(values).alias("_x")).mapInPandas(down, f"{key} {kind}, _sum double, _n long")
    sums = sums.groupBy(key).agg(F.sum("_sum").alias("_sum"), F.sum("_n").alias("_n"))
    score = 1 / (1 + F.exp(-2 * F.col("_sum"))) if boosted else F.try_divide("_sum", "_n")
    return sums.select(key, score.alias("score"))
