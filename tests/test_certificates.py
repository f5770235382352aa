"""Failing rows, segment tables in one pass, saved forests, gradients, curves and model versions."""

import math

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from sellerscope.operators import evaluation as EV
from sellerscope.operators import forest, quality, ranking, segments
from sellerscope.plans import training as TR


@pytest.fixture(scope="module")
def train(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 3)) * [1, 30, 0.1]
    y = (x[:, 0] + x[:, 1] / 30 + rng.normal(size=400) > 0).astype(float)
    df = spark.createDataFrame([(i, float(a), *map(float, r), float(0.5 + a)) for i, (a, r) in enumerate(zip(y, x))],
                               "seller_id long, label double, a double, b double, c double, weight double")
    return VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df).cache()


def test_gradient_vanishes_at_the_optimum_only(train):
    total = train.agg(F.sum("weight")).first()[0]
    fit = LogisticRegression(regParam=1 / total, standardization=False, weightCol="weight", maxIter=1000, tol=1e-10).fit(train)
    beta = fit.coefficients.toArray().tolist()

    def worst(b):
        return max(abs(r.gradient) / r.scale for r in TR.logreg_gradient(train, b, fit.intercept).collect())

    assert worst(beta) < 1e-4 < 1e-3 < worst([1.05 * v for v in beta])


def test_forest_tables(spark, train, tmp_path):
    rows = train.select("seller_id", vector_to_array("features").alias("x"))
    for boosted, est in ((False, RandomForestClassifier(numTrees=7, maxDepth=4, seed=3, weightCol="weight")), (True, GBTClassifier(maxIter=5, maxDepth=3, seed=3))):
        model = est.fit(train)
        model.save(str(tmp_path / str(boosted)))
        nodes = forest.read_forest(spark, str(tmp_path / str(boosted)))
        trees, depth = (5, 3) if boosted else (7, 4)
        assert nodes.select("tree").distinct().count() == trees
        assert forest.node_depths(nodes, depth).count() == nodes.count() > forest.node_depths(nodes, 1).count()
        got = {r.seller_id: r.score for r in forest.tree_scores(rows, "seller_id", "x", nodes, trees, depth, boosted).collect()}
        want = {r.seller_id: r.p for r in model.transform(train).select("seller_id", vector_to_array("probability")[1].alias("p")).collect()}
        assert got.keys() == want.keys() and all(math.isclose(got[k], want[k], abs_tol=1e-9) for k in want)


def test_curve_certificate(spark):
    rng = np.random.default_rng(4)
    rows = [(float(rng.integers(0, 2)), float(np.round(rng.random(), 2))) for _ in range(500)]
    df = spark.createDataFrame(rows, "label double, p double")
    curve = EV.roc_curve(df, "label", "p").cache()
    for buckets in (3, 1000):
        got = EV.curve_certificate(curve, "fpr", "tpr", buckets).first()
        assert got.points == curve.count() and got.monotone
        assert math.isclose(got.area, EV.roc_auc(df, "label", "p").first()[0], abs_tol=1e-12)
    bent = curve.withColumn("tpr", F.when(F.col("threshold") == 0.5, 0.0).otherwise(F.col("tpr")))
    assert not EV.curve_certificate(bent, "fpr", "tpr").first().monotone


def test_failing_rows(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, "b", -1), (2, None, 99), (None, "q", 3)], "k int, c string, n int")
    rules = [quality.Rule("unique", "k"), quality.Rule("not_null", "k"), quality.Rule("isin", "c", ("a", "b")), quality.Rule("ge", "n", 0),
             quality.Rule("le", "n", 9), quality.Rule("le", "absent", 1), quality.Rule("dtype", "n", "int")]
    got = sorted((r.rule, str(r.key), str(r.value)) for r in quality.failing_rows(df, rules, "k").collect())
    assert got == sorted([("k:unique", "1", "1"), ("k:unique", "1", "1"), ("k:not_null", "None", "None"),
                          ("c:isin(('a', 'b'))", "None", "q"), ("n:ge(0)", "1", "-1"), ("n:le(9)", "2", "99")])


def test_segment_tables_is_one_pass(spark):
    df = spark.createDataFrame([("s1", 1, 1, 0, 5.0, "x", "u"), ("s2", 0, 0, 1, 7.5, None, "u"), ("s3", 1, 0, 1, None, "x", "v")],
                               "seller_id string, churned int, never_activated int, active int, total_gmv double, a string, b string")
    both = segments.segment_tables(df, ["a", "b", "absent"])
    for c in ("a", "b"):
        assert sorted(map(str, both.filter(F.col("segment_column") == c).drop("segment_column").collect())) == \
            sorted(map(str, segments.segment_analysis(df, c).collect()))
    plan = both._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") == 1 and "Expand" in plan


def test_model_versions(spark, train, tmp_path):
    root = str(tmp_path / "registry")
    assert TR.model_versions(spark, root).count() == 0
    with pytest.raises(ValueError, match="no published model m"):
        TR.load_version(spark, root, "m")
    models = [PipelineModel(stages=[LogisticRegression(maxIter=n).fit(train)]) for n in (1, 2, 3)]
    assert [TR.publish_model(m, root, "m") for m in models[:2]] == [1, 2]
    assert TR.publish_model(models[2], root, "other") == 1
    models[2].write().save(f"{root}/models/m-half")  # never published
    (tmp_path / "registry" / "manifest" / "name=m" / "version=3" / "_temporary").mkdir(parents=True)  # publishing stopped half-way
    at = lambda name, v=None: TR.load_version(spark, root, name, v).stages[0].intercept
    assert at("m") == at("m", 2) == models[1].stages[0].intercept != at("m", 1) == models[0].stages[0].intercept
    assert at("other") == models[2].stages[0].intercept
    with pytest.raises(ValueError, match="version 3"):
        TR.load_version(spark, root, "m", 3)


def test_quantile_by_brackets(spark):
    """Beyond ``most`` rows only the bracket's values are ranked; ties and both ends included."""
    rng = np.random.default_rng(5)
    for values in (rng.normal(size=3000), np.repeat([1.0, 2.0, 3.0], 1000), np.r_[np.zeros(2000), rng.random(500)]):
        df = spark.createDataFrame([(float(v),) for v in rng.permutation(values)] + [(None,)], "v double").repartition(4).cache()
        for p in (0.0, 0.37, 0.5, 0.95, 1.0):
            assert ranking.exact_quantile(df, "v", p, most=50).first()[0] == np.quantile(values, p)


def test_many_buckets_and_large_integers(spark, monkeypatch):
    monkeypatch.setattr(ranking, "TARGET_ROWS_PER_BUCKET", 1)
    df = spark.range(20_000).select((F.col("id") * 3).alias("v"))
    got = ranking.prefix_sums(df, "v", {"n": F.lit(1).cast("long")})
    assert ranking.scaled_buckets(20_000) == 20_000
    assert got.filter(F.col("n_before") != F.col("v") / 3).count() == 0 and got.count() == 20_000
    monkeypatch.undo()
    big = 2 ** 60
    df = spark.createDataFrame([(big + i,) for i in (3, 1, 2, 0)], "v long")  # equal as doubles
    for descending in (False, True):
        t = ranking.prefix_sums(df, "v", {"n": F.lit(1).cast("long")}, descending=descending)
        assert sorted((r.v - big, r.n_before) for r in t.collect()) == [(i, 3 - i if descending else i) for i in range(4)]


def test_forest_rows_stay_where_they_are(spark):
    """Scoring shuffles one row a key, not one a key, tree and level, whatever the number of levels."""
    nodes = spark.createDataFrame([(0, 0, 0, 1.5, 1, 2, 0.0, None, 4, 1.0), (0, 1, None, None, None, None, 0.0, 0.25, 2, 1.0),
                                   (0, 2, None, None, None, None, 1.0, 0.75, 2, 1.0), (1, 0, None, None, None, None, 1.0, 0.5, 4, 1.0)],
                                  "tree int, node int, feature int, threshold double, left int, right int, prediction double, "
                                  "share double, support long, weight double")
    rows = spark.createDataFrame([(1, [1.5]), (2, [2.0]), (3, [float("nan")]), (None, [0.0])], "seller_id long, x array<double>")
    got = forest.tree_scores(rows, "seller_id", "x", nodes, 2, 6)
    assert {r.seller_id: r.score for r in got.collect()} == {1: 0.375, 2: 0.625, 3: 0.625, None: 0.375}
    plan = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert "Join" not in plan and plan.count("Exchange") == 1


def test_fit_partitions_grow_with_the_rows():
    assert [TR.fit_partitions(n) for n in (0, 200_000, 600_000, 1_200_000, 7_200_000, 14_400_000)] == [4, 4, 12, 24, 24, 48]


def test_forest_keeps_the_nodes_of_its_rows(train):
    """The forest's rows are not taken down from the root at every level, and its trees are the same."""
    est = TR.make_estimator("RandomForest", 400).setNumTrees(5)
    assert est.getCacheNodeIds()
    assert est.fit(train).toDebugString.split("\n", 1)[1] == est.setCacheNodeIds(False).fit(train).toDebugString.split("\n", 1)[1]
