"""Scalable rank / quantile / split / curve primitives against brute force."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sellerscope.operators import evaluation as EV
from sellerscope.operators import ranking
from sellerscope.operators.scalars import attach_scalars


@pytest.fixture(scope="module")
def values(spark):
    rng = np.random.default_rng(7)
    v = np.round(rng.gamma(2.0, 100.0, 3000), 0)  # many ties
    v[:900] = 42.0                                 # a hot value (~a third of rows)
    pdf = pd.DataFrame({"k": np.arange(3000), "v": v, "y": (rng.random(3000) < 0.3).astype(int),
                        "g": rng.integers(0, 3, 3000)})
    return pdf, spark.createDataFrame(pdf).repartition(7)


@pytest.mark.parametrize("buckets", [1, 4, 64])
def test_average_rank_matches_pandas(values, buckets):
    pdf, df = values
    got = ranking.average_rank_pct(df, "v", "r", buckets=buckets).select("k", "r").toPandas().set_index("k")["r"]
    exp = pdf.set_index("k")["v"].rank(pct=True)
    assert np.allclose(got.sort_index().values, exp.sort_index().values, rtol=0, atol=1e-12)


def test_partitioned_rank(values):
    pdf, df = values
    got = ranking.average_rank_pct(df, "v", "r", partition_cols=["g"]).select("k", "r").toPandas().set_index("k")["r"]
    exp = pdf.set_index("k").groupby("g")["v"].rank(pct=True)
    assert np.allclose(got.sort_index().values, exp.sort_index().values, atol=1e-12)


@pytest.mark.parametrize("p", [0.0, 0.25, 0.5, 0.75, 0.8, 0.95, 1.0])
def test_exact_quantile_matches_numpy(values, p):
    pdf, df = values
    got = ranking.exact_quantile(df, "v", p).first()[0]
    assert got == pytest.approx(np.percentile(pdf["v"], p * 100), abs=1e-9)


def test_bracketed_quantile_filters_its_rows(values):
    """Beyond ``most`` rows the quantile has a bracket; its row is still a scalar that a filter can hold."""
    pdf, df = values
    q = ranking.exact_quantile(df, "v", 0.8, "threshold", most=50)
    got = attach_scalars(df, q).filter(F.col("v") >= F.col("threshold")).groupBy("threshold").agg(F.count("*").alias("n")).first()
    threshold = np.percentile(pdf["v"], 80)
    assert got.threshold == threshold and got.n == (pdf["v"] >= threshold).sum()


def test_stratified_split_exact_fractions(values):
    pdf, df = values
    out = ranking.stratified_split(df, "y", "k", 0.25, 42).toPandas()
    for y, grp in out.groupby("y"):
        assert grp["is_test"].sum() == int(np.ceil(0.25 * len(grp)))
    again = ranking.stratified_split(df, "y", "k", 0.25, 42).toPandas()
    assert out.sort_values("k")["is_test"].tolist() == again.sort_values("k")["is_test"].tolist()


def test_folds_balanced(values):
    _, df = values
    out = ranking.stratified_folds(df, "y", "k", 5, 42).toPandas()
    counts = out.groupby(["y", "fold"]).size().unstack()
    assert (counts.max(axis=1) - counts.min(axis=1)).max() <= 1


def _auc_brute(y, s):
    pos, neg = s[y == 1], s[y == 0]
    cmp = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    return cmp / (len(pos) * len(neg))


def test_roc_auc_and_curves(values):
    pdf, df = values
    got = EV.roc_auc(df, "y", "v").first()[0]
    assert got == pytest.approx(_auc_brute(pdf["y"].values, pdf["v"].values), abs=1e-12)
    roc = EV.roc_curve(df, "y", "v").toPandas()
    assert roc["fpr"].iloc[0] == 0 and roc["tpr"].iloc[0] == 0
    assert roc["fpr"].iloc[-1] == 1 and roc["tpr"].iloc[-1] == 1
    # trapezoid area of the full curve equals the rank AUC
    assert np.trapezoid(roc["tpr"], roc["fpr"]) == pytest.approx(got, abs=1e-12)
    pr = EV.pr_curve(df, "y", "v").toPandas()
    assert pr["recall"].iloc[-1] == 1.0


def test_histogram_matches_numpy(values):
    pdf, df = values
    got = ranking.histogram(df, "v", 30).toPandas()
    counts, edges = np.histogram(pdf["v"], bins=30)
    assert got["count"].tolist() == counts.tolist()
    assert np.allclose(got["bin_lower"], edges[:-1])


def test_binary_metrics_zero_division(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "y int, prediction int")
    r = EV.binary_metrics(df, "y").first()
    assert (r.accuracy, r.precision, r.recall, r.f1_score) == (1.0, 0.0, 0.0, 0.0)


def test_classification_report_shape(values):
    pdf, df = values
    rep = EV.classification_report(EV.with_prediction(df.withColumn("s", F.col("v") / 1000.0), "s"), "y")
    names = [r.class_label for r in rep.collect()]
    assert names == ["0", "1", "accuracy", "macro avg", "weighted avg"]


def test_many_buckets_match_pandas(values, monkeypatch):
    # force the large-data path: ~10 rows per bucket, Bucketizer with hundreds of edges
    pdf, df = values
    monkeypatch.setattr(ranking, "TARGET_ROWS_PER_BUCKET", 3)
    got = ranking.average_rank_pct(df, "v", "r").select("k", "r").toPandas().set_index("k")["r"]
    exp = pdf.set_index("k")["v"].rank(pct=True)
    assert np.allclose(got.sort_index().values, exp.sort_index().values, atol=1e-12)
    q = ranking.exact_quantile(df, "v", 0.37).first()[0]
    assert q == pytest.approx(np.percentile(pdf["v"], 37), abs=1e-9)
    split = ranking.stratified_split(df, "y", "k", 0.25, 42).toPandas()
    base = ranking.stratified_split(df, "y", "k", 0.25, 42, buckets=1).toPandas()
    assert split.sort_values("k")["is_test"].tolist() == base.sort_values("k")["is_test"].tolist()
