"""Candidates are fitted side by side, once a session, and only those that a query reads."""
import threading
from types import SimpleNamespace

import pytest
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier

from sellerscope.config import DEFAULT_PARAMS
from sellerscope.plans import queries_ml as Q
from sellerscope.plans import training as TR


@pytest.fixture
def sellers(spark):
    rows = [(i, int(i * 7 % 10 < 4), "ab"[i % 2], "xyz"[i % 3], "t", "b", "o", "pqrs"[i % 4], float(i % 11), float(i % 5), i * 3 % 40) for i in range(160)]
    return spark.createDataFrame(rows, "seller_id long, never_activated int, lead_behaviour_profile string, business_segment string, "
                                       "lead_type string, business_type string, origin string, seller_state string, "
                                       "declared_monthly_revenue double, declared_product_catalog_size double, sales_cycle_days long")


def small(name):
    cols = {"featuresCol": "features", "labelCol": "label"}
    return {"LogisticRegression": LogisticRegression(**cols, weightCol="weight"), "RandomForest": RandomForestClassifier(**cols, numTrees=4, seed=1),
            "GradientBoosting": GBTClassifier(**cols, maxIter=2, seed=1)}[name]


def test_candidates_meet_in_their_fits(sellers, monkeypatch):
    barrier, main, met = threading.Barrier(3), threading.get_ident(), []

    def make(name, n_train, params):
        if threading.get_ident() != main:
            barrier.wait(60)
            met.append(name)
        return small(name)

    monkeypatch.setattr(TR, "make_estimator", make)
    res = TR.pre_activation(sellers)
    assert list(res.fitted) == list(TR.ALGORITHMS) and sorted(met) == sorted(TR.ALGORITHMS)
    one = TR.pre_activation(sellers, algorithms=("GradientBoosting",), earlier=res)
    assert one.fitted["GradientBoosting"] is res.fitted["GradientBoosting"]
    assert one.metrics[0]["roc_auc"] == res.metrics[2]["roc_auc"] and one.best == "GradientBoosting"


def test_importance_reads_one_fit(spark, sellers, monkeypatch):
    fitted, fit = [], RandomForestClassifier.fit
    for kind in (LogisticRegression, RandomForestClassifier, GBTClassifier):
        monkeypatch.setattr(kind, "fit", lambda self, df, kind=kind: [fitted.append(kind.__name__), fit(self, df)][1])
    monkeypatch.setattr(TR, "make_estimator", lambda name, n_train, params: small(name))
    inp = SimpleNamespace(spark=spark, sf_dir="rows of test_fits_at_once", params=DEFAULT_PARAMS, labelled=sellers)
    got = {r.feature: r.importance for r in Q.q_feature_importance(inp).collect()}
    assert fitted == ["RandomForestClassifier"] and sum(got.values()) == pytest.approx(1)
    whole = Q._stage(inp, "pre_activation")
    assert sorted(fitted) == ["GBTClassifier", "LogisticRegression", "RandomForestClassifier"]  # the forest is not fitted again
    assert list(whole.fitted) == list(TR.ALGORITHMS) and dict(whole.importance["RandomForest"]) == got
