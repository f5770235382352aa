"""Segments, chi-square, contracts, model selection guards."""

import math

import pytest
from pyspark.sql import functions as F

from sellerscope import config as C
from sellerscope.operators import quality, segments
from sellerscope.plans import features as FE
from sellerscope.plans import training as TR


def test_segment_analysis_sums_and_share(spark):
    rows = [("a", 1, 1, 0, 0, 10.0), ("a", 2, 0, 0, 1, 30.0), ("b", 3, 1, 1, 0, 0.0), (None, 4, 1, 1, 0, 0.0)]
    df = spark.createDataFrame(rows, "seg string, seller_id long, churned int, never_activated int, active int, "
                                     "total_gmv double")
    t = segments.segment_analysis(df, "seg").toPandas()
    assert t["Total_Sellers"].sum() == 4
    assert set(t["Segment"]) == {"a", "b", "Unknown"}
    assert abs(t["Market_Share_%"].sum() - 100.0) < 0.2
    a = t[t.Segment == "a"].iloc[0]
    assert a["Avg_GMV"] == 20.0 and a["Churn_Rate_%"] == 50.0
    assert segments.segment_analysis(df, "missing") is None


def test_chi_square_against_formula(spark):
    table = spark.createDataFrame([("x", 10, 20), ("y", 30, 15), ("z", 5, 25)], "segment string, churned_0 long, "
                                                                               "churned_1 long")
    r = segments.chi_square_test(table).first()
    obs = [[10, 20], [30, 15], [5, 25]]
    n = sum(map(sum, obs))
    rows = [sum(o) for o in obs]
    cols = [sum(o[j] for o in obs) for j in range(2)]
    chi2 = sum((obs[i][j] - rows[i] * cols[j] / n) ** 2 / (rows[i] * cols[j] / n) for i in range(3) for j in range(2))
    # terms are summed as decimal(38,9): exact to ~1e-9 absolute, order-independent
    assert r.dof == 2 and r.chi2 == pytest.approx(chi2, abs=1e-8)
    assert r.p_value == pytest.approx(math.exp(-r.chi2 / 2), rel=1e-9)  # dof 2: sf = exp(-x/2)


def test_chi_square_yates_on_2x2(spark):
    table = spark.createDataFrame([("x", 10, 20), ("y", 30, 15)], "segment string, churned_0 long, churned_1 long")
    r = segments.chi_square_test(table).first()
    obs = [[10, 20], [30, 15]]
    n, rows, cols = 75, [30, 45], [40, 35]
    chi2 = sum((abs(obs[i][j] - rows[i] * cols[j] / n) - 0.5) ** 2 / (rows[i] * cols[j] / n)
               for i in range(2) for j in range(2))
    assert r.dof == 1 and r.chi2 == pytest.approx(chi2, abs=1e-8)
    assert r.p_value == pytest.approx(math.erfc(math.sqrt(r.chi2 / 2)), rel=1e-9)


def test_contract_counts(spark):
    df = spark.createDataFrame([(1, 0, 5.0), (1, 2, -1.0), (None, 1, 3.0)], "seller_id long, churned int, "
                                                                           "total_gmv double")
    rules = [quality.Rule("not_null", "seller_id"), quality.Rule("unique", "seller_id"),
             quality.Rule("isin", "churned", (0, 1)), quality.Rule("ge", "total_gmv", 0),
             quality.Rule("ge", "total_orders", 0)]
    got = [r.violations for r in quality.run_contract(df, rules).collect()]
    assert got == [1, 2, 1, 1, 1]


def test_select_best_first_wins_ties():
    m = [{"algorithm": "a", "roc_auc": 0.65}, {"algorithm": "b", "roc_auc": 0.82}, {"algorithm": "c", "roc_auc": 0.74}]
    assert TR.select_best_name(m) == "b"
    m2 = [{"algorithm": "a", "roc_auc": 0.8}, {"algorithm": "b", "roc_auc": 0.8}]
    assert TR.select_best_name(m2) == "a"


def test_single_class_guard(spark):
    rows = [(i, 0, "x", "y", "z", "w", "o", "s", 1.0, 1.0, 1) for i in range(20)]
    df = spark.createDataFrame(rows, "seller_id long, never_activated int, lead_behaviour_profile string, "
                                     "business_segment string, lead_type string, business_type string, "
                                     "origin string, seller_state string, declared_monthly_revenue double, "
                                     "declared_product_catalog_size double, sales_cycle_days long")
    res = TR.pre_activation(df)
    assert res.model is None and res.skipped == "single class"
    assert res.feature_cols == list(C.PRE_ACTIVATION_FEATURES)


def test_class_weights_balanced(spark):
    df = spark.createDataFrame([(i, 1 if i < 3 else 0) for i in range(12)], "k long, y int")
    w = {r.y: r.weight for r in TR.class_weights(df, "y").select("y", "weight").distinct().collect()}
    assert w[1] == pytest.approx(12 / (2 * 3)) and w[0] == pytest.approx(12 / (2 * 9))


def test_encoder_alphabetical_and_unseen(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",)], "lead_behaviour_profile string")
    for c in FE.CATEGORICALS[1:]:
        df = df.withColumn(c, F.lit("u"))
    for c in FE.PRE_NUMERIC:
        df = df.withColumn(c, F.lit(None).cast("double"))
    model = FE.pre_activation_pipeline().fit(df)
    out = {r.lead_behaviour_profile: r.lead_behaviour_profile_encoded for r in model.transform(df).collect()}
    assert out == {"a": 0.0, "b": 1.0, "c": 2.0}
    new = df.limit(1).withColumn("lead_behaviour_profile", F.lit("zzz"))
    assert model.transform(new).first().lead_behaviour_profile_encoded == 3.0  # unseen -> extra index
