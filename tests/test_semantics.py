"""Hand-made cases (the reference's unit tests) and semantic traps."""

from datetime import datetime

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from sellerscope import config as C
from sellerscope import functions as X
from sellerscope.operators import cohorts, labels, risk


def test_churn_labels_hand_made(spark):
    # five sellers A-E: orders, days to first sale, days since last sale
    rows = [("A", 0, 100, None), ("B", 5, 5, 90), ("C", 10, None, 30), ("D", 3, 45, 70), ("E", 0, 80, None)]
    df = spark.createDataFrame(rows, "seller_id string, total_orders long, days_to_first_sale long, "
                                     "days_since_last_sale long")
    out = {r.seller_id: r for r in labels.define_churn_labels(df).collect()}
    assert out["A"].never_activated == 1 and out["B"].never_activated == 0 and out["D"].never_activated == 0
    assert out["B"].dormant == 1 and out["C"].dormant == 0
    assert out["A"].churned == 1 and out["B"].churned == 1 and out["C"].churned == 0
    # a seller with orders but no days_to_first_sale is activated (NULL > 90 is false)
    assert out["C"].never_activated == 0 and out["C"].active == 1


def test_flags_overlap_kept(spark):
    # first sale 120 days after the deal (never activated) but sold recently (active)
    df = spark.createDataFrame([("X", 4, 120, 10)], "seller_id string, total_orders long, "
                                                    "days_to_first_sale long, days_since_last_sale long")
    r = labels.define_churn_labels(df).first()
    assert (r.never_activated, r.active, r.dormant, r.churned) == (1, 1, 0, 1)


def test_params_change_thresholds(spark):
    df = spark.createDataFrame([("X", 4, 50, 50)], "seller_id string, total_orders long, "
                                                  "days_to_first_sale long, days_since_last_sale long")
    r = labels.define_churn_labels(df, C.ChurnParams(never_activated_days=30, dormant_days=45)).first()
    assert (r.never_activated, r.dormant) == (1, 0)


def test_gmv_per_order(spark):
    df = spark.createDataFrame([(1000.0, 10), (500.0, 5), (0.0, 0)], "gmv double, orders long")
    vals = [r[0] for r in df.select(X.safe_ratio("gmv", "orders")).collect()]
    assert vals == [100.0, 100.0, 0.0]


def test_days_between_floors_negative(spark):
    df = spark.createDataFrame([(datetime(2020, 1, 3, 0, 0), datetime(2020, 1, 1, 12, 0))], "a timestamp_ntz, b timestamp_ntz")
    assert df.select(X.days_between("a", "b")).first()[0] == -2  # -1.5 days -> -2
    assert df.select(X.days_between("b", "a")).first()[0] == 1   # +1.5 days -> 1


@pytest.mark.parametrize("risk_value,expected", [
    (0.0, None), (0.0001, "Low"), (0.3, "Low"), (0.30001, "Medium"), (0.6, "Medium"),
    (0.8, "High"), (0.85, "Critical"), (1.0, "Critical"), (None, None)])
def test_risk_category_bins(spark, risk_value, expected):
    df = spark.createDataFrame([(risk_value,)], "r double")
    assert df.select(X.risk_category("r")).first()[0] == expected


def test_overall_risk_max_and_override(spark):
    df = spark.createDataFrame([(0.4, None), (0.4, 0.7), (0.9, 0.2)], "n double, d double")
    mx = [r[0] for r in df.select(X.overall_risk_max("n", "d")).collect()]
    ov = [r[0] for r in df.select(X.overall_risk_override("n", "d")).collect()]
    assert mx == [0.4, 0.7, 0.9]
    assert ov == [0.4, 0.7, 0.2]


def test_urgency_tiers(spark):
    df = spark.createDataFrame([(55,), (47,), (31,), (10,), (None,)], "d long")
    assert [r[0] for r in df.select(X.urgency("d", 60)).collect()] == ["Immediate", "High", "Medium", "Low", "Low"]


def test_revenue_band_and_action(spark):
    df = spark.createDataFrame([(0.0,), (900.0,), (5000.0,), (20000.0,), (None,)], "v double")
    assert [r[0] for r in df.select(X.revenue_band("v")).collect()] == [
        "Zero", "Low (1-1K)", "Medium (1K-10K)", "High (>10K)", None]
    act = spark.createDataFrame([(1, None, 0, None), (1, 10, 1, 5), (0, 3, 2, 10), (0, 3, 9, 40), (0, 3, 9, 10)],
                                "na int, d1 long, o long, s long")
    got = [r[0] for r in act.select(X.recommended_action("na", "d1", "o", "s")).collect()]
    assert got == [C.ACTION_ACTIVATION_SPRINT, C.ACTION_CATALOG_WORKSHOP, C.ACTION_EARLY, C.ACTION_WIN_BACK,
                   C.ACTION_SUSTAIN]


def test_round1_golden_cohort(spark):
    # 2018-05 in the reference outputs: 89 churned of 122, 59 never activated
    df = spark.createDataFrame([(89, 122, 59)], "c long, n long, na long")
    r = df.select(X.pct("c", "n"), X.pct(F.col("n") - F.col("na"), "n")).first()
    assert (r[0], r[1]) == (73.0, 51.6)


def test_cohort_extremes_first_wins_ties(spark):
    df = spark.createDataFrame([("2017-06", 50, 60.0), ("2017-07", 60, 61.7), ("2017-08", 55, 60.0)],
                               "cohort_month string, total_sellers long, churn_rate double")
    r = cohorts.cohort_extremes(df).first()
    assert r.cohorts == 3 and r.best_cohort == "2017-06" and r.worst_cohort == "2017-07"
    assert abs(r.avg_churn_rate - (60.0 + 61.7 + 60.0) / 3) < 1e-12


def test_bool_to_flag(spark):
    df = spark.createDataFrame([("True",), ("False",), (None,), ("true",)], "b string")
    assert [r[0] for r in df.select(X.bool_to_flag("b")).collect()] == [1, 0, 0, 1]


def test_risk_distribution_lists_empty_categories(spark):
    df = spark.createDataFrame([Row(risk_category="Low"), Row(risk_category="Low"), Row(risk_category=None)])
    out = risk.risk_distribution(df).collect()
    assert [r.risk_category for r in out] == ["Critical", "High", "Medium", "Low"]
    assert [r.sellers for r in out] == [0, 0, 0, 2]
    assert abs(out[3].share_pct - 200 / 3) < 1e-9


def test_currency_and_short_id(spark):
    df = spark.createDataFrame([(1234.5, 123456789)], "v double, id long")
    r = df.select(X.currency_brl("v"), X.short_id("id"), X.pretty_feature_name(F.lit("business_segment_encoded"))).first()
    assert r[0] == "R$ 1.234,50" and r[1] == "12345678…" and r[2] == "Business Segment"
