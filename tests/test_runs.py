"""The three runs end to end on sf0.001 (one candidate to stay fast)."""

import os

from pyspark.sql import functions as F

from sellerscope.plans import runs
from sellerscope.session import scratch_path
from sellerscope.sources.fixture import funnel_tables
from tests.conftest import SF_SMALL


def test_training_inference_dashboard(spark):
    out = scratch_path(spark, "run")
    tables = funnel_tables(spark, SF_SMALL)
    res = runs.run_training(spark, tables, out, algorithms=("LogisticRegression",))
    assert res["pre_activation"].model is not None
    scores = spark.read.parquet(os.path.join(out, "seller_risk_scores"))
    assert scores.count() == 350
    assert scores.filter(F.col("overall_churn_risk").isNull()).count() == 0
    # dormancy risk only for activated sellers
    assert scores.filter((F.col("never_activated") == 1) & F.col("dormancy_risk").isNotNull()).count() == 0
    run_log = spark.read.parquet(os.path.join(out, "model_runs"))
    assert run_log.filter("is_best").count() == 2
    contract = spark.read.parquet(os.path.join(out, "contract_risk_scores"))
    assert contract.agg(F.sum("violations")).first()[0] == 0
    dist = runs.run_inference(spark, tables, os.path.join(out, "models"), os.path.join(out, "inference"))
    assert dist.agg(F.sum("sellers")).first()[0] == 350
    # scoring with the saved pipeline reproduces the training run's scores
    again = spark.read.parquet(os.path.join(out, "inference")).select("seller_id", "overall_churn_risk")
    diff = scores.select("seller_id", F.col("overall_churn_risk").alias("a")).join(again, "seller_id")
    assert diff.filter(F.abs(F.col("a") - F.col("overall_churn_risk")) > 1e-12).count() == 0
    assert set(run_log.select(F.explode(F.map_keys("config"))).distinct().toPandas()["col"]) >= {"seed", "dormant_days"}
    dash = runs.dashboard_tables(spark, out)
    assert {"kpi", "risk_distribution", "cohorts", "top_segments", "combined_metrics"} <= set(dash)
    assert dash["kpi"].first().total_sellers == 350
