"""The three runs of the reference, as Spark jobs: training/analytics run,
inference run (saved models, no fit) and the dashboard tables.

Everything is written to an output folder (shared storage on a cluster);
nothing is collected except the bounded model-selection metrics.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sellerscope import config as C
from sellerscope.config import DEFAULT_PARAMS, ChurnParams
from sellerscope.operators import cohorts, interventions, labels, master, quality, risk, segments, summary
from sellerscope.plans import scoring as SC
from sellerscope.plans import training as TR
from sellerscope.sources import registry, sinks

SEGMENT_COLUMNS = ("business_segment", "lead_behaviour_profile", "lead_type", "seller_state")


def labelled_master(tables: dict[str, DataFrame], params: ChurnParams = DEFAULT_PARAMS) -> DataFrame:
    """Joins -> activity -> fills -> labels (the reference's stage order)."""
    return labels.define_churn_labels(master.build_master(tables, params.completed_statuses), params)


def _write(df: DataFrame, out_dir: str, name: str, fmt: str) -> None:
    sinks.write_table(df, os.path.join(out_dir, name), fmt)


def run_training(spark: SparkSession, tables: dict[str, DataFrame], out_dir: str,
                 params: ChurnParams = DEFAULT_PARAMS, fmt: str = "parquet",
                 algorithms=TR.ALGORITHMS, run_id: str | None = None) -> dict:
    """Analytics + both models + scoring + exports. The labelled master is
    written once and re-read, so its lineage (the large join and the
    activity aggregation) is computed a single time for all consumers."""
    path = os.path.join(out_dir, "seller_master")
    labelled_master(tables, params).write.mode("overwrite").parquet(path)
    lab = spark.read.parquet(path)
    _write(cohorts.cohort_analysis(lab), out_dir, "cohort_analysis", fmt)
    found = [c for c in SEGMENT_COLUMNS if c in lab.columns]
    if found:  # one scan of the master for all of them
        tables_path = os.path.join(out_dir, "segment_tables")
        segments.segment_tables(lab, found).write.mode("overwrite").parquet(tables_path)
        every = spark.read.parquet(tables_path)
        for col in found:
            seg = every.filter(F.col("segment_column") == col).drop("segment_column")
            _write(seg.orderBy(F.col("Churn_Rate_%").desc(), "Segment"), out_dir, f"segment_analysis_{col}", fmt)
    _write(quality.check_master(lab), out_dir, "contract_seller_master", fmt)
    result = {"pre_activation": None, "retention": None}
    if lab.limit(TR.MIN_ROWS + 1).count() > TR.MIN_ROWS:
        pre = TR.pre_activation(lab, params, algorithms=algorithms)
        ret = TR.retention(lab, params, algorithms=algorithms)
        result.update(pre_activation=pre, retention=ret)
        runs = TR.metrics_frame(spark, [r for r in (pre, ret) if r.metrics], run_id, params)
        TR.log_run(runs, os.path.join(out_dir, "model_runs"))
        for res in (pre, ret):
            if res.model is not None:
                TR.save_model(res.model, os.path.join(out_dir, "models", res.stage))
                _write(TR.evaluate_model(res), out_dir, f"evaluation_{res.stage}", fmt)
                _write(TR.importance_frame(spark, res), out_dir, f"feature_importance_{res.stage}", fmt)
        if pre.model is not None:
            scored = SC.score_sellers(lab, pre.model, ret.model)
            spath = os.path.join(out_dir, "seller_risk_scores")
            scored.write.mode("overwrite").parquet(spath)
            scored = spark.read.parquet(spath)
            _write(quality.check_scores(scored), out_dir, "contract_risk_scores", fmt)
            iv = interventions.intervention_list(scored, params)
            _write(iv, out_dir, "intervention_priority_list", fmt)  # empty too: no old list stays
            _write(interventions.business_gains(interventions.at_risk_active_sellers(scored), params), out_dir, "business_gains", fmt)
            _write(interventions.urgency_tiers(iv), out_dir, "urgency_tiers", fmt)
            _write(summary.exec_summary(scored), out_dir, "exec_summary", fmt)
            _write(risk.risk_distribution(scored), out_dir, "risk_distribution", fmt)
    return result


def run_inference(spark: SparkSession, tables: dict[str, DataFrame], model_dir: str, out_path: str,
                  params: ChurnParams = DEFAULT_PARAMS, fmt: str = "parquet") -> DataFrame:
    """Score a fresh extract with the saved models (no fit; the encoders are
    inside the saved pipelines). Fails when the pre-activation model is
    missing; the retention model is optional."""
    pre_path = os.path.join(model_dir, "pre_activation")
    ret_path = os.path.join(model_dir, "retention")
    if not registry._path_exists(spark, pre_path):
        raise FileNotFoundError(pre_path)
    pre = TR.load_model(pre_path)
    ret = TR.load_model(ret_path) if registry._path_exists(spark, ret_path) else None
    scored = SC.score_sellers(labelled_master(tables, params), pre, ret)
    out = sinks.project_available(scored, C.SCORE_COLUMNS)
    sinks.write_table(out, out_path, fmt)
    return risk.risk_distribution(sinks.read_back(spark, out_path, fmt) if fmt == "parquet" else out)


def dashboard_tables(spark: SparkSession, out_dir: str, params: ChurnParams = DEFAULT_PARAMS,
                     fmt: str = "parquet") -> dict[str, DataFrame]:
    """KPI row, risk distribution, complete cohorts, top segments, profile
    and state series, intervention payload and combined metrics, from the
    training run's outputs; a missing output gives an empty table (never
    invented numbers)."""
    def read(name, fmt=fmt):
        path = os.path.join(out_dir, name)
        if registry._path_exists(spark, path):
            return sinks.read_back(spark, path, fmt)
        return registry.safe_read(spark, path)

    scores = read("seller_risk_scores", "parquet")
    out = {}
    if scores.columns:
        out["kpi"] = summary.kpi_row(scores, params)
        out["risk_distribution"] = risk.risk_distribution(scores)
        out["combined_metrics"] = _combined(scores)
    cohort = read("cohort_analysis")
    if cohort.columns:
        out["cohorts"] = cohorts.complete_cohorts(cohort)
    seg = read("segment_analysis_business_segment")
    if seg.columns:
        out["top_segments"] = (seg.orderBy(F.col("Total_Sellers").desc(), "Segment").limit(12)
                               .orderBy("Churn_Rate_%", "Segment"))
    prof = read("segment_analysis_lead_behaviour_profile")
    if prof.columns:
        out["profiles"] = prof.filter(~F.coalesce(F.col("Segment").contains(","), F.lit(False)))
    state = read("segment_analysis_seller_state")
    if state.columns:
        out["states"] = state.filter(F.col("Segment") != C.UNKNOWN).orderBy("Churn_Rate_%", "Segment")
    iv = read("intervention_priority_list")
    if iv.columns:
        out["interventions"] = interventions.intervention_payload(iv)
    return out


def _combined(scores: DataFrame) -> DataFrame:
    from sellerscope.operators.evaluation import combined_metrics
    return combined_metrics(scores)
