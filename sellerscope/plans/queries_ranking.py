"""Registered queries: ranks, top-k lists, interventions, features, splits
and evaluation (SURVEY 2.5, 2.6, 2.11 with an oracle)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sellerscope import config as C
from sellerscope.operators import evaluation as EV
from sellerscope.operators import interventions as IV
from sellerscope.operators import ranking, segments
from sellerscope.operators.scalars import attach_scalars
from sellerscope.oracle.base import q, with_ctes
from sellerscope.plans import features as FE
from sellerscope.plans import training as TR
from sellerscope.plans.catalog import register
from sellerscope.plans.queries_ops import ACTION_SQL, URGENCY_SQL, _segment_sql

D = "CAST({} AS DOUBLE)".format

# ------------------------------------------------------ intervention oracle

IV_CTES = dict(
    ar="SELECT * FROM f_scored WHERE coalesce(risk_category IN ('High', 'Critical'), FALSE) AND active = 1",
    rk=f"""
SELECT *, (CAST(rank() OVER (ORDER BY total_gmv) - 1 AS DOUBLE)
           + CAST(count(*) OVER (PARTITION BY total_gmv) + 1 AS DOUBLE) / {D(2)})
          / CAST(count(*) OVER () AS DOUBLE) AS gmv_percentile
FROM ar""",
    iv=f"""
SELECT *, overall_churn_risk * {D(0.6)} + gmv_percentile * {D(0.4)}
    AS priority_score,
  60 - days_since_last_sale AS days_until_dormant, {URGENCY_SQL} AS urgency
FROM rk""",
)
IV_COLS = ", ".join(C.INTERVENTION_COLUMNS)


@register("gmv_percentile", sql=with_ctes("SELECT seller_id, total_gmv, gmv_percentile FROM rk", **IV_CTES))
def q_gmv_percentile(inp):
    ar = IV.at_risk_active_sellers(inp.scored)
    return ranking.average_rank_pct(ar, "total_gmv", "gmv_percentile").select("seller_id", "total_gmv",
                                                                             "gmv_percentile")


@register("priority_score", sql=with_ctes("SELECT seller_id, priority_score, urgency FROM iv", **IV_CTES))
def q_priority_score(inp):
    return IV.prioritise(IV.at_risk_active_sellers(inp.scored), inp.params).select("seller_id", "priority_score",
                                                                                    "urgency")


@register("intervention_list", sql=with_ctes(f"SELECT {IV_COLS} FROM iv ORDER BY priority_score DESC, seller_id",
                                             **IV_CTES))
def q_intervention_list(inp):
    return IV.intervention_list(inp.scored, inp.params)


@register("urgency_tiers", sql=with_ctes("""
SELECT urgency, count(*) AS sellers, CAST(sum(CAST(total_gmv AS DECIMAL(20,2))) AS DOUBLE) AS gmv_at_risk
FROM iv WHERE urgency IN ('Immediate', 'High', 'Medium') GROUP BY urgency""", **IV_CTES))
def q_urgency_tiers(inp):
    return IV.urgency_tiers(IV.with_urgency(IV.at_risk_active_sellers(inp.scored), inp.params))


@register("business_gains", sql=with_ctes(f"""
SELECT *, {D(0.25)} AS intervention_success_rate,
  gmv_at_risk * {D(0.25)} * {D(3)} AS projected_gmv_saved,
  CAST(floor(total_at_risk * {D(0.25)}) AS BIGINT) AS projected_sellers_saved
FROM (SELECT count(*) AS total_at_risk,
        coalesce(CAST(sum(CAST(total_gmv AS DECIMAL(20,2))) AS DOUBLE), 0.0) AS gmv_at_risk,
        CAST(sum(CAST(total_gmv AS DECIMAL(20,2))) AS DOUBLE) / count(total_gmv) AS avg_seller_gmv FROM iv)""",
    **IV_CTES))
def q_business_gains(inp):
    return IV.business_gains(IV.at_risk_active_sellers(inp.scored), inp.params)


@register("top_immediate", sql=with_ctes("""
SELECT substr(CAST(seller_id AS VARCHAR), 1, 8) || '…' AS seller_id_short, seller_state, total_gmv,
  overall_churn_risk
FROM iv WHERE urgency = 'Immediate' ORDER BY priority_score DESC, seller_id LIMIT 5""", **IV_CTES))
def q_top_immediate(inp):
    return IV.top_immediate(IV.intervention_list(inp.scored, inp.params))


REPORT_COLS = ("seller_id", "seller_state", "business_segment", "total_gmv", "overall_churn_risk", "risk_category")


@register("top_report_rows", sql=with_ctes(
    f"SELECT {', '.join(REPORT_COLS)} FROM iv ORDER BY priority_score DESC, seller_id LIMIT 15", **IV_CTES))
def q_top_report_rows(inp):
    lst = IV.intervention_list(inp.scored, inp.params)
    return lst.orderBy(F.col("priority_score").desc(), "seller_id").limit(15).select(*REPORT_COLS)


@register("intervention_payload", sql=with_ctes("""
SELECT seller_id, seller_city, seller_state, business_segment, lead_behaviour_profile, total_orders,
  round_even(total_gmv, 2) AS total_gmv, days_since_last_sale,
  round_even(overall_churn_risk * 100, 1) AS overall_churn_risk, risk_category, urgency,
  round_even(priority_score, 3) AS priority_score,
  substr(CAST(seller_id AS VARCHAR), 1, 8) || '…' AS seller_id_short
FROM iv ORDER BY priority_score DESC, seller_id LIMIT 30""", **IV_CTES))
def q_intervention_payload(inp):
    return IV.intervention_payload(IV.intervention_list(inp.scored, inp.params))


POTENTIAL = ("CASE WHEN coalesce(total_gmv > 0, FALSE) THEN CAST(total_gmv AS DOUBLE) "
             "ELSE CAST(declared_monthly_revenue AS DOUBLE) * 12 END")


@register("intervention_top100", sql=with_ctes(f"""
SELECT {', '.join(C.TOP100_COLUMNS)} FROM (
  SELECT *, {POTENTIAL} AS potential_value, {ACTION_SQL} AS recommended_action
  FROM f_nb_scored WHERE overall_churn_risk > 0.6 AND churned = 0)
ORDER BY overall_churn_risk DESC, potential_value DESC NULLS LAST, seller_id LIMIT 100"""))
def q_intervention_top100(inp):
    return IV.intervention_top100(inp.notebook_scored)


@register("top_segments", sql=with_ctes("""
SELECT Segment, "Churn_Rate_%", Total_Sellers, Total_GMV FROM
  (SELECT * FROM s ORDER BY Total_Sellers DESC, Segment LIMIT 12)""", s=_segment_sql("business_segment")))
def q_top_segments(inp):
    t = segments.segment_analysis(inp.labelled, "business_segment")
    top = t.orderBy(F.col("Total_Sellers").desc(), "Segment").limit(12)
    return top.select("Segment", "Churn_Rate_%", "Total_Sellers", "Total_GMV").orderBy("Churn_Rate_%", "Segment")


@register("market_share", sql=with_ctes('SELECT Segment, Total_Sellers, "Market_Share_%" FROM s',
                                        s=_segment_sql("lead_type")))
def q_market_share(inp):
    return segments.segment_analysis(inp.labelled, "lead_type").select("Segment", "Total_Sellers", "Market_Share_%")


# ---------------------------------------------------------------- quantiles

def _quantile_sql(values_sql: str, p: float) -> str:
    from sellerscope.plans.queries_segments import _quantile_sql as qs
    return qs(values_sql, p)


ACT = "SELECT * FROM f_labelled WHERE never_activated = 0"


@register("quantile_flags", sql=with_ctes(f"""
SELECT a.seller_id, CAST(a.total_gmv > g.q AS INTEGER) AS is_high_value,
  CAST(a.total_orders > o.q AS INTEGER) AS is_frequent_seller
FROM ({ACT}) a CROSS JOIN ({_quantile_sql(f"SELECT CAST(total_gmv AS DOUBLE) AS v FROM ({ACT})", 0.75)}) g
CROSS JOIN ({_quantile_sql(f"SELECT CAST(total_orders AS DOUBLE) AS v FROM ({ACT})", 0.75)}) o"""))
def q_quantile_flags(inp):
    act = inp.labelled.filter(F.col("never_activated") == 0)
    return ranking.above_quantile_flags(act, ["seller_id"], [("total_gmv", 0.75, "is_high_value"),
                                                             ("total_orders", 0.75, "is_frequent_seller")])


@register("top_fraction_threshold", sql=with_ctes(f"""
SELECT qq.q AS threshold, count(*) AS flagged FROM f_scored
CROSS JOIN ({_quantile_sql("SELECT never_activated_risk AS v FROM f_scored", 0.8)}) qq
WHERE never_activated_risk >= qq.q GROUP BY qq.q"""))
def q_top_fraction_threshold(inp):
    s = inp.scored
    t = ranking.exact_quantile(s, "never_activated_risk", 0.8, "threshold")
    return (attach_scalars(s, t).filter(F.col("never_activated_risk") >= F.col("threshold"))
            .groupBy("threshold").agg(F.count(F.lit(1)).alias("flagged")))


@register("precision_at_top20", sql=with_ctes(f"""
SELECT qq.q AS threshold, avg(CAST(never_activated AS DOUBLE)) AS precision_at_top, count(*) AS flagged
FROM f_scored CROSS JOIN ({_quantile_sql("SELECT never_activated_risk AS v FROM f_scored", 0.8)}) qq
WHERE never_activated_risk >= qq.q GROUP BY qq.q"""))
def q_precision_at_top20(inp):
    return EV.precision_at_top(inp.scored, "never_activated", "never_activated_risk", 0.2)


# ------------------------------------------------------------ features

CATS = FE.CATEGORICALS


def _enc_sql(src: str, fill: dict | None = None) -> str:
    fill = fill or {}
    cols = []
    for c in CATS:
        txt = f"coalesce(CAST({c} AS VARCHAR), {q(fill[c])})" if c in fill else f"CAST({c} AS VARCHAR)"
        cols.append(f"CAST(dense_rank() OVER (ORDER BY {txt}) - 1 AS DOUBLE) AS {c}_encoded")
    return f"SELECT *, {', '.join(cols)} FROM {src}"


@register("label_encode", sql=with_ctes(
    "SELECT seller_id, " + ", ".join(f"{c}_encoded" for c in CATS) + f" FROM ({_enc_sql('f_labelled')})"))
def q_label_encode(inp):
    m = FE.pre_activation_pipeline().fit(inp.labelled).transform(inp.labelled)
    return m.select("seller_id", *[f"{c}_encoded" for c in CATS])


PRE_NUM_SQL = ", ".join(f"CAST(coalesce({c}, 0) AS DOUBLE) AS {c}" for c in FE.PRE_NUMERIC)


@register("features_pre_activation", sql=with_ctes(
    "SELECT seller_id, " + ", ".join(f"{c}_encoded" for c in CATS) + f", {PRE_NUM_SQL} "
    f"FROM ({_enc_sql('f_labelled')})"))
def q_features_pre_activation(inp):
    model = FE.pre_activation_pipeline().fit(inp.labelled)
    return FE.feature_frame(model, inp.labelled, list(C.PRE_ACTIVATION_FEATURES))


WIDE_FILL = {c: "unknown" for c in CATS if c != "seller_state"} | {"seller_state": "nan"}
WIDE_EXTRA_SQL = (
    "CAST(CASE WHEN has_company THEN 1 ELSE 0 END AS DOUBLE) AS has_company_binary, "
    "CAST(CASE WHEN has_gtin THEN 1 ELSE 0 END AS DOUBLE) AS has_gtin_binary, "
    "CAST(coalesce(declared_monthly_revenue, 0) = 0 AS DOUBLE) AS declared_revenue_zero, "
    "CAST(coalesce(declared_product_catalog_size, 0) = 0 AS DOUBLE) AS declared_catalog_zero")


@register("features_pre_activation_wide", sql=with_ctes(
    "SELECT seller_id, " + ", ".join(f"{c}_encoded" for c in CATS) + f", {PRE_NUM_SQL}, {WIDE_EXTRA_SQL} "
    f"FROM ({_enc_sql('f_nb', WIDE_FILL)})"))
def q_features_pre_activation_wide(inp):
    model = FE.pre_activation_pipeline(wide=True).fit(inp.notebook)
    return FE.feature_frame(model, inp.notebook, list(C.PRE_ACTIVATION_FEATURES) + list(C.WIDE_EXTRA_FEATURES))


def _clean_sql(expr: str, name: str) -> str:
    return (f"CASE WHEN ({expr}) IS NULL OR isnan({expr}) OR isinf({expr}) THEN CAST(0 AS DOUBLE) "
            f"ELSE ({expr}) END AS {name}")


RET_EXPRS = {
    "total_orders": D("total_orders"), "total_gmv": D("total_gmv"), "unique_customers": D("unique_customers"),
    "days_active": D("days_active"), "days_to_first_sale": D("days_to_first_sale"),
    "avg_order_value": D("avg_order_value"),
    "gmv_per_order": f"{D('total_gmv')} / {D('greatest(total_orders, 1)')}",
    "customers_per_order": f"{D('unique_customers')} / {D('greatest(total_orders, 1)')}",
    "activation_speed_score": D("CASE WHEN days_to_first_sale <= 7 THEN 3 WHEN days_to_first_sale <= 30 THEN 2 "
                                "ELSE 1 END"),
}
RET9 = [c for c in C.RETENTION_FEATURES if not c.endswith("_encoded")]


@register("features_retention", sql=with_ctes(
    "SELECT seller_id, " + ", ".join(_clean_sql(RET_EXPRS[c], c) for c in RET9)
    + " FROM f_labelled WHERE never_activated = 0"))
def q_features_retention(inp):
    act = inp.labelled.filter(F.col("never_activated") == 0)
    model = FE.retention_pipeline().fit(act)
    return FE.feature_frame(model, act, RET9)


WIDE_RET_ACT = list(C.WIDE_ACTIVITY_FEATURES)


@register("features_retention_wide", sql=with_ctes(
    "SELECT seller_id, " + ", ".join(f"{c}_encoded" for c in CATS) + f", {PRE_NUM_SQL}, {WIDE_EXTRA_SQL}, "
    + ", ".join(_clean_sql(RET_EXPRS[c], c) for c in WIDE_RET_ACT)
    + f" FROM ({_enc_sql('f_nb', WIDE_FILL)}) WHERE never_activated = 0"))
def q_features_retention_wide(inp):
    # encoders fitted on every seller, applied to the activated ones
    model = FE.retention_pipeline(wide=True).fit(inp.notebook)
    act = inp.notebook.filter(F.col("never_activated") == 0)
    cols = FE.retention_feature_list(wide=True)
    return FE.feature_frame(model, act, cols)


@register("activated_only", sql=with_ctes("SELECT seller_id, total_orders FROM f_labelled WHERE never_activated = 0"))
def q_activated_only(inp):
    from sellerscope.operators.labels import activated_only
    return activated_only(inp.labelled).select("seller_id", "total_orders")


HASH = "('0x' || substr(md5('42:' || CAST(seller_id AS VARCHAR)), 1, 15))::BIGINT"


@register("stratified_split", sql=with_ctes(f"""
SELECT seller_id, never_activated,
  CAST(row_number() OVER (PARTITION BY never_activated ORDER BY {HASH}, seller_id)
       <= ceil(count(*) OVER (PARTITION BY never_activated) * {D(0.25)}) AS INTEGER) AS is_test
FROM f_labelled"""))
def q_stratified_split(inp):
    return ranking.stratified_split(inp.labelled.select("seller_id", "never_activated"), "never_activated",
                                    "seller_id", inp.params.test_size, inp.params.seed)


@register("stratified_folds", sql=with_ctes(f"""
SELECT seller_id, never_activated,
  CAST((row_number() OVER (PARTITION BY never_activated ORDER BY {HASH}, seller_id) - 1) % 5 AS INTEGER) AS fold
FROM f_labelled"""))
def q_stratified_folds(inp):
    return ranking.stratified_folds(inp.labelled.select("seller_id", "never_activated"), "never_activated",
                                    "seller_id", inp.params.cv_folds, inp.params.seed)


@register("class_weights", sql=with_ctes("""
SELECT seller_id, never_activated,
  CAST((SELECT count(*) FROM f_labelled) AS DOUBLE)
    / ((SELECT count(DISTINCT never_activated) FROM f_labelled) * count(*) OVER (PARTITION BY never_activated))
    AS weight
FROM f_labelled"""))
def q_class_weights(inp):
    return TR.class_weights(inp.labelled.select("seller_id", "never_activated"), "never_activated")


# ------------------------------------------------------------ evaluation

EV_CTES = dict(
    ev="SELECT overall_churn_risk AS s, churned AS y, CAST(overall_churn_risk > 0.5 AS INTEGER) AS p FROM f_scored",
    cm="""SELECT CAST(sum(CASE WHEN y = 1 AND p = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp,
  CAST(sum(CASE WHEN y = 0 AND p = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
  CAST(sum(CASE WHEN y = 1 AND p = 0 THEN 1 ELSE 0 END) AS BIGINT) AS fn,
  CAST(sum(CASE WHEN y = 0 AND p = 0 THEN 1 ELSE 0 END) AS BIGINT) AS tn FROM ev""",
    g="SELECT s, CAST(sum(y) AS BIGINT) AS pos, CAST(sum(1 - y) AS BIGINT) AS neg FROM ev "
      "WHERE s IS NOT NULL AND y IS NOT NULL GROUP BY s",
    ga="""SELECT *, coalesce(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_before,
  sum(pos) OVER () AS pos_total, sum(neg) OVER () AS neg_total FROM g""",
    gd="""SELECT *, coalesce(sum(pos) OVER (ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
    AS pos_before,
  coalesce(sum(neg) OVER (ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_before,
  sum(pos) OVER () AS pos_total, sum(neg) OVER () AS neg_total FROM g""",
)


def _div0(a: str, b: str) -> str:
    return f"coalesce(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0), CAST(0 AS DOUBLE))"


METRICS_SQL = (f"{_div0('tp + tn', 'tp + fp + fn + tn')} AS accuracy, {_div0('tp', 'tp + fp')} AS precision, "
               f"{_div0('tp', 'tp + fn')} AS recall, {_div0('2 * tp', '2 * tp + fp + fn')} AS f1_score")
AUC_SQL = ("SELECT sum(pos * (neg_before + CAST(neg AS DOUBLE) / CAST(2 AS DOUBLE))) "
           "/ (CAST(max(pos_total) AS DOUBLE) * max(neg_total)) AS roc_auc FROM ga")


def _scored_eval(inp):
    return EV.with_prediction(inp.scored, "overall_churn_risk")


@register("binary_metrics", sql=with_ctes(f"SELECT {METRICS_SQL} FROM cm", **EV_CTES))
def q_binary_metrics(inp):
    return EV.binary_metrics(_scored_eval(inp), "churned")


@register("confusion_matrix", sql=with_ctes("""
SELECT 0 AS label, 0 AS prediction, tn AS count FROM cm UNION ALL SELECT 0, 1, fp FROM cm
UNION ALL SELECT 1, 0, fn FROM cm UNION ALL SELECT 1, 1, tp FROM cm""", **EV_CTES))
def q_confusion_matrix(inp):
    return EV.confusion_matrix(_scored_eval(inp), "churned")


@register("roc_auc", sql=with_ctes(AUC_SQL, **EV_CTES))
def q_roc_auc(inp):
    return EV.roc_auc(inp.scored, "churned", "overall_churn_risk")


@register("roc_curve", sql=with_ctes("""
SELECT 'inf'::DOUBLE AS threshold, CAST(0 AS DOUBLE) AS fpr, CAST(0 AS DOUBLE) AS tpr
UNION ALL SELECT CAST(s AS DOUBLE), CAST(neg_before + neg AS DOUBLE) / neg_total,
  CAST(pos_before + pos AS DOUBLE) / pos_total FROM gd""", **EV_CTES))
def q_roc_curve(inp):
    return EV.roc_curve(inp.scored, "churned", "overall_churn_risk")


@register("pr_curve", sql=with_ctes("""
SELECT CAST(s AS DOUBLE) AS threshold,
  CAST(pos_before + pos AS DOUBLE) / CAST(pos_before + pos + neg_before + neg AS DOUBLE) AS precision,
  CAST(pos_before + pos AS DOUBLE) / pos_total AS recall
FROM gd WHERE pos_before < pos_total""", **EV_CTES))
def q_pr_curve(inp):
    return EV.pr_curve(inp.scored, "churned", "overall_churn_risk")


@register("pr_auc", sql=with_ctes("""
SELECT sum(CAST(pos AS DOUBLE) / CAST(pos_total AS DOUBLE) * (p1 + p0) / CAST(2 AS DOUBLE)) AS pr_auc,
  (SELECT avg(CAST(y AS DOUBLE)) FROM ev) AS base_rate
FROM (SELECT *, CAST(pos_before + pos AS DOUBLE) / CAST(pos_before + pos + neg_before + neg AS DOUBLE) AS p1,
        CASE WHEN pos_before + neg_before = 0 THEN CAST(1 AS DOUBLE)
             ELSE CAST(pos_before AS DOUBLE) / CAST(pos_before + neg_before AS DOUBLE) END AS p0
      FROM gd WHERE pos_before < pos_total)""", **EV_CTES))
def q_pr_auc(inp):
    return EV.pr_auc(inp.scored, "churned", "overall_churn_risk")


def _report_row(name, tp, fp, fn) -> str:
    return (f"SELECT '{name}' AS class_label, {_div0(tp, f'{tp} + {fp}')} AS precision, "
            f"{_div0(tp, f'{tp} + {fn}')} AS recall, {_div0(f'2 * {tp}', f'2 * {tp} + {fp} + {fn}')} AS f1_score, "
            f"{tp} + {fn} AS support FROM cm")


@register("classification_report", sql=with_ctes(f"""
SELECT * FROM r
UNION ALL SELECT 'accuracy', NULL, NULL, {_div0('tp + tn', 'tp + tn + fp + fn')}, tp + tn + fp + fn FROM cm
UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1_score), sum(support) FROM r
UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
  sum(f1_score * support) / sum(support), sum(support) FROM r""",
    **EV_CTES, r=_report_row("0", "tn", "fn", "fp") + " UNION ALL " + _report_row("1", "tp", "fp", "fn")))
def q_classification_report(inp):
    return EV.classification_report(_scored_eval(inp), "churned")


@register("combined_metrics", sql=with_ctes(f"""
SELECT round_even(a.roc_auc, 3) AS roc_auc, round_even(m.accuracy, 3) AS accuracy,
  round_even(m.precision, 3) AS precision, round_even(m.recall, 3) AS recall, round_even(m.f1_score, 3) AS f1_score
FROM ({AUC_SQL}) a CROSS JOIN (SELECT {METRICS_SQL} FROM cm) m""", **EV_CTES))
def q_combined_metrics(inp):
    return EV.combined_metrics(inp.scored)


CANDIDATES = (("max_combination", "overall_churn_risk"), ("pre_activation_only", "never_activated_risk"),
              ("dormancy_override", "coalesce(dormancy_risk, never_activated_risk)"))


def _auc_of(expr: str) -> str:
    return f"""(SELECT sum(pos * (neg_before + CAST(neg AS DOUBLE) / CAST(2 AS DOUBLE)))
   / (CAST(max(pos_total) AS DOUBLE) * max(neg_total)) FROM (
  SELECT *, coalesce(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_before,
    sum(pos) OVER () AS pos_total, sum(neg) OVER () AS neg_total
  FROM (SELECT {expr} AS s, CAST(sum(churned) AS BIGINT) AS pos, CAST(sum(1 - churned) AS BIGINT) AS neg
        FROM f_scored WHERE {expr} IS NOT NULL GROUP BY 1)))"""


@register("select_best", sql=with_ctes("""
SELECT arg_max(algorithm, (roc_auc, -candidate_order)) AS algorithm,
  arg_max(candidate_order, (roc_auc, -candidate_order)) AS candidate_order, max(roc_auc) AS roc_auc
FROM m""", m=" UNION ALL ".join(f"SELECT {q(n)} AS algorithm, {i} AS candidate_order, {_auc_of(e)} AS roc_auc"
                                for i, (n, e) in enumerate(CANDIDATES))))
def q_select_best(inp):
    s = inp.scored.withColumn("dormancy_override", F.coalesce("dormancy_risk", "never_activated_risk"))
    cols = {"max_combination": "overall_churn_risk", "pre_activation_only": "never_activated_risk",
            "dormancy_override": "dormancy_override"}
    cells = F.array(*[F.struct(F.lit(n).alias("algorithm"), F.lit(i).alias("candidate_order"), F.col(c).cast("double").alias("p"))
                      for i, (n, c) in enumerate(cols.items())])
    long = s.select("churned", F.explode(cells).alias("x")).select("churned", "x.*")
    order = F.element_at(F.create_map(*[F.lit(x) for i, n in enumerate(cols) for x in (n, i)]), F.col("algorithm"))
    m = EV.candidate_metrics(long, "algorithm", "churned", "p").select("algorithm", order.alias("candidate_order"), "roc_auc")
    return TR.select_best(m)
