"""Registered queries: segment tables, tests, summaries, distributions
(SURVEY 2.4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sellerscope.operators import labels, ranking, risk, segments, summary
from sellerscope.operators.scalars import attach_scalars
from sellerscope.oracle import base as O
from sellerscope.oracle.base import dmean, pct, q, revenue_case, with_ctes, xavg, xsum
from sellerscope.plans.catalog import register
from sellerscope.plans.queries_ops import _segment_sql

# ------------------------------------------------------------ oracle helpers


def _profile_sql(col: str, label: str, means=(), sort_by_volume=False) -> str:
    extra = "".join(f", avg(CAST({c} AS DOUBLE)) AS {n}" for c, n in means)
    return f"""
SELECT *, {pct('Churned', 'Total_Sellers')} AS "Churn_Rate_%",
  {pct('Total_Sellers - Never_Activated', 'Total_Sellers')} AS "Activation_Rate_%"
FROM (SELECT coalesce(CAST({col} AS VARCHAR), 'Unknown') AS {label}, count(seller_id) AS Total_Sellers,
        CAST(sum(churned) AS BIGINT) AS Churned, CAST(sum(never_activated) AS BIGINT) AS Never_Activated,
        CAST(sum(dormant) AS BIGINT) AS Dormant, CAST(sum(active) AS BIGINT) AS Active,
        {xavg('total_gmv')} AS Avg_GMV{extra}
      FROM f_nb GROUP BY 1)"""


def _extremes_sql(table_sql: str, label: str, min_support: int) -> str:
    return f"""
SELECT count(*) AS segments,
  arg_min({label}, ("Churn_Rate_%", {label})) AS best_segment, min("Churn_Rate_%") AS best_churn_rate,
  arg_min({label}, (-"Churn_Rate_%", {label})) AS worst_segment, max("Churn_Rate_%") AS worst_churn_rate,
  round_even(max("Churn_Rate_%") - min("Churn_Rate_%"), 1) AS churn_range_pp
FROM ({table_sql}) WHERE Total_Sellers >= {min_support}"""


# --------------------------------------------------------------- baseline

BASELINE_SQL = f"""
SELECT * FROM (SELECT
  CAST(count(*) AS DOUBLE) AS total_sellers,
  CAST(sum(never_activated) AS DOUBLE) AS never_activated,
  CAST(sum(dormant) AS DOUBLE) AS dormant,
  CAST(sum(active) AS DOUBLE) AS active,
  CAST(sum(churned) AS DOUBLE) AS total_churned,
  CAST(sum(CASE WHEN never_activated = 0 THEN 1 ELSE 0 END) AS DOUBLE) AS activated_sellers,
  avg(CAST(days_to_first_sale AS DOUBLE)) AS avg_days_to_first_sale,
  quantile_cont(CAST(days_to_first_sale AS DOUBLE), 0.5) AS median_days_to_first_sale,
  {dmean('CASE WHEN never_activated = 0 THEN CAST(total_orders AS DOUBLE) END')} AS avg_orders_activated,
  {dmean('CASE WHEN never_activated = 0 THEN CAST(total_gmv AS DOUBLE) END')} AS avg_gmv_activated,
  {dmean('CASE WHEN never_activated = 0 THEN CAST(avg_order_value AS DOUBLE) END')} AS avg_order_value_activated,
  {dmean('CASE WHEN never_activated = 0 THEN CAST(unique_customers AS DOUBLE) END')} AS avg_customers_activated,
  {dmean('CASE WHEN never_activated = 0 THEN CAST(days_active AS DOUBLE) END')} AS avg_days_active_activated
FROM f_nb) UNPIVOT (value FOR metric IN (total_sellers, never_activated, dormant, active, total_churned,
  activated_sellers, avg_days_to_first_sale, median_days_to_first_sale, avg_orders_activated, avg_gmv_activated,
  avg_order_value_activated, avg_customers_activated, avg_days_active_activated))"""


@register("baseline_metrics", sql=with_ctes(BASELINE_SQL))
def q_baseline_metrics(inp):
    return labels.baseline_metrics(inp.notebook)


# -------------------------------------------------------------- segments

for _col in ("business_segment", "lead_behaviour_profile", "lead_type", "seller_state"):
    def _mk(col):
        name = "segment_analysis" if col == "business_segment" else f"segment_analysis_{col}"

        @register(name, sql=with_ctes("SELECT * FROM s", s=_segment_sql(col)))
        def _q(inp):
            return segments.segment_analysis(inp.labelled, col)
        return _q
    _mk(_col)

SEGMENTED = ("business_segment", "lead_behaviour_profile", "lead_type", "seller_state")


@register("segment_tables", sql=with_ctes(" UNION ALL ".join(
    f"SELECT '{c}' AS segment_column, * FROM ({_segment_sql(c)})" for c in SEGMENTED)))
def q_segment_tables(inp):
    return segments.segment_tables(inp.labelled, SEGMENTED)


PROFILE_SQL = _profile_sql("lead_behaviour_profile", "DISC_Profile", [("total_orders", "Avg_Orders")])
BUSINESS_SQL = _profile_sql("business_segment", "Business_Segment", [("total_orders", "Avg_Orders")])


@register("segment_profile", sql=with_ctes(PROFILE_SQL))
def q_segment_profile(inp):
    return segments.segment_profile(inp.notebook)


@register("segment_business", sql=with_ctes(BUSINESS_SQL))
def q_segment_business(inp):
    return segments.segment_business(inp.notebook)


@register("segment_lead_type", sql=with_ctes(_profile_sql(
    "lead_type", "Lead_Type", [("total_orders", "Avg_Orders"), ("sales_cycle_days", "Avg_Sales_Cycle_Days")])))
def q_segment_lead_type(inp):
    return segments.segment_lead_type(inp.notebook)


@register("segment_business_type", sql=with_ctes(_profile_sql(
    "business_type", "Business_Type", [("total_orders", "Avg_Orders")])))
def q_segment_business_type(inp):
    return segments.segment_business_type(inp.notebook)


def _small_sql(key: str, label: str, where: str = "TRUE") -> str:
    return f"""
SELECT *, {pct('Churned', 'Total_Sellers')} AS "Churn_Rate_%"
FROM (SELECT {key} AS {label}, count(seller_id) AS Total_Sellers, CAST(sum(churned) AS BIGINT) AS Churned,
        CAST(sum(never_activated) AS BIGINT) AS Never_Activated, CAST(sum(active) AS BIGINT) AS Active
      FROM f_nb WHERE {where} GROUP BY 1)"""


BANDS = " UNION ALL ".join(f"SELECT {q(lab)} AS Declared_Revenue, {i} AS band_order"
                           for i, lab in enumerate(O.REVENUE_LABELS))


@register("segment_revenue_band", sql=with_ctes(f"""
SELECT b.Declared_Revenue, b.band_order,
  coalesce(c.Total_Sellers, 0) AS Total_Sellers, coalesce(c.Churned, 0) AS Churned,
  coalesce(c.Never_Activated, 0) AS Never_Activated, coalesce(c.Active, 0) AS Active, c."Churn_Rate_%"
FROM ({BANDS}) b LEFT JOIN ({_small_sql(revenue_case('declared_monthly_revenue'), 'Declared_Revenue',
                                        revenue_case('declared_monthly_revenue') + ' IS NOT NULL')}) c
  ON b.Declared_Revenue = c.Declared_Revenue"""))
def q_segment_revenue_band(inp):
    return segments.segment_revenue_band(inp.notebook)


@register("segment_has_company", sql=with_ctes(_small_sql(
    "CASE WHEN has_company THEN 'True' WHEN NOT has_company THEN 'False' ELSE 'Unknown' END", "Has_Company")))
def q_segment_has_company(inp):
    return segments.segment_has_company(inp.notebook)


@register("segment_origin", sql=with_ctes(f"""
SELECT * EXCLUDE (n_sources) FROM (
  SELECT *, {pct('Churned', 'Total_Sellers')} AS "Churn_Rate_%", count(*) OVER () AS n_sources
  FROM (SELECT coalesce(origin, 'Unknown') AS Lead_Source, count(seller_id) AS Total_Sellers,
          CAST(sum(churned) AS BIGINT) AS Churned, CAST(sum(never_activated) AS BIGINT) AS Never_Activated,
          CAST(sum(active) AS BIGINT) AS Active, {xavg('total_gmv')} AS Avg_GMV,
          avg(CAST(sales_cycle_days AS DOUBLE)) AS Avg_Sales_Cycle_Days
        FROM f_nb GROUP BY 1))
WHERE n_sources > 1"""))
def q_segment_origin(inp):
    return segments.segment_origin(inp.notebook)


@register("segment_state_top10", sql=with_ctes(f"""
SELECT *, {pct('Churned', 'Total_Sellers')} AS "Churn_Rate_%"
FROM (SELECT seller_state AS State, count(seller_id) AS Total_Sellers, CAST(sum(churned) AS BIGINT) AS Churned,
        CAST(sum(never_activated) AS BIGINT) AS Never_Activated, CAST(sum(active) AS BIGINT) AS Active,
        {xavg('total_gmv')} AS Avg_GMV
      FROM f_nb WHERE seller_state IS NOT NULL GROUP BY 1)
ORDER BY Total_Sellers DESC, State LIMIT 10"""))
def q_segment_state_top10(inp):
    return segments.segment_state_top10(inp.notebook)


@register("segment_extremes", sql=with_ctes(_extremes_sql(BUSINESS_SQL, "Business_Segment", 10)))
def q_segment_extremes(inp):
    return segments.segment_extremes(segments.segment_business(inp.notebook), "Business_Segment")


@register("min_support_segments", sql=with_ctes(f"SELECT * FROM ({BUSINESS_SQL}) WHERE Total_Sellers >= 10"))
def q_min_support_segments(inp):
    return segments.segment_business(inp.notebook).filter(F.col("Total_Sellers") >= 10)


CONTINGENCY_SQL = """
SELECT coalesce(lead_behaviour_profile, 'Unknown') AS segment,
  CAST(sum(CASE WHEN churned = 0 THEN 1 ELSE 0 END) AS BIGINT) AS churned_0,
  CAST(sum(CASE WHEN churned = 1 THEN 1 ELSE 0 END) AS BIGINT) AS churned_1
FROM f_nb WHERE coalesce(lead_behaviour_profile, 'Unknown') <> 'Unknown' GROUP BY 1"""


@register("contingency_table", sql=with_ctes(CONTINGENCY_SQL))
def q_contingency_table(inp):
    return segments.contingency_table(inp.notebook, "lead_behaviour_profile")


CHI_SQL = """
SELECT CAST(sum(CAST(power(abs(o - e) - corr, 2) / e AS DECIMAL(38,9))) AS DOUBLE) AS chi2, dof FROM (
  SELECT o, e, dof, CASE WHEN dof = 1 THEN least(0.5, abs(o - e)) ELSE 0.0 END AS corr FROM (
    SELECT cells.o, CAST(rowt.row_total * cells.col_total AS DOUBLE) / CAST(dims.n AS DOUBLE) AS e,
      CAST((dims.r - 1) * (dims.k - 1) AS BIGINT) AS dof
    FROM cells JOIN rowt ON cells.segment = rowt.segment CROSS JOIN dims))
GROUP BY dof"""
CHI_CTES = dict(
    ct=CONTINGENCY_SQL,
    cells0="SELECT segment, 0 AS c, churned_0 AS o FROM ct UNION ALL SELECT segment, 1, churned_1 FROM ct",
    colt="SELECT c, sum(o) AS col_total FROM cells0 GROUP BY c HAVING sum(o) > 0",
    cells="SELECT cells0.*, colt.col_total FROM cells0 JOIN colt ON cells0.c = colt.c",
    rowt="SELECT segment, sum(o) AS row_total FROM cells GROUP BY segment",
    dims="SELECT sum(o) AS n, count(DISTINCT segment) AS r, count(DISTINCT c) AS k FROM cells",
)


@register("chi_square_test", sql=with_ctes(CHI_SQL, **CHI_CTES))
def q_chi_square_test(inp):
    t = segments.contingency_table(inp.notebook, "lead_behaviour_profile")
    return segments.chi_square_test(t).select("chi2", "dof")


# the five profiles give four degrees of freedom; the finite sum of an even number, rounded
PVALUE_SQL = ("SELECT chi2, dof, round(CASE WHEN dof % 2 = 0 THEN exp(-chi2 / 2) * list_sum(list_transform("
              "range(0, dof // 2), lambda i: pow(chi2 / 2, i) / gamma(i + 1))) END, 9) AS p_value")


@register("chi_square_pvalue", sql=with_ctes(f"{PVALUE_SQL} FROM ({CHI_SQL})", **CHI_CTES))
def q_chi_square_pvalue(inp):
    t = segments.chi_square_test(segments.contingency_table(inp.notebook, "lead_behaviour_profile"))
    return t.withColumn("p_value", F.round("p_value", 9))


AVD_METRICS = [("Total Orders", "total_orders"), ("Total GMV (R$)", "total_gmv"),
               ("Avg Order Value (R$)", "avg_order_value"), ("Unique Customers", "unique_customers"),
               ("Days Active", "days_active")]


@register("active_vs_dormant", sql=with_ctes(
    "SELECT *, round_even((Active_Sellers - Dormant_Sellers) / NULLIF(Dormant_Sellers, 0) * 100, 1) "
    "AS \"Difference_%\" FROM (" + " UNION ALL ".join(
        f"SELECT {q(name)} AS Metric, {dmean(f'CASE WHEN active = 1 THEN CAST({c} AS DOUBLE) END')} AS Active_Sellers, "
        f"{dmean(f'CASE WHEN dormant = 1 THEN CAST({c} AS DOUBLE) END')} AS Dormant_Sellers, {i} AS metric_order "
        f"FROM f_nb WHERE never_activated = 0"
        for i, (name, c) in enumerate(AVD_METRICS)) + ")"))
def q_active_vs_dormant(inp):
    return segments.active_vs_dormant(inp.notebook)


@register("zero_revenue_churn", sql=with_ctes("""
SELECT count(*) AS sellers, avg(CAST(churned AS DOUBLE)) * 100 AS churn_rate
FROM f_nb WHERE declared_monthly_revenue = 0"""))
def q_zero_revenue_churn(inp):
    return segments.zero_revenue_churn(inp.notebook)


@register("churn_drivers", sql=with_ctes(f"""
SELECT * FROM (
  SELECT 1 AS driver, 'Never Activated' AS name, avg(CAST(never_activated AS DOUBLE)) * 100 AS impact,
    CAST(NULL AS DOUBLE) AS range_pp FROM f_nb
  UNION ALL SELECT 2, worst_segment, worst_churn_rate, churn_range_pp FROM
    ({_extremes_sql(f"SELECT * FROM ({PROFILE_SQL}) WHERE DISC_Profile <> 'Unknown'", 'DISC_Profile', 0)})
  UNION ALL SELECT 3, worst_segment, worst_churn_rate, churn_range_pp FROM
    ({_extremes_sql(BUSINESS_SQL, 'Business_Segment', 10)})
  UNION ALL SELECT 4, 'Zero Declared Revenue', avg(CAST(churned AS DOUBLE)) * 100, NULL FROM f_nb
    WHERE declared_monthly_revenue = 0
  UNION ALL SELECT 5, 'Low First-Month Performance', avg(CAST(dormant AS DOUBLE)) * 100, NULL FROM f_nb
    WHERE never_activated = 0)
WHERE impact IS NOT NULL"""))
def q_churn_drivers(inp):
    return segments.churn_drivers(inp.notebook)


# ------------------------------------------------------- risk and summaries

CATS = " UNION ALL ".join(f"SELECT {q(lab)} AS risk_category, {i} AS category_order"
                          for i, lab in enumerate(reversed(O.RISK_LABELS)))


@register("risk_distribution", sql=with_ctes(f"""
SELECT c.risk_category, c.category_order, coalesce(n.sellers, 0) AS sellers,
  CAST(coalesce(n.sellers, 0) AS DOUBLE) / CAST((SELECT count(*) FROM f_scored) AS DOUBLE) * 100 AS share_pct
FROM ({CATS}) c LEFT JOIN (SELECT risk_category, count(*) AS sellers FROM f_scored GROUP BY 1) n
  ON c.risk_category = n.risk_category"""))
def q_risk_distribution(inp):
    return risk.risk_distribution(inp.scored)


@register("avg_risk_by_status", sql=with_ctes(" UNION ALL ".join(
    f"SELECT {q(s)} AS status, {dmean('overall_churn_risk', 9)} AS avg_risk FROM f_scored WHERE {s} = 1 "
    f"HAVING count(*) > 0" for s in ("never_activated", "dormant", "active"))))
def q_avg_risk_by_status(inp):
    return risk.avg_risk_by_status(inp.scored)


HIGH = "coalesce(risk_category IN ('High', 'Critical'), FALSE)"


@register("exec_summary", sql=with_ctes(f"""
SELECT *, CASE WHEN total_gmv > 0 THEN churned_gmv / total_gmv * 100 ELSE 0.0 END AS gmv_share FROM (
SELECT count(*) AS total_sellers, CAST(sum(churned) AS BIGINT) AS churned,
  avg(CAST(churned AS DOUBLE)) * 100 AS churn_rate,
  coalesce({xsum('CASE WHEN churned = 1 THEN total_gmv END')}, 0.0) AS churned_gmv,
  {xsum('total_gmv')} AS total_gmv,
  CAST(sum(CAST({HIGH} AS INTEGER)) AS BIGINT) AS high_critical,
  coalesce({xsum(f'CASE WHEN {HIGH} AND churned = 0 THEN total_gmv END')}, 0.0) AS revenue_at_risk
FROM f_scored)"""))
def q_exec_summary(inp):
    return summary.exec_summary(inp.scored)


@register("kpi_row", sql=with_ctes(f"""
SELECT *, round_even(CAST(high_risk AS DOUBLE) / CAST(total_sellers AS DOUBLE) * 100, 1) AS high_risk_pct,
  round_even(gmv_at_risk * 0.25 * 3.0, 2) AS projected_gmv_saved FROM (
SELECT count(*) AS total_sellers, round_even(avg(CAST(churned AS DOUBLE)) * 100, 1) AS churn_rate,
  CAST(sum(never_activated) AS BIGINT) AS never_activated, CAST(sum(dormant) AS BIGINT) AS dormant,
  CAST(sum(active) AS BIGINT) AS active,
  round_even(coalesce({xsum('CASE WHEN churned = 1 THEN total_gmv END')}, 0.0), 2) AS gmv_at_risk,
  CAST(sum(CAST({HIGH} AS INTEGER)) AS BIGINT) AS high_risk,
  round_even({xsum('total_gmv')} / count(total_gmv), 2) AS avg_gmv
FROM f_scored)"""))
def q_kpi_row(inp):
    return summary.kpi_row(inp.scored, inp.params)


# --------------------------------------------------------------- histograms

def _hist_sql(values_sql: str, bins: int) -> dict:
    return dict(
        hv=f"SELECT v FROM ({values_sql}) WHERE v IS NOT NULL AND NOT isnan(v)",
        hs="SELECT CASE WHEN min(v) = max(v) THEN min(v) - 0.5 ELSE min(v) END AS lo, "
           "CASE WHEN min(v) = max(v) THEN max(v) + 0.5 ELSE max(v) END AS hi FROM hv",
        hc=f"SELECT CASE WHEN b >= {bins} THEN {bins - 1} ELSE b END AS bin, count(*) AS count FROM "
           f"(SELECT CAST(floor((v - lo) * (CAST({bins} AS DOUBLE) / (hi - lo))) AS INTEGER) AS b "
           f"FROM hv CROSS JOIN hs WHERE v >= lo AND v <= hi) GROUP BY 1",
    )


def _hist_final(bins: int) -> str:
    return f"""
SELECT g.bin, lo + g.bin * ((hi - lo) / CAST({bins} AS DOUBLE)) AS bin_lower,
  CASE WHEN g.bin = {bins - 1} THEN hi ELSE lo + (g.bin + 1) * ((hi - lo) / CAST({bins} AS DOUBLE)) END AS bin_upper,
  coalesce(hc.count, 0) AS count
FROM (SELECT CAST(range AS INTEGER) AS bin FROM range({bins})) g CROSS JOIN hs LEFT JOIN hc ON g.bin = hc.bin"""


@register("histogram", sql=with_ctes(_hist_final(30), **_hist_sql(
    "SELECT CAST(overall_churn_risk AS DOUBLE) AS v FROM f_scored", 30)))
def q_histogram(inp):
    return ranking.histogram(inp.scored, "overall_churn_risk", 30)


@register("histogram_risk_50", sql=with_ctes(_hist_final(50), **_hist_sql(
    "SELECT CAST(overall_churn_risk AS DOUBLE) AS v FROM f_scored", 50)))
def q_histogram_risk_50(inp):
    return ranking.histogram(inp.scored, "overall_churn_risk", 50)


@register("histogram_days_to_first_sale", sql=with_ctes(_hist_final(30), **_hist_sql(
    "SELECT CAST(days_to_first_sale AS DOUBLE) AS v FROM f_nb WHERE never_activated = 0", 30)))
def q_histogram_days(inp):
    act = inp.notebook.filter(F.col("never_activated") == 0)
    return ranking.histogram(act, "days_to_first_sale", 30)


def _quantile_sql(values_sql: str, p: float) -> str:
    """numpy-linear quantile of the values (same interpolation as Spark's)."""
    return f"""
SELECT CASE WHEN t >= 0.5 THEN hi - (hi - lo) * (1.0 - t) ELSE lo + (hi - lo) * t END AS q FROM (
  SELECT max(CASE WHEN pos = fl THEN v END) AS lo, max(CASE WHEN pos = least(fl + 1, n - 1) THEN v END) AS hi,
    max(h - fl) AS t
  FROM (SELECT v, row_number() OVER (ORDER BY v) - 1 AS pos, count(*) OVER () AS n,
          CAST(count(*) OVER () - 1 AS DOUBLE) * {p!r} AS h,
          floor(CAST(count(*) OVER () - 1 AS DOUBLE) * {p!r}) AS fl
        FROM ({values_sql}) WHERE v IS NOT NULL))"""


TRIM_VALUES = "SELECT CAST(total_gmv AS DOUBLE) AS v FROM f_nb WHERE never_activated = 0"


@register("trimmed_gmv", sql=with_ctes(f"""
SELECT seller_id, total_gmv FROM f_nb CROSS JOIN ({_quantile_sql(TRIM_VALUES, 0.95)}) qq
WHERE never_activated = 0 AND total_gmv <= qq.q"""))
def q_trimmed_gmv(inp):
    act = inp.notebook.filter(F.col("never_activated") == 0)
    qq = ranking.exact_quantile(act, "total_gmv", 0.95, "_q95")
    return attach_scalars(act, qq).filter(F.col("total_gmv") <= F.col("_q95")).select("seller_id", "total_gmv")


@register("histogram_gmv", sql=with_ctes(_hist_final(30), **_hist_sql(f"""
SELECT CAST(total_gmv AS DOUBLE) AS v FROM f_nb CROSS JOIN ({_quantile_sql(TRIM_VALUES, 0.95)}) qq
WHERE never_activated = 0 AND total_gmv <= qq.q""", 30)))
def q_histogram_gmv(inp):
    return ranking.histogram(q_trimmed_gmv(inp), "total_gmv", 30)


DRIFT_CUT = "(SELECT max(won_date) - INTERVAL 365 DAY FROM f_scored)"


@register("score_drift", sql=with_ctes("""
SELECT g.bin, lo + g.bin * ((hi - lo) / CAST(30 AS DOUBLE)) AS bin_lower,
  coalesce(c.reference_count, 0) AS reference_count, coalesce(c.new_count, 0) AS new_count,
  CAST(coalesce(c.reference_count, 0) AS DOUBLE) / t.na AS reference_share,
  CAST(coalesce(c.new_count, 0) AS DOUBLE) / t.nb AS new_share,
  CAST(coalesce(c.new_count, 0) AS DOUBLE) / t.nb - CAST(coalesce(c.reference_count, 0) AS DOUBLE) / t.na
    AS share_change
FROM (SELECT CAST(range AS INTEGER) AS bin FROM range(30)) g CROSS JOIN st CROSS JOIN t
LEFT JOIN c ON g.bin = c.bin""",
    dv=f"SELECT CAST(overall_churn_risk AS DOUBLE) AS v, CASE WHEN won_date >= {DRIFT_CUT} THEN 1 ELSE 0 END AS side "
       "FROM f_scored",
    st0="SELECT min(v) AS lo0, max(v) AS hi0 FROM dv WHERE v IS NOT NULL AND NOT isnan(v)",
    st="SELECT CASE WHEN lo0 = hi0 THEN lo0 - 0.5 ELSE lo0 END AS lo, CASE WHEN lo0 = hi0 THEN hi0 + 0.5 ELSE hi0 END"
       " AS hi FROM st0",
    c="SELECT CASE WHEN b >= 30 THEN 29 ELSE b END AS bin, "
      "CAST(sum(CASE WHEN side = 0 THEN 1 ELSE 0 END) AS BIGINT) AS reference_count, "
      "CAST(sum(CASE WHEN side = 1 THEN 1 ELSE 0 END) AS BIGINT) AS new_count FROM "
      "(SELECT side, CAST(floor((v - lo) * (CAST(30 AS DOUBLE) / (hi - lo))) AS INTEGER) AS b "
      "FROM dv CROSS JOIN st WHERE v IS NOT NULL AND NOT isnan(v)) GROUP BY 1",
    t="SELECT CAST(sum(CASE WHEN side = 0 THEN 1 ELSE 0 END) AS BIGINT) AS na, "
      "CAST(sum(CASE WHEN side = 1 THEN 1 ELSE 0 END) AS BIGINT) AS nb FROM dv WHERE v IS NOT NULL AND NOT isnan(v)"))
def q_score_drift(inp):
    # one evaluation of the scored lineage: a two-column projection feeds the
    # cut date and both batches
    s = ranking.materialize(inp.scored.select("won_date", "overall_churn_risk"))
    cut = s.agg(F.timestamp_add("DAY", F.lit(-365), F.max("won_date")).alias("_cut"))
    tagged = attach_scalars(s, cut)
    ref = tagged.filter(F.col("won_date") < F.col("_cut"))
    new = tagged.filter(F.col("won_date") >= F.col("_cut"))
    return ranking.histogram_shift(ref, new, "overall_churn_risk", 30)

