"""Registered queries: master, labels, cohorts."""

from __future__ import annotations

from sellerscope.operators import cohorts, labels, master
from sellerscope.oracle.base import with_ctes
from sellerscope.plans.catalog import register

MASTER_COLUMNS = (
    "seller_id", "mql_id", "won_date", "business_segment", "lead_type", "lead_behaviour_profile",
    "business_type", "declared_monthly_revenue", "declared_product_catalog_size", "has_company",
    "has_gtin", "first_contact_date", "landing_page_id", "origin", "sales_cycle_days",
    "seller_city", "seller_state", "total_orders", "unique_customers", "total_gmv",
    "avg_order_value", "std_order_value", "total_freight", "first_sale_date", "last_sale_date",
    "total_items_sold", "days_active", "days_since_last_sale", "avg_daily_orders",
    "days_to_first_sale",
)
LABEL_COLUMNS = ("never_activated", "dormant", "active", "churned")


def _cols(cols) -> str:
    return ", ".join(cols)


@register("cohort_analysis", sql=with_ctes(f"""
SELECT strftime(won_date, '%Y-%m') AS cohort_month,
  count(seller_id) AS total_sellers,
  CAST(sum(never_activated) AS BIGINT) AS never_activated,
  CAST(sum(dormant) AS BIGINT) AS dormant,
  CAST(sum(active) AS BIGINT) AS active,
  CAST(sum(churned) AS BIGINT) AS churned,
  CAST(sum(CAST(total_gmv AS DECIMAL(20,2))) AS DOUBLE) AS total_gmv,
  round_even(CAST(sum(churned) AS DOUBLE) / CAST(count(seller_id) AS DOUBLE) * 100, 1) AS churn_rate,
  round_even(CAST(count(seller_id) - sum(never_activated) AS DOUBLE) / CAST(count(seller_id) AS DOUBLE) * 100, 1)
    AS activation_rate
FROM f_labelled WHERE won_date IS NOT NULL GROUP BY 1 ORDER BY 1"""))
def q_cohort_analysis(inp):
    return cohorts.cohort_analysis(inp.labelled)


@register("seller_master", sql=with_ctes("SELECT * FROM f_seller_master"))
def q_seller_master(inp):
    return inp.seller_master


@register("seller_activity", sql=with_ctes("SELECT * FROM f_activity0"))
def q_seller_activity(inp):
    t = inp.tables
    return master.seller_activity(master.completed_items(t["order_items"], t["orders"]))


@register("activity_time_metrics", sql=with_ctes("SELECT * FROM f_activity"))
def q_activity_time_metrics(inp):
    return inp.activity


@register("join_activity", sql=with_ctes(f"SELECT {_cols(MASTER_COLUMNS)} FROM f_master"))
def q_join_activity(inp):
    return inp.master.select(*MASTER_COLUMNS)


@register("define_churn_labels", sql=with_ctes(
    f"SELECT seller_id, {_cols(LABEL_COLUMNS)} FROM f_labelled"))
def q_define_churn_labels(inp):
    return inp.labelled.select("seller_id", *LABEL_COLUMNS)


@register("status_summary", sql=with_ctes("""
SELECT count(*) AS total_sellers,
""" + ",\n".join(
    f"  CAST(sum({c}) AS BIGINT) AS {c}, round_even(CAST(sum({c}) AS DOUBLE) / CAST(count(*) AS DOUBLE) * 100, 1) AS {c}_pct"
    for c in LABEL_COLUMNS) + "\nFROM f_labelled"))
def q_status_summary(inp):
    return labels.status_summary(inp.labelled)


COHORT_RATES = """
SELECT strftime(won_date, '%Y-%m') AS m,
  round_even(CAST(sum(churned) AS DOUBLE) / CAST(count(seller_id) AS DOUBLE) * 100, 1) AS r
FROM f_labelled WHERE won_date IS NOT NULL GROUP BY 1"""


@register("cohort_extremes", sql=with_ctes("""
SELECT count(*) AS cohorts,
  CAST(sum(CAST(r AS DECIMAL(12,1))) AS DOUBLE) / count(r) AS avg_churn_rate,
  arg_min(m, (r, m)) AS best_cohort, min(r) AS best_churn_rate,
  arg_min(m, (-r, m)) AS worst_cohort, max(r) AS worst_churn_rate
FROM c""", c=COHORT_RATES))
def q_cohort_extremes(inp):
    return cohorts.cohort_extremes(cohorts.cohort_analysis(inp.labelled))

