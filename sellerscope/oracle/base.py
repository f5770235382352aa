"""DuckDB statement of the adapter, master and labels (the oracle side).

Every oracle query is ``WITH <these CTEs> <final select>``; DuckDB plans only
the CTEs a query references. CTE names carry an ``f_`` prefix so they do not
shadow the pre-registered test tables (``orders`` in particular).
"""

from __future__ import annotations

# --- fixed values, stated here once more: the oracle shares none with the code it checks ---
COMPLETED_STATUSES = ("delivered", "shipped", "approved", "invoiced")
CATEGORICAL_FILL = ("lead_behaviour_profile", "business_segment", "lead_type", "business_type", "origin", "seller_state")
NUMERIC_FILL = ("declared_monthly_revenue", "declared_product_catalog_size")
ACTIVITY_FILL = ("total_orders", "total_gmv", "unique_customers", "total_items_sold", "total_freight")
RISK_LABELS = ("Low", "Medium", "High", "Critical")
NOTEBOOK_RISK_LABELS = ("Low Risk", "Medium Risk", "High Risk", "Critical Risk")
REVENUE_LABELS = ("Zero", "Low (1-1K)", "Medium (1K-10K)", "High (>10K)")
LEAD_TYPES = ("online_big", "online_medium", "online_small", "offline", "industry",
              "online_top", "online_beginner", "other", None)
PROFILES = ("cat", "eagle", "wolf", "shark", "eagle, cat", None)
BUSINESS_TYPES = ("reseller", "manufacturer", None)
ACTIVATION_SPRINT = "URGENT: 30-day activation sprint - weekly check-ins needed"
CATALOG_WORKSHOP = "Monitor: Provide catalog-building workshop"
EARLY = "Early intervention: Marketing co-op + category optimization"
WIN_BACK = "Re-engagement: Win-back campaign + personalized outreach"
SUSTAIN = "Monitor: Proactive support to sustain momentum"
# -------------------------------------------------------------------------------------------


def days(a: str, b: str) -> str:
    """Floored whole days from a to b (same rule as functions.days_between)."""
    return f"CAST(floor(date_diff('microsecond', {a}, {b}) / 86400000000) AS BIGINT)"


def q(v) -> str:
    return "NULL" if v is None else "'" + str(v).replace("'", "''") + "'"


def pick(index: str, values) -> str:
    whens = " ".join(f"WHEN {i} THEN {q(v)}" for i, v in enumerate(values))
    return f"CAST(CASE {index} {whens} END AS VARCHAR)"


def in_list(values) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


def pct(num: str, den: str) -> str:
    return f"round_even(CAST({num} AS DOUBLE) / NULLIF(CAST({den} AS DOUBLE), 0) * 100, 1)"


def xsum(c: str) -> str:
    return f"CAST(sum(CAST({c} AS DECIMAL(20,2))) AS DOUBLE)"


def xstd(c: str) -> str:
    """Exact sample std in cents (same arithmetic as functions.exact_stddev_samp)."""
    cents = f"CAST(round(CAST({c} AS DECIMAL(18,2)) * 100, 0) AS HUGEINT)"
    num = f"CAST(count({c}) * sum({cents} * {cents}) - sum({cents}) * sum({cents}) AS DOUBLE)"
    return (f"CASE WHEN count({c}) > 1 THEN sqrt({num} / (CAST(count({c}) AS DOUBLE) * "
            f"CAST(count({c}) - 1 AS DOUBLE)) / 10000.0) END")


def dmean(c: str, scale: int = 6) -> str:
    """Order-independent mean (same arithmetic as functions.decimal_mean)."""
    return f"(CAST(sum(CAST(CAST({c} AS DOUBLE) AS DECIMAL(38,{scale}))) AS DOUBLE) / count(CAST({c} AS DOUBLE)))"


def xavg(c: str) -> str:
    return f"({xsum(c)} / count({c}))"


WON = ("(TIMESTAMP '1994-07-01 00:00:00' + to_days(CAST((k * 37) % 2000 AS INTEGER))"
       " + to_seconds(CAST((k * 7919) % 86400 AS BIGINT)))")

def risk_case(c: str, labels=RISK_LABELS) -> str:
    low, medium, high, critical = labels
    return (f"CASE WHEN {c} > 0.0::DOUBLE AND {c} <= 0.3::DOUBLE THEN '{low}' WHEN {c} > 0.3::DOUBLE AND {c} <= 0.6::DOUBLE THEN '{medium}' "
            f"WHEN {c} > 0.6::DOUBLE AND {c} <= 0.8::DOUBLE THEN '{high}' WHEN {c} > 0.8::DOUBLE AND {c} <= 1.0::DOUBLE THEN '{critical}' END")


def revenue_case(c: str) -> str:
    return (f"CASE WHEN {c} > -0.1::DOUBLE AND {c} <= 0 THEN 'Zero' WHEN {c} > 0 AND {c} <= 1000 THEN 'Low (1-1K)' "
            f"WHEN {c} > 1000 AND {c} <= 10000 THEN 'Medium (1K-10K)' WHEN {c} > 10000 THEN 'High (>10K)' END")


CTES = {
    "f_keys": """
SELECT p_partkey AS k, p_brand AS segment, CAST(p_retailprice AS DOUBLE) AS price, CAST(p_size AS DOUBLE) AS size FROM part
UNION ALL
SELECT c_custkey + 1000000000, c_mktsegment, CAST(abs(c_acctbal) AS DOUBLE), CAST(c_custkey % 50 + 1 AS DOUBLE) FROM customer""",
    "f_deals": f"""
SELECT k AS mql_id, k AS seller_id, {WON} AS won_date,
  CASE WHEN k % 50 = 0 THEN NULL WHEN k % 499 = 1 THEN 'NICHE_' || CAST(k % 5 AS VARCHAR) ELSE segment END AS business_segment,
  {pick('k % 9', LEAD_TYPES)} AS lead_type,
  {pick('(k // 9) % 6', PROFILES)} AS lead_behaviour_profile,
  {pick('k % 3', BUSINESS_TYPES)} AS business_type,
  CASE k % 4 WHEN 0 THEN NULL WHEN 1 THEN CAST(0 AS DOUBLE) WHEN 2 THEN price ELSE price * 12 END
    AS declared_monthly_revenue,
  CASE k % 5 WHEN 0 THEN NULL WHEN 1 THEN CAST(0 AS DOUBLE) ELSE size END
    AS declared_product_catalog_size,
  CASE k % 3 WHEN 0 THEN NULL WHEN 1 THEN TRUE ELSE FALSE END AS has_company,
  (k % 2 = 0) AS has_gtin
FROM f_keys""",
    "f_mqls": f"""
SELECT CASE WHEN k % 20 = 0 THEN -k ELSE k END AS mql_id,
  CASE WHEN k % 11 = 0 THEN NULL
       ELSE {WON} - to_days(CAST((k * 13) % 120 AS INTEGER)) END AS first_contact_date,
  'lp' || CAST(p_size AS VARCHAR) AS landing_page_id,
  CASE WHEN k % 17 = 0 THEN NULL ELSE p_type END AS origin
FROM (SELECT p_partkey AS k, p_size, p_type FROM part)""",
    "f_sellers": """
SELECT CASE WHEN p_partkey % 10 = 9 THEN -p_partkey ELSE p_partkey END AS seller_id,
  'CITY_' || CAST(p_size AS VARCHAR) AS seller_city, n_name AS seller_state
FROM part JOIN nation ON p_partkey % 25 = n_nationkey""",
    "f_orders": f"""
SELECT o_orderkey AS order_id, o_custkey AS customer_id,
  CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' WHEN 'P' THEN 'canceled' END AS order_status,
  CAST(o_orderdate AS TIMESTAMP) AS order_purchase_timestamp,
  CAST(NULL AS TIMESTAMP) AS order_delivered_customer_date
FROM orders""",
    "f_items": """
SELECT l_orderkey AS order_id, l_partkey AS seller_id,
  CASE WHEN l_partkey % 40 = 7 THEN 0.0 ELSE CAST(l_extendedprice AS DOUBLE) END AS price,
  CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(6,4)), 2) AS DOUBLE) AS freight_value
FROM lineitem""",
    "f_seller_master": f"""
SELECT d.*, m.first_contact_date, m.landing_page_id, m.origin,
  {days('m.first_contact_date', 'd.won_date')} AS sales_cycle_days,
  s.seller_city, s.seller_state
FROM f_deals d LEFT JOIN f_mqls m ON d.mql_id = m.mql_id
LEFT JOIN f_sellers s ON d.seller_id = s.seller_id""",
    "f_end": "SELECT max(order_purchase_timestamp) AS dataset_end_date FROM f_orders",
    "f_seller_orders": f"""
SELECT i.*, o.order_purchase_timestamp, o.order_status, o.customer_id
FROM f_items i JOIN f_orders o ON i.order_id = o.order_id
WHERE o.order_status IN {in_list(COMPLETED_STATUSES)}""",
    "f_activity0": f"""
SELECT seller_id,
  count(DISTINCT order_id) AS total_orders,
  count(DISTINCT customer_id) AS unique_customers,
  {xsum('price')} AS total_gmv,
  {xsum('price')} / count(price) AS avg_order_value,
  {xstd('price')} AS std_order_value,
  {xsum('freight_value')} AS total_freight,
  min(order_purchase_timestamp) AS first_sale_date,
  max(order_purchase_timestamp) AS last_sale_date,
  count(order_purchase_timestamp) AS total_items_sold
FROM f_seller_orders GROUP BY seller_id""",
    "f_activity": f"""
SELECT a.*, {days('a.first_sale_date', 'a.last_sale_date')} + 1 AS days_active,
  {days('a.last_sale_date', 'e.dataset_end_date')} AS days_since_last_sale,
  CAST(a.total_orders AS DOUBLE) / CAST(greatest({days('a.first_sale_date', 'a.last_sale_date')} + 1, 1) AS DOUBLE)
    AS avg_daily_orders
FROM f_activity0 a CROSS JOIN f_end e""",
    "f_joined": f"""
SELECT m.*, a.* EXCLUDE (seller_id), {days('m.won_date', 'a.first_sale_date')} AS days_to_first_sale
FROM f_seller_master m LEFT JOIN f_activity a ON m.seller_id = a.seller_id""",
    "f_master": f"""
SELECT * REPLACE (
  coalesce(total_orders, 0) AS total_orders,
  coalesce(total_gmv, 0) AS total_gmv,
  coalesce(unique_customers, 0) AS unique_customers,
  coalesce(total_items_sold, 0) AS total_items_sold,
  coalesce(total_freight, 0) AS total_freight,
  {', '.join(f"coalesce({c}, 'Unknown') AS {c}" for c in CATEGORICAL_FILL)},
  {', '.join(f"coalesce({c}, 0) AS {c}" for c in NUMERIC_FILL)})
FROM f_joined""",
    "f_na": """
SELECT *, CAST(total_orders = 0 OR coalesce(days_to_first_sale > 90, FALSE) AS INTEGER) AS never_activated
FROM f_master""",
    "f_labelled0": """
SELECT *,
  CAST(total_orders > 0 AND never_activated = 0 AND coalesce(days_since_last_sale > 60, FALSE) AS INTEGER) AS dormant,
  CAST(total_orders > 0 AND coalesce(days_since_last_sale <= 60, FALSE) AS INTEGER) AS active
FROM f_na""",
    "f_labelled": """
SELECT *, CAST(never_activated = 1 OR dormant = 1 AS INTEGER) AS churned FROM f_labelled0""",
    # notebook master: only orders and GMV filled, no categorical fills
    "f_nb_master0": """
SELECT * REPLACE (coalesce(total_orders, 0) AS total_orders, coalesce(total_gmv, 0) AS total_gmv)
FROM f_joined""",
    "f_nb_na": """
SELECT *, CAST(total_orders = 0 OR coalesce(days_to_first_sale > 90, FALSE) AS INTEGER) AS never_activated
FROM f_nb_master0""",
    "f_nb_labelled0": """
SELECT *,
  CAST(total_orders > 0 AND never_activated = 0 AND coalesce(days_since_last_sale > 60, FALSE) AS INTEGER) AS dormant,
  CAST(total_orders > 0 AND coalesce(days_since_last_sale <= 60, FALSE) AS INTEGER) AS active
FROM f_nb_na""",
    "f_nb": """
SELECT *, CAST(never_activated = 1 OR dormant = 1 AS INTEGER) AS churned FROM f_nb_labelled0""",
    # deterministic formula scores (stand-in for model output)
    "f_scored0": """
SELECT *,
  CAST((seller_id * 31) % 1000 AS DOUBLE) / CAST(1000 AS DOUBLE) AS never_activated_risk,
  CASE WHEN never_activated = 1 THEN NULL
       ELSE CAST(days_since_last_sale AS DOUBLE) / (CAST(days_since_last_sale AS DOUBLE) + CAST(60 AS DOUBLE))
  END AS dormancy_risk
FROM f_labelled""",
    "f_scored1": """
SELECT *, CASE WHEN dormancy_risk IS NULL THEN never_activated_risk
               ELSE greatest(never_activated_risk, dormancy_risk) END AS overall_churn_risk
FROM f_scored0""",
    "f_scored": f"SELECT *, {risk_case('overall_churn_risk')} AS risk_category FROM f_scored1",
    # notebook scoring: dormancy risk overrides, suffixed category labels
    "f_nb_scored0": """
SELECT *,
  CAST((seller_id * 31) % 1000 AS DOUBLE) / CAST(1000 AS DOUBLE) AS never_activated_risk,
  CASE WHEN never_activated = 1 THEN NULL
       ELSE CAST(days_since_last_sale AS DOUBLE) / (CAST(days_since_last_sale AS DOUBLE) + CAST(30 AS DOUBLE))
  END AS dormancy_risk
FROM f_nb""",
    "f_nb_scored1": "SELECT *, coalesce(dormancy_risk, never_activated_risk) AS overall_churn_risk FROM f_nb_scored0",
    "f_nb_scored": f"SELECT *, {risk_case('overall_churn_risk', NOTEBOOK_RISK_LABELS)} AS risk_category "
                   "FROM f_nb_scored1",
}


def with_ctes(final_sql: str, **extra: str) -> str:
    """``WITH <base CTEs>, <extra CTEs in order> <final_sql>``."""
    ctes = dict(CTES)
    ctes.update(extra)
    body = ",\n".join(f"{name} AS ({sql.strip()})" for name, sql in ctes.items())
    return f"WITH {body}\n{final_sql.strip()}"
