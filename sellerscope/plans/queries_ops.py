"""Registered queries: sources, projections, fills, flags, joins, scalar
functions (SURVEY 2.1, 2.2, 2.3, 2.8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sellerscope import config as C
from sellerscope import functions as X
from sellerscope.operators import cohorts, interventions, master, segments
from sellerscope.operators.scalars import attach_scalars
from sellerscope.oracle import base as O
from sellerscope.oracle.base import days, pct, q, revenue_case, risk_case, with_ctes, xstd
from sellerscope.plans.catalog import register
from sellerscope.sources import registry, sinks
from sellerscope.sources import schemas as S

# ---------------------------------------------------------------- 2.1 sources


@register("src_tables", sql=with_ctes("""
SELECT 'deals' AS table_name, count(*) AS row_count FROM f_deals
UNION ALL SELECT 'mqls', count(*) FROM f_mqls
UNION ALL SELECT 'sellers', count(*) FROM f_sellers
UNION ALL SELECT 'orders', count(*) FROM f_orders
UNION ALL SELECT 'order_items', count(*) FROM f_items"""))
def q_src_tables(inp):
    return registry.row_counts(inp.tables)


@register("src_optional", sql="""
SELECT 'orders' AS table_name, count(*) AS row_count FROM orders
UNION ALL SELECT 'reviews', 0""")
def q_src_optional(inp):
    present = registry.safe_read(inp.spark, f"{inp.sf_dir}/orders.parquet")
    missing = registry.safe_read(inp.spark, f"{inp.sf_dir}/reviews.parquet", S.ORDERS)
    return registry.row_counts({"orders": present, "reviews": missing})


@register("parse_dates", sql=with_ctes("""
SELECT order_id, order_purchase_timestamp, order_delivered_customer_date FROM f_orders"""))
def q_parse_dates(inp):
    # dates arrive as text (as from a CSV extract) and are parsed
    o = inp.tables["orders"]
    text = o.select("order_id",
                    F.date_format("order_purchase_timestamp", "yyyy-MM-dd HH:mm:ss").alias("order_purchase_timestamp"),
                    F.col("order_delivered_customer_date").cast("string").alias("order_delivered_customer_date"))
    return registry.parse_dates({"orders": text})["orders"]


PROFILE_COLS = ("business_segment", "lead_type", "lead_behaviour_profile", "business_type",
                "declared_monthly_revenue", "declared_product_catalog_size", "has_company",
                "first_contact_date", "landing_page_id", "origin", "sales_cycle_days", "seller_city",
                "seller_state")


@register("profile_table", sql=with_ctes(
    "SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count FROM f_seller_master"
        for c in PROFILE_COLS) + ") WHERE null_count > 0"))
def q_profile_table(inp):
    from sellerscope.operators.profile import null_counts
    return null_counts(inp.seller_master, PROFILE_COLS)


@register("profile_dates", sql=with_ctes("""
SELECT min(won_date) AS won_date_min, max(won_date) AS won_date_max,
  min(first_contact_date) AS first_contact_date_min, max(first_contact_date) AS first_contact_date_max
FROM f_seller_master"""))
def q_profile_dates(inp):
    from sellerscope.operators.profile import date_ranges
    return date_ranges(inp.seller_master, ("won_date", "first_contact_date"))


@register("sink_csv", sql=with_ctes("""
SELECT cohort_month, total_sellers, churn_rate FROM (
SELECT strftime(won_date, '%Y-%m') AS cohort_month, count(seller_id) AS total_sellers,
  round_even(CAST(sum(churned) AS DOUBLE) / CAST(count(seller_id) AS DOUBLE) * 100, 1) AS churn_rate
FROM f_labelled WHERE won_date IS NOT NULL GROUP BY 1)"""))
def q_sink_csv(inp):
    from sellerscope.session import scratch_path
    out = cohorts.cohort_analysis(inp.labelled).select("cohort_month", "total_sellers", "churn_rate")
    path = scratch_path(inp.spark, "cohort_csv")
    sinks.write_table(out, path, "csv")
    return sinks.read_back(inp.spark, path, "csv", out.schema)


@register("sink_scores", sql=with_ctes(
    "SELECT " + ", ".join(C.SCORE_COLUMNS) + " FROM f_scored"))
def q_sink_scores(inp):
    return sinks.project_available(inp.scored, C.SCORE_COLUMNS)


# ------------------------------------------------- 2.2 projections / predicates

PROJECTED = [c for c in C.INTERVENTION_COLUMNS if c not in ("priority_score", "urgency")]


@register("project_available", sql=with_ctes("SELECT " + ", ".join(PROJECTED) + " FROM f_scored"))
def q_project_available(inp):
    return sinks.project_available(inp.scored, C.INTERVENTION_COLUMNS)


@register("completed_items", sql=with_ctes("SELECT * FROM f_seller_orders"))
def q_completed_items(inp):
    t = inp.tables
    return master.completed_items(t["order_items"], t["orders"])


@register("fill_categorical", sql=with_ctes(
    "SELECT seller_id, " + ", ".join(f"coalesce({c}, 'Unknown') AS {c}" for c in O.CATEGORICAL_FILL)
    + " FROM f_seller_master"))
def q_fill_categorical(inp):
    return master.fill_categorical(inp.seller_master).select("seller_id", *C.CATEGORICAL_FILL_COLUMNS)


@register("missing_value_report", sql=with_ctes(
    "SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS missing FROM f_joined"
        for c in O.CATEGORICAL_FILL + O.NUMERIC_FILL) + ") WHERE missing > 0"))
def q_missing_value_report(inp):
    return master.missing_value_report(master.join_activity(inp.seller_master, inp.activity))


@register("fill_numeric", sql=with_ctes(
    "SELECT seller_id, " + ", ".join(f"coalesce({c}, 0) AS {c}" for c in O.NUMERIC_FILL)
    + " FROM f_seller_master"))
def q_fill_numeric(inp):
    return master.fill_numeric(inp.seller_master).select("seller_id", *C.NUMERIC_FILL_COLUMNS)


@register("fill_activity", sql=with_ctes(
    "SELECT seller_id, " + ", ".join(O.ACTIVITY_FILL) + ", first_sale_date, days_since_last_sale "
    "FROM f_master"))
def q_fill_activity(inp):
    return inp.master.select("seller_id", *C.ACTIVITY_FILL_COLUMNS, "first_sale_date", "days_since_last_sale")


RAW_RATIO = ("CASE WHEN total_gmv = 0 THEN (CASE WHEN total_freight > 0 THEN 'inf'::DOUBLE "
             "WHEN total_freight < 0 THEN '-inf'::DOUBLE ELSE 'nan'::DOUBLE END) "
             "ELSE total_freight / total_gmv END")


@register("replace_inf", sql=with_ctes(f"""
SELECT seller_id, CASE WHEN isnan(r) OR isinf(r) THEN 0.0 ELSE r END AS freight_ratio_clean
FROM (SELECT seller_id, CAST({RAW_RATIO} AS DOUBLE) AS r FROM f_master)"""))
def q_replace_inf(inp):
    from sellerscope.operators.profile import pandas_divide
    r = pandas_divide(F.col("total_freight"), F.col("total_gmv"))
    clean = X.replace_inf(F.nanvl(r, F.lit(0.0)))
    return inp.master.select("seller_id", clean.alias("freight_ratio_clean"))


@register("bool_to_flag", sql=with_ctes("""
SELECT seller_id,
  CASE WHEN has_company THEN 1 ELSE 0 END AS has_company_binary,
  CASE WHEN has_gtin THEN 1 ELSE 0 END AS has_gtin_binary
FROM f_deals"""))
def q_bool_to_flag(inp):
    d = inp.tables["deals"]
    return d.select("seller_id", X.bool_to_flag("has_company").alias("has_company_binary"),
                    X.bool_to_flag("has_gtin").alias("has_gtin_binary"))


@register("zero_flags", sql=with_ctes("""
SELECT seller_id,
  CAST(declared_monthly_revenue = 0 AS INTEGER) AS declared_revenue_zero,
  CAST(declared_product_catalog_size = 0 AS INTEGER) AS declared_catalog_zero
FROM f_master"""))
def q_zero_flags(inp):
    m = inp.master
    return m.select("seller_id", (F.col("declared_monthly_revenue") == 0).cast("int").alias("declared_revenue_zero"),
                    (F.col("declared_product_catalog_size") == 0).cast("int").alias("declared_catalog_zero"))


for _flag in ("never_activated", "dormant", "active", "churned"):
    def _mk(flag):
        @register(f"label_{flag}", sql=with_ctes(f"SELECT seller_id, {flag} FROM f_labelled"))
        def _q(inp):
            return inp.labelled.select("seller_id", flag)
        return _q
    _mk(_flag)


@register("activation_speed_score", sql=with_ctes("""
SELECT seller_id, CASE WHEN days_to_first_sale <= 7 THEN 3 WHEN days_to_first_sale <= 30 THEN 2 ELSE 1 END
  AS activation_speed_score FROM f_master"""))
def q_activation_speed_score(inp):
    return inp.master.select("seller_id", X.activation_speed_score("days_to_first_sale").alias("activation_speed_score"))


@register("risk_category", sql=with_ctes("SELECT seller_id, overall_churn_risk, risk_category FROM f_scored"))
def q_risk_category(inp):
    return inp.scored.select("seller_id", "overall_churn_risk", "risk_category")


@register("revenue_band", sql=with_ctes(
    f"SELECT seller_id, {revenue_case('declared_monthly_revenue')} AS declared_revenue_category FROM f_nb"))
def q_revenue_band(inp):
    return inp.notebook.select("seller_id", X.revenue_band("declared_monthly_revenue").alias("declared_revenue_category"))


@register("overall_risk_max", sql=with_ctes(
    "SELECT seller_id, never_activated_risk, dormancy_risk, overall_churn_risk FROM f_scored"))
def q_overall_risk_max(inp):
    return inp.scored.select("seller_id", "never_activated_risk", "dormancy_risk", "overall_churn_risk")


@register("overall_risk_override", sql=with_ctes(
    f"SELECT seller_id, overall_churn_risk, "
    f"{risk_case('overall_churn_risk', O.NOTEBOOK_RISK_LABELS)} AS risk_category FROM f_nb_scored1"))
def q_overall_risk_override(inp):
    return inp.notebook_scored.select("seller_id", "overall_churn_risk", "risk_category")


URGENCY_SQL = ("CASE WHEN 60 - days_since_last_sale <= 7 THEN 'Immediate' "
               "WHEN 60 - days_since_last_sale <= 14 THEN 'High' "
               "WHEN 60 - days_since_last_sale <= 30 THEN 'Medium' ELSE 'Low' END")


@register("urgency", sql=with_ctes(f"""
SELECT seller_id, 60 - days_since_last_sale AS days_until_dormant, {URGENCY_SQL} AS urgency FROM f_labelled"""))
def q_urgency(inp):
    d = inp.params.dormant_days
    return inp.labelled.select("seller_id", (F.lit(d) - F.col("days_since_last_sale")).alias("days_until_dormant"),
                               X.urgency("days_since_last_sale", d).alias("urgency"))


POTENTIAL_SQL = ("CASE WHEN coalesce(total_gmv > 0, FALSE) THEN CAST(total_gmv AS DOUBLE) "
                 "ELSE CAST(declared_monthly_revenue AS DOUBLE) * 12 END")


@register("potential_value", sql=with_ctes(f"SELECT seller_id, {POTENTIAL_SQL} AS potential_value FROM f_nb"))
def q_potential_value(inp):
    return inp.notebook.select("seller_id",
                               X.potential_value("total_gmv", "declared_monthly_revenue").alias("potential_value"))


ACTION_SQL = (
    "CASE WHEN never_activated = 1 AND (coalesce(days_to_first_sale > 30, FALSE) OR days_to_first_sale IS NULL) "
    f"THEN {q(O.ACTIVATION_SPRINT)} WHEN never_activated = 1 THEN {q(O.CATALOG_WORKSHOP)} "
    f"WHEN coalesce(total_orders < 5, FALSE) THEN {q(O.EARLY)} "
    f"WHEN coalesce(days_since_last_sale > 30, FALSE) THEN {q(O.WIN_BACK)} ELSE {q(O.SUSTAIN)} END")


@register("recommended_action", sql=with_ctes(f"SELECT seller_id, {ACTION_SQL} AS recommended_action FROM f_nb"))
def q_recommended_action(inp):
    return inp.notebook.select("seller_id", X.recommended_action(
        "never_activated", "days_to_first_sale", "total_orders", "days_since_last_sale").alias("recommended_action"))


@register("at_risk_active", sql=with_ctes("""
SELECT seller_id, overall_churn_risk, risk_category, total_gmv FROM f_scored
WHERE risk_category IN ('High', 'Critical') AND active = 1"""))
def q_at_risk_active(inp):
    return interventions.at_risk_active_sellers(inp.scored).select(
        "seller_id", "overall_churn_risk", "risk_category", "total_gmv")


@register("at_risk_not_churned", sql=with_ctes("""
SELECT seller_id, overall_churn_risk, churned FROM f_nb_scored WHERE overall_churn_risk > 0.6 AND churned = 0"""))
def q_at_risk_not_churned(inp):
    return interventions.at_risk_not_churned(inp.notebook_scored).select("seller_id", "overall_churn_risk", "churned")


COHORT_SQL = """
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
FROM f_labelled WHERE won_date IS NOT NULL GROUP BY 1"""


#: a cut-off inside the test tables' range of dates
CUTOFF = "1998-01"


@register("complete_cohorts", sql=with_ctes("SELECT * FROM c WHERE cohort_month < '1998-01'", c=COHORT_SQL))
def q_complete_cohorts(inp):
    return cohorts.complete_cohorts(cohorts.cohort_analysis(inp.labelled), CUTOFF)


def _segment_sql(col: str, source: str = "f_labelled") -> str:
    """Oracle of the generic segment table."""
    return f"""
SELECT Segment, Total_Sellers, Churned, Never_Activated, Active, Avg_GMV, Total_GMV,
  {pct('Churned', 'Total_Sellers')} AS "Churn_Rate_%",
  {pct('Total_Sellers', 'sum(Total_Sellers) OVER ()')} AS "Market_Share_%"
FROM (SELECT coalesce(CAST({col} AS VARCHAR), 'Unknown') AS Segment, count(seller_id) AS Total_Sellers,
        CAST(sum(churned) AS BIGINT) AS Churned, CAST(sum(never_activated) AS BIGINT) AS Never_Activated,
        CAST(sum(active) AS BIGINT) AS Active,
        CAST(sum(CAST(total_gmv AS DECIMAL(20,2))) AS DOUBLE) / count(total_gmv) AS Avg_GMV,
        CAST(sum(CAST(total_gmv AS DECIMAL(20,2))) AS DOUBLE) AS Total_GMV
      FROM {source} GROUP BY 1)"""


@register("single_profile_segments", sql=with_ctes(
    "SELECT * FROM s WHERE NOT coalesce(contains(Segment, ','), FALSE)", s=_segment_sql("lead_behaviour_profile")))
def q_single_profile_segments(inp):
    t = segments.segment_analysis(inp.labelled, "lead_behaviour_profile")
    return t.filter(~F.coalesce(F.col("Segment").contains(","), F.lit(False)))


@register("known_segments", sql=with_ctes(
    "SELECT * FROM s WHERE Segment <> 'Unknown'", s=_segment_sql("seller_state")))
def q_known_segments(inp):
    return segments.segment_analysis(inp.labelled, "seller_state").filter(F.col("Segment") != C.UNKNOWN)


# ------------------------------------------------------------------ 2.3 joins


@register("join_deals_leads", sql=with_ctes(f"""
SELECT d.*, m.first_contact_date, m.landing_page_id, m.origin,
  {days('m.first_contact_date', 'd.won_date')} AS sales_cycle_days
FROM f_deals d LEFT JOIN f_mqls m ON d.mql_id = m.mql_id"""))
def q_join_deals_leads(inp):
    return master.join_deals_leads(inp.tables["deals"], inp.tables["mqls"])


@register("join_geo", sql=with_ctes("""
SELECT d.*, s.seller_city, s.seller_state FROM f_deals d LEFT JOIN f_sellers s ON d.seller_id = s.seller_id"""))
def q_join_geo(inp):
    return master.join_geo(inp.tables["deals"], inp.tables["sellers"])


@register("join_items_orders", sql=with_ctes("""
SELECT i.*, o.order_purchase_timestamp, o.order_status, o.customer_id
FROM f_items i JOIN f_orders o ON i.order_id = o.order_id"""))
def q_join_items_orders(inp):
    return master.join_items_orders(inp.tables["order_items"], inp.tables["orders"])


@register("attach_dormancy_risk", sql=with_ctes("""
SELECT m.seller_id, s.dormancy_risk FROM f_labelled m LEFT JOIN
  (SELECT seller_id, CAST(days_since_last_sale AS DOUBLE) / (CAST(days_since_last_sale AS DOUBLE) + CAST(60 AS DOUBLE))
     AS dormancy_risk FROM f_labelled WHERE never_activated = 0) s ON m.seller_id = s.seller_id"""))
def q_attach_dormancy_risk(inp):
    from sellerscope.plans.scoring import attach_dormancy_risk
    lab = inp.labelled
    d = F.col("days_since_last_sale").cast("double")
    subset = lab.filter(F.col("never_activated") == 0).select(
        "seller_id", (d / (d + F.lit(float(inp.params.dormant_days)))).alias("dormancy_risk"))
    return attach_dormancy_risk(lab, subset).select("seller_id", "dormancy_risk")


@register("end_date_scalar", sql=with_ctes("SELECT * FROM f_end"))
def q_end_date_scalar(inp):
    return master.dataset_end_date(inp.tables["orders"])


@register("seller_activity_supplier", sql=with_ctes(f"""
SELECT seller_id, count(DISTINCT order_id) AS total_orders, count(DISTINCT customer_id) AS unique_customers,
  CAST(sum(CAST(price AS DECIMAL(18,2))) AS DOUBLE) AS total_gmv,
  CAST(sum(CAST(price AS DECIMAL(18,2))) AS DOUBLE) / count(price) AS avg_order_value,
  {xstd('price')} AS std_order_value,
  CAST(sum(CAST(freight_value AS DECIMAL(18,2))) AS DOUBLE) AS total_freight,
  min(order_purchase_timestamp) AS first_sale_date, max(order_purchase_timestamp) AS last_sale_date,
  count(order_purchase_timestamp) AS total_items_sold
FROM (SELECT i.*, o.order_purchase_timestamp, o.customer_id
      FROM (SELECT l_orderkey AS order_id, l_suppkey AS seller_id, CAST(l_extendedprice AS DOUBLE) AS price,
              CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(6,4)), 2) AS DOUBLE)
                AS freight_value FROM lineitem) i
      JOIN f_orders o ON i.order_id = o.order_id
      WHERE o.order_status IN ('delivered', 'shipped', 'approved', 'invoiced'))
GROUP BY seller_id"""))
def q_seller_activity_supplier(inp):
    from sellerscope.sources import fixture
    items = fixture.order_items_by_supplier(inp.spark, inp.sf_dir)
    return master.seller_activity(master.completed_items(items, inp.tables["orders"]))


# ------------------------------------------------------- 2.8 scalar functions


@register("fn_days_between", sql=with_ctes(f"""
SELECT seller_id, {days('won_date', 'first_sale_date')} AS days_to_first_sale,
  {days('first_contact_date', 'won_date')} AS sales_cycle_days FROM f_joined"""))
def q_fn_days_between(inp):
    m = master.join_activity(inp.seller_master, inp.activity)
    return m.select("seller_id", X.days_between("won_date", "first_sale_date").alias("days_to_first_sale"),
                    X.days_between("first_contact_date", "won_date").alias("sales_cycle_days"))


@register("fn_month", sql=with_ctes("SELECT seller_id, strftime(won_date, '%Y-%m') AS cohort_month FROM f_deals"))
def q_fn_month(inp):
    return inp.tables["deals"].select("seller_id", X.month_key("won_date").alias("cohort_month"))


@register("fn_clip_low", sql=with_ctes("""
SELECT seller_id, CASE WHEN days_active IS NULL THEN NULL ELSE greatest(days_active, 1) END AS days_active_clipped,
  greatest(total_orders, 1) AS orders_clipped
FROM f_master"""))
def q_fn_clip_low(inp):
    return inp.master.select("seller_id", X.clip_low("days_active").alias("days_active_clipped"),
                             X.clip_low("total_orders").alias("orders_clipped"))


@register("fn_round1", sql=with_ctes(f"""
SELECT strftime(won_date, '%Y') AS cohort_year,
  {pct('sum(churned)', 'count(*)')} AS churn_rate,
  {pct('sum(active)', 'count(*)')} AS active_rate FROM f_labelled GROUP BY 1"""))
def q_fn_round1(inp):
    lab = inp.labelled
    return lab.groupBy(F.date_format("won_date", "yyyy").alias("cohort_year")).agg(
        X.pct(F.sum("churned"), F.count(F.lit(1))).alias("churn_rate"),
        X.pct(F.sum("active"), F.count(F.lit(1))).alias("active_rate"))


@register("fn_ratio_features", sql=with_ctes("""
SELECT seller_id,
  CAST(total_gmv AS DOUBLE) / CAST(greatest(total_orders, 1) AS DOUBLE) AS gmv_per_order,
  CAST(unique_customers AS DOUBLE) / CAST(greatest(total_orders, 1) AS DOUBLE) AS customers_per_order,
  CAST(total_freight AS DOUBLE) / CAST(greatest(total_gmv, 1) AS DOUBLE) AS freight_ratio
FROM f_master"""))
def q_fn_ratio_features(inp):
    return inp.master.select("seller_id", X.safe_ratio("total_gmv", "total_orders").alias("gmv_per_order"),
                             X.safe_ratio("unique_customers", "total_orders").alias("customers_per_order"),
                             X.safe_ratio("total_freight", "total_gmv").alias("freight_ratio"))


@register("fn_currency", sql=with_ctes("""
SELECT seller_id, 'R$ ' || translate(format('{:,.2f}', total_gmv), ',.', '.,') AS gmv_brl FROM f_master"""))
def q_fn_currency(inp):
    return inp.master.select("seller_id", X.currency_brl("total_gmv").alias("gmv_brl"))


@register("fn_short_id", sql=with_ctes(
    "SELECT seller_id, substr(CAST(seller_id AS VARCHAR), 1, 8) || '…' AS seller_id_short FROM f_deals"))
def q_fn_short_id(inp):
    return inp.tables["deals"].select("seller_id", X.short_id("seller_id").alias("seller_id_short"))


PRETTY_SQL = ("array_to_string(list_transform(string_split(replace(replace({c}, '_encoded', ''), '_', ' '), ' '), "
              "lambda w: upper(w[1]) || lower(w[2:])), ' ')")


@register("fn_pretty_name", sql=with_ctes(
    "SELECT seller_id, " + PRETTY_SQL.format(c="lead_type") + " AS lead_type_name, "
    + PRETTY_SQL.format(c="lead_behaviour_profile") + " AS profile_name FROM f_deals"))
def q_fn_pretty_name(inp):
    d = inp.tables["deals"]
    return d.select("seller_id", X.pretty_feature_name("lead_type").alias("lead_type_name"),
                    X.pretty_feature_name("lead_behaviour_profile").alias("profile_name"))


# ------------------------------------------------------- loader on CSV extracts

_PLAIN = ("part", "customer", "supplier", "nation", "region")
_CLEAN = {"mqls": ("f_mqls", "FALSE"), "deals": ("f_deals", "FALSE"), "sellers": ("f_sellers", "seller_id % 40 = 3"),
          "orders": ("f_orders", "order_id % 50 = 7"), "order_items": ("f_items", "FALSE")}


@register("load_quarantine", sql=with_ctes(" UNION ALL ".join(
    [f"SELECT '{n}' AS table_name, count(*) FILTER (WHERE NOT ({bad})) AS clean_rows, count(*) FILTER (WHERE {bad}) AS quarantined_rows, "
     f"{'NULL' if bad == 'FALSE' else q('record' if n == 'sellers' else 'order_purchase_timestamp')} AS reason FROM {t}"
     for n, (t, bad) in _CLEAN.items()]
    + [f"SELECT '{n}', count(*), 0, NULL FROM {t}" for n, t in zip(("products", "customers", "reviews", "payments", "translation"), _PLAIN)])))
def q_load_quarantine(inp):
    """Ten CSV extracts through the loader: clean and quarantined rows by table. Some orders have a purchase
    time that is none, and some sellers' records one value too many."""
    from sellerscope.session import scratch_path
    from sellerscope.sources import registry, schemas
    root = scratch_path(inp.spark, "extracts")
    tables = dict(inp.tables)
    late = F.col("order_id") % 50 == 7
    tables["orders"] = tables["orders"].withColumn(
        "order_purchase_timestamp", F.when(late, F.lit("soon")).otherwise(F.col("order_purchase_timestamp").cast("string")))
    tables["sellers"] = tables["sellers"].withColumn(
        "seller_state", F.when(F.col("seller_id") % 40 == 3, F.concat_ws(",", F.col("seller_state"), F.lit("x"))).otherwise(F.col("seller_state")))
    for name, table in zip(("products", "customers", "reviews", "payments", "translation"), _PLAIN):
        df = inp.spark.read.parquet(f"{inp.sf_dir}/{table}.parquet")
        tables[name] = df.select(F.col(df.columns[0]).alias("key"))
    for name, (stem, _) in schemas.TABLES.items():
        # without quotes a comma in a value is one more value
        tables[name].write.option("header", True).option("quote", "\u0000" if name == "sellers" else '"').csv(f"{root}/{stem}.csv")
    loader = registry.TableRegistry(inp.spark, root)
    data = loader.load_all(set_aside=True)
    out = None
    for name in data:
        clean = data[name].agg(F.count(F.lit(1)).alias("clean_rows"))
        gone = loader.quarantined[name].agg(F.count("record").alias("quarantined_rows"), F.max(F.element_at("reasons", 1)).alias("reason"))
        one = attach_scalars(clean, gone).select(F.lit(name).alias("table_name"), "*")
        out = one if out is None else out.unionByName(one)
    return out
