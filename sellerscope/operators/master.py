"""Seller master table: funnel joins, order activity, fills.

Partitioning: the funnel joins shuffle on ``mql_id`` then ``seller_id``;
one line of every (seller, order) is marked where the join on the order left
the rows; activity is aggregated per (seller, customer), then per seller, partially before each
shuffle (so a seller holding a third of all items is spread by customer) and
joined back on ``seller_id``, so the final join reuses its partitioning. The only large-large join is items x orders on
``order_id`` (sort-merge; AQE splits a skewed order key).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sellerscope import config as C
from sellerscope.functions import days_between, money, stddev_from_sums
from sellerscope.operators.scalars import attach_scalars

LEAD_COLUMNS = ("mql_id", "first_contact_date", "landing_page_id", "origin")
GEO_COLUMNS = ("seller_id", "seller_city", "seller_state")
ORDER_COLUMNS = ("order_id", "order_purchase_timestamp", "order_status", "customer_id")


def join_deals_leads(deals: DataFrame, mqls: DataFrame) -> DataFrame:
    """deals LEFT JOIN leads on mql_id (4 lead columns) + sales_cycle_days."""
    leads = mqls.select(*[c for c in LEAD_COLUMNS if c in mqls.columns])
    out = deals.join(leads, "mql_id", "left")
    return out.withColumn("sales_cycle_days", days_between("first_contact_date", "won_date"))


def join_geo(master: DataFrame, sellers: DataFrame) -> DataFrame:
    """master LEFT JOIN sellers on seller_id (city, state)."""
    return master.join(sellers.select(*GEO_COLUMNS), "seller_id", "left")


def seller_master(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per closed deal with lead and location attributes."""
    return join_geo(join_deals_leads(tables["deals"], tables["mqls"]), tables["sellers"])


def completed_items(order_items: DataFrame, orders: DataFrame,
                    statuses=C.COMPLETED_STATUSES) -> DataFrame:
    """Items joined to their order, completed orders only.

    The status filter is stated on ``orders`` so it reaches the orders scan
    before the join (same result as filtering the join output).
    """
    o = orders.select(*ORDER_COLUMNS).filter(F.col("order_status").isin(*statuses))
    return order_items.join(o, "order_id", "inner")


def join_items_orders(order_items: DataFrame, orders: DataFrame) -> DataFrame:
    """Items INNER JOIN orders on order_id (no status filter)."""
    return order_items.join(orders.select(*ORDER_COLUMNS), "order_id", "inner")


def dataset_end_date(orders: DataFrame) -> DataFrame:
    """One row: the latest purchase over all orders, any status."""
    return orders.agg(F.max("order_purchase_timestamp").alias("dataset_end_date"))


def seller_activity(seller_orders: DataFrame) -> DataFrame:
    """Per seller: distinct orders and customers, GMV sum/mean/std, freight,
    first/last purchase and item count.

    Two levels, each adding up the one below: (seller, customer), seller. A window beside the join on the order, which
    needs no shuffle after it, marks one line of every order of a seller; the distinct counts are counts of such lines and of
    rows, so no line is multiplied for them and no set is gathered.
    """
    cents = F.round(F.col("price").cast("decimal(18,2)") * 100, 0).cast("decimal(19,0)")
    sums = ["price_sum", "squares", "prices", "freight", "items"]
    nth = F.row_number().over(Window.partitionBy("seller_id", "order_id").orderBy("customer_id"))
    customers = seller_orders.withColumn("_nth", nth).groupBy("seller_id", "customer_id").agg(
        F.count(F.when(F.col("_nth") == 1, F.col("order_id"))).alias("orders"),
        F.sum(money("price")).alias("price_sum"),
        F.sum((cents * cents).cast("decimal(38,0)")).alias("squares"),
        F.count("price").alias("prices"),
        F.sum(money("freight_value")).alias("freight"),
        F.count("order_purchase_timestamp").alias("items"),
        F.min("order_purchase_timestamp").alias("first_sale_date"),
        F.max("order_purchase_timestamp").alias("last_sale_date"),
    )
    total = {c: F.sum(c) for c in sums}
    return customers.groupBy("seller_id").agg(
        F.sum("orders").alias("total_orders"),
        F.count("customer_id").alias("unique_customers"),
        total["price_sum"].cast("double").alias("total_gmv"),
        (total["price_sum"].cast("double") / F.nullif(total["prices"], F.lit(0))).alias("avg_order_value"),
        stddev_from_sums(total["prices"], total["price_sum"] * 100, total["squares"]).alias("std_order_value"),
        total["freight"].cast("double").alias("total_freight"),
        F.min("first_sale_date").alias("first_sale_date"),
        F.max("last_sale_date").alias("last_sale_date"),
        F.coalesce(total["items"], F.lit(0)).cast("long").alias("total_items_sold"),
    )


def activity_time_metrics(activity: DataFrame, end_date: DataFrame) -> DataFrame:
    """days_active, days_since_last_sale (against the one-row end date, a
    broadcast nested-loop join with a single row) and avg_daily_orders."""
    out = attach_scalars(activity, end_date)
    days_active = days_between("first_sale_date", "last_sale_date") + 1
    out = out.withColumns({
        "days_active": days_active,
        "days_since_last_sale": days_between("last_sale_date", "dataset_end_date"),
    })
    out = out.withColumn(
        "avg_daily_orders",
        F.col("total_orders").cast("double") / F.greatest(F.col("days_active"), F.lit(1)).cast("double"))
    return out.drop("dataset_end_date")


def seller_activity_metrics(order_items: DataFrame, orders: DataFrame,
                            statuses=C.COMPLETED_STATUSES) -> DataFrame:
    """Completed items -> per-seller activity with time metrics."""
    act = seller_activity(completed_items(order_items, orders, statuses))
    return activity_time_metrics(act, dataset_end_date(orders))


def fill_activity(df: DataFrame) -> DataFrame:
    """Sellers without a completed sale: the five count/sum metrics -> 0."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(0).cast(df.schema[c].dataType))
                           for c in C.ACTIVITY_FILL_COLUMNS if c in df.columns})


def join_activity(master: DataFrame, activity: DataFrame) -> DataFrame:
    """master LEFT JOIN activity on seller_id, fills, days_to_first_sale."""
    out = fill_activity(master.join(activity, "seller_id", "left"))
    return out.withColumn("days_to_first_sale", days_between("won_date", "first_sale_date"))


def fill_categorical(df: DataFrame, columns=C.CATEGORICAL_FILL_COLUMNS,
                     value: str = C.UNKNOWN) -> DataFrame:
    cols = [c for c in columns if c in df.columns]
    return df.fillna(value, subset=cols) if cols else df


def fill_numeric(df: DataFrame, columns=C.NUMERIC_FILL_COLUMNS) -> DataFrame:
    cols = [c for c in columns if c in df.columns]
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(0).cast(df.schema[c].dataType))
                           for c in cols}) if cols else df


def handle_missing_values(df: DataFrame) -> DataFrame:
    """Categoricals -> 'Unknown', declared revenue / catalog size -> 0."""
    return fill_numeric(fill_categorical(df))


def missing_value_report(df: DataFrame, columns=C.CATEGORICAL_FILL_COLUMNS + C.NUMERIC_FILL_COLUMNS) -> DataFrame:
    """(column_name, missing) for the fill columns with missing > 0, one pass."""
    cols = [c for c in columns if c in df.columns]
    counts = df.agg(*[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in cols])
    long = counts.unpivot([], cols, "column_name", "missing")
    return long.filter(F.col("missing") > 0)


def build_master(tables: dict[str, DataFrame], statuses=C.COMPLETED_STATUSES) -> DataFrame:
    """Steps 2-4 of the reference run: joins, activity, fills (no labels)."""
    activity = seller_activity_metrics(tables["order_items"], tables["orders"], statuses)
    master = join_activity(seller_master(tables), activity)
    return handle_missing_values(master)


# The notebook fills only these two activity columns and no categorical or
# declared value, so its segment tables drop missing states and revenues.
NOTEBOOK_FILL_COLUMNS = ("total_orders", "total_gmv")


def build_notebook_master(tables: dict[str, DataFrame], statuses=C.COMPLETED_STATUSES) -> DataFrame:
    """The notebook's variant of the master: same joins and activity, only
    orders and GMV filled."""
    activity = seller_activity_metrics(tables["order_items"], tables["orders"], statuses)
    out = seller_master(tables).join(activity, "seller_id", "left")
    out = out.withColumns({c: F.coalesce(F.col(c), F.lit(0).cast(out.schema[c].dataType))
                           for c in NOTEBOOK_FILL_COLUMNS})
    return out.withColumn("days_to_first_sale", days_between("won_date", "first_sale_date"))
