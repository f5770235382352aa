"""Churn labels and the status tables derived from them.

The flags are kept as computed, overlap included: ``active`` does not
exclude ``never_activated`` (a seller whose first sale came late but who
sold recently is both).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sellerscope.config import DEFAULT_PARAMS, ChurnParams
from sellerscope.functions import decimal_mean, flag, round1


def never_activated(params: ChurnParams = DEFAULT_PARAMS) -> F.Column:
    return flag((F.col("total_orders") == 0)
                | F.coalesce(F.col("days_to_first_sale") > params.never_activated_days, F.lit(False)))


def define_churn_labels(df: DataFrame, params: ChurnParams = DEFAULT_PARAMS) -> DataFrame:
    """never_activated, dormant, active, churned as 0/1 ints."""
    orders = F.coalesce(F.col("total_orders") > 0, F.lit(False))
    dsls = F.col("days_since_last_sale")
    out = df.withColumn("never_activated", never_activated(params))
    out = out.withColumns({
        "dormant": flag(orders & (F.col("never_activated") == 0) & (dsls > params.dormant_days)),
        "active": flag(orders & (dsls <= params.dormant_days)),
    })
    return out.withColumn("churned", flag((F.col("never_activated") == 1) | (F.col("dormant") == 1)))


def status_summary(master: DataFrame) -> DataFrame:
    """One row: sellers, count and share (%) of each status flag."""
    n = F.count(F.lit(1))
    aggs = [n.alias("total_sellers")]
    for c in ("never_activated", "dormant", "active", "churned"):
        aggs.append(F.sum(c).cast("long").alias(c))
        aggs.append(round1(F.sum(c) / n * 100).alias(f"{c}_pct"))
    return master.agg(*aggs)


def activated_only(master: DataFrame) -> DataFrame:
    return master.filter(F.col("never_activated") == 0)


def baseline_metrics(master: DataFrame) -> DataFrame:
    """Notebook baseline as (metric, value) rows.

    Days-to-first-sale statistics are over sellers with a first sale; the
    performance means are over activated sellers. The median is the exact
    interpolated one (see ranking.exact_quantile for the scalable form).
    """
    act = F.col("never_activated") == 0
    d1 = F.col("days_to_first_sale")

    def act_avg(c):
        return decimal_mean(F.when(act, F.col(c).cast("double")), 6)

    one = master.agg(
        F.count(F.lit(1)).cast("double").alias("total_sellers"),
        F.sum("never_activated").cast("double").alias("never_activated"),
        F.sum("dormant").cast("double").alias("dormant"),
        F.sum("active").cast("double").alias("active"),
        F.sum("churned").cast("double").alias("total_churned"),
        F.sum(act.cast("int")).cast("double").alias("activated_sellers"),
        F.avg(d1.cast("double")).alias("avg_days_to_first_sale"),
        F.percentile(d1.cast("double"), 0.5).alias("median_days_to_first_sale"),
        act_avg("total_orders").alias("avg_orders_activated"),
        act_avg("total_gmv").alias("avg_gmv_activated"),
        act_avg("avg_order_value").alias("avg_order_value_activated"),
        act_avg("unique_customers").alias("avg_customers_activated"),
        act_avg("days_active").alias("avg_days_active_activated"),
    )
    names = [f.name for f in one.schema.fields]
    return one.unpivot([], names, "metric", "value")
