"""One-row summaries: executive summary and dashboard KPI row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sellerscope import config as C
from sellerscope.config import DEFAULT_PARAMS, ChurnParams
from sellerscope.functions import exact_sum, round1


def _high(c="risk_category"):
    return F.coalesce(F.col(c).isin(*C.HIGH_RISK_LABELS), F.lit(False))


def exec_summary(scored: DataFrame) -> DataFrame:
    """Sellers, churn, churned GMV and its share, High/Critical count and the
    GMV of High/Critical sellers that have not churned, in one pass."""
    churned = F.col("churned") == 1
    one = scored.agg(
        F.count(F.lit(1)).alias("total_sellers"),
        F.sum("churned").cast("long").alias("churned"),
        (F.avg(F.col("churned").cast("double")) * 100).alias("churn_rate"),
        F.coalesce(exact_sum(F.when(churned, F.col("total_gmv"))), F.lit(0.0)).alias("churned_gmv"),
        exact_sum("total_gmv").alias("total_gmv"),
        F.sum(_high().cast("long")).alias("high_critical"),
        F.coalesce(exact_sum(F.when(_high() & (F.col("churned") == 0), F.col("total_gmv"))), F.lit(0.0))
        .alias("revenue_at_risk"),
    )
    share = F.when(F.col("total_gmv") > 0, F.col("churned_gmv") / F.col("total_gmv") * 100).otherwise(F.lit(0.0))
    return one.withColumn("gmv_share", share)


def kpi_row(scored: DataFrame, params: ChurnParams = DEFAULT_PARAMS) -> DataFrame:
    """Dashboard KPIs (rounded as displayed)."""
    churned = F.col("churned") == 1
    one = scored.agg(
        F.count(F.lit(1)).alias("total_sellers"),
        round1(F.avg(F.col("churned").cast("double")) * 100).alias("churn_rate"),
        F.sum("never_activated").cast("long").alias("never_activated"),
        F.sum("dormant").cast("long").alias("dormant"),
        F.sum("active").cast("long").alias("active"),
        F.bround(F.coalesce(exact_sum(F.when(churned, F.col("total_gmv"))), F.lit(0.0)), 2).alias("gmv_at_risk"),
        F.sum(_high().cast("long")).alias("high_risk"),
        F.bround(exact_sum("total_gmv") / F.count("total_gmv"), 2).alias("avg_gmv"),
    )
    rate, months = params.intervention_success_rate, float(params.retained_months)
    return one.withColumns({
        "high_risk_pct": round1(F.try_divide(F.col("high_risk").cast("double"),
                                             F.col("total_sellers").cast("double")) * 100),
        "projected_gmv_saved": F.bround(F.col("gmv_at_risk") * F.lit(rate) * F.lit(months), 2),
    })
