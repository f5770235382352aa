"""Monthly cohort table and its summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sellerscope import config as C
from sellerscope.functions import exact_sum, month_key, pct


def cohort_analysis(master: DataFrame) -> DataFrame:
    """By won_date month: sellers, flag sums, GMV, churn and activation rate.

    Months without a won_date are dropped (a NULL group key), like a pandas
    groupby. Sorted by month.
    """
    grouped = (master.filter(F.col("won_date").isNotNull())
               .groupBy(month_key("won_date").alias("cohort_month"))
               .agg(F.count("seller_id").alias("total_sellers"),
                    F.sum("never_activated").cast("long").alias("never_activated"),
                    F.sum("dormant").cast("long").alias("dormant"),
                    F.sum("active").cast("long").alias("active"),
                    F.sum("churned").cast("long").alias("churned"),
                    exact_sum("total_gmv").alias("total_gmv")))
    return grouped.withColumns({
        "churn_rate": pct("churned", "total_sellers"),
        "activation_rate": pct(F.col("total_sellers") - F.col("never_activated"), "total_sellers"),
    }).orderBy("cohort_month")


def complete_cohorts(cohort: DataFrame, cutoff: str = C.COHORT_CUTOFF) -> DataFrame:
    """Cohorts strictly before the cut-off month."""
    return cohort.filter(F.col("cohort_month") < F.lit(cutoff))


def cohort_extremes(cohort: DataFrame) -> DataFrame:
    """One row: number of cohorts, unweighted mean churn rate, best and worst
    month. Ties go to the earliest month (first occurrence in month order)."""
    m = F.col("cohort_month")
    r = F.col("churn_rate")
    return cohort.agg(
        F.count(F.lit(1)).alias("cohorts"),
        # 1-dp rates summed as decimals: the mean does not depend on order
        (F.sum(r.cast("decimal(12,1)")).cast("double") / F.count(r)).alias("avg_churn_rate"),
        F.min_by(m, F.struct(r, m)).alias("best_cohort"),
        F.min(r).alias("best_churn_rate"),
        F.min_by(m, F.struct(-r, m)).alias("worst_cohort"),
        F.max(r).alias("worst_churn_rate"),
    )
