"""Risk columns, categories and their distribution tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sellerscope import config as C
from sellerscope.functions import decimal_mean, overall_risk_max, overall_risk_override, risk_category


def formula_scores(labelled: DataFrame, dormant_days: int = 60, override: bool = False,
                   labels=C.RISK_LABELS) -> DataFrame:
    """Deterministic stand-in for model output (no fit), so that ranking,
    bucketing and the evaluation operators have an exact SQL oracle.

    never_activated_risk = (seller_id * 31 mod 1000) / 1000;
    dormancy_risk = d / (d + dormant_days) for activated sellers, else NULL,
    with d = days_since_last_sale.
    """
    d = F.col("days_since_last_sale").cast("double")
    out = labelled.withColumns({
        "never_activated_risk": ((F.col("seller_id") * 31) % 1000).cast("double") / F.lit(1000.0),
        "dormancy_risk": F.when(F.col("never_activated") == 1, F.lit(None).cast("double"))
                          .otherwise(d / (d + F.lit(float(dormant_days)))),
    })
    return combine_risk(out, override, labels)


def combine_risk(df: DataFrame, override: bool = False, labels=C.RISK_LABELS) -> DataFrame:
    """overall_churn_risk (max of both, or the notebook's override) + category."""
    comb = overall_risk_override if override else overall_risk_max
    out = df.withColumn("overall_churn_risk", comb("never_activated_risk", "dormancy_risk"))
    return out.withColumn("risk_category", risk_category("overall_churn_risk", labels))


def _category_table(spark: SparkSession) -> DataFrame:
    # the four fixed labels with their display order: bounded (4 rows)
    rows = [(lab, i) for i, lab in enumerate(reversed(C.RISK_LABELS))]
    return spark.createDataFrame(rows, "risk_category string, category_order int")


def risk_distribution(scored: DataFrame) -> DataFrame:
    """Sellers and share (%) per category, all four listed (zeros kept), in
    the fixed order Critical, High, Medium, Low. The share is over all
    sellers, uncategorised (risk exactly 0) included."""
    spark = scored.sparkSession
    counts = scored.groupBy("risk_category").agg(F.count(F.lit(1)).alias("sellers"))
    # the four fixed categories (zero-filled) full-outer-joined with the grouped
    # counts (at most 5 rows, the NULL category included): the total is a
    # window over these few rows, so the input is evaluated once
    cats = _category_table(spark)
    both = cats.join(counts, "risk_category", "full_outer").withColumns({
        "sellers": F.coalesce("sellers", F.lit(0)).cast("long"),
        "total": F.sum(F.coalesce("sellers", F.lit(0))).over(Window.partitionBy()),
    })
    out = both.filter(F.col("category_order").isNotNull()).select(
        "risk_category", "category_order", "sellers",
        F.try_divide(F.col("sellers").cast("double"), F.col("total").cast("double")).alias("_f"))
    out = out.withColumn("share_pct", F.col("_f") * 100).drop("_f")
    return out.orderBy("category_order")


def avg_risk_by_status(scored: DataFrame) -> DataFrame:
    """Mean overall risk of never-activated, dormant and active sellers (the
    flags overlap, so three conditional means); statuses with no seller are
    left out."""
    r = F.col("overall_churn_risk")
    one = scored.agg(*[decimal_mean(F.when(F.col(s) == 1, r), 9).alias(s)
                       for s in ("never_activated", "dormant", "active")],
                     *[F.sum(F.col(s)).alias(f"n_{s}") for s in ("never_activated", "dormant", "active")])
    long = one.select(F.explode(F.array(*[
        F.struct(F.lit(s).alias("status"), F.col(s).alias("avg_risk"), F.col(f"n_{s}").alias("n"))
        for s in ("never_activated", "dormant", "active")])).alias("s")).select("s.*")
    return long.filter(F.col("n") > 0).drop("n")
