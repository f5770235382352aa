"""Segment tables, significance test and churn-driver summaries.

Grouping keys are low-cardinality attributes, so every table here is one
partially aggregated shuffle of a handful of rows per map task. Shares
use a one-row total joined by broadcast rather than an unpartitioned window.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sellerscope import config as C
from sellerscope.functions import decimal_mean, exact_avg, exact_sum, pct, revenue_band, round1
from sellerscope.operators.ranking import materialize
from sellerscope.operators.scalars import attach_scalars


def _clean(df: DataFrame, segment_col: str) -> F.Column:
    return F.coalesce(F.col(segment_col).cast("string"), F.lit(C.UNKNOWN))


def segment_analysis(df: DataFrame, segment_col: str) -> DataFrame | None:
    """Generic segment table (None when the column is absent): sellers,
    churned, never activated, active, mean and total GMV, churn % and market
    share %, sorted by churn % descending (segment name breaks ties)."""
    if segment_col not in df.columns:
        return None
    agg = df.groupBy(_clean(df, segment_col).alias("Segment")).agg(
        F.count("seller_id").alias("Total_Sellers"),
        F.sum("churned").cast("long").alias("Churned"),
        F.sum("never_activated").cast("long").alias("Never_Activated"),
        F.sum("active").cast("long").alias("Active"),
        exact_avg("total_gmv").alias("Avg_GMV"),
        exact_sum("total_gmv").alias("Total_GMV"),
    )
    # the share's denominator is a window over the aggregated rows: one row
    # per segment (bounded by the category's cardinality, not by the data),
    # so the input lineage is evaluated once
    out = agg.withColumns({
        "Churn_Rate_%": pct("Churned", "Total_Sellers"),
        "Market_Share_%": pct("Total_Sellers", F.sum("Total_Sellers").over(Window.partitionBy())),
    })
    return out.orderBy(F.col("Churn_Rate_%").desc(), "Segment")


def segment_tables(df: DataFrame, segment_cols) -> DataFrame:
    """The generic segment table of every column that ``df`` has, from one pass with
    grouping sets: segment_column and the columns of ``segment_analysis``."""
    cols = [c for c in segment_cols if c in df.columns]
    if not cols:
        raise ValueError("no segment column")
    keyed = df.withColumns({f"_segment_{c}": _clean(df, c) for c in cols})
    keys = [f"_segment_{c}" for c in cols]
    agg = keyed.groupingSets([[k] for k in keys], *keys).agg(
        F.count("seller_id").alias("Total_Sellers"),
        F.sum("churned").cast("long").alias("Churned"),
        F.sum("never_activated").cast("long").alias("Never_Activated"),
        F.sum("active").cast("long").alias("Active"),
        exact_avg("total_gmv").alias("Avg_GMV"),
        exact_sum("total_gmv").alias("Total_GMV"),
    )
    # a segment is never NULL, so the one key that is set names its column
    column = F.coalesce(*[F.when(F.col(k).isNotNull(), F.lit(c)) for c, k in zip(cols, keys)])
    agg = agg.withColumn("segment_column", column).withColumn("Segment", F.coalesce(*keys)).drop(*keys)
    out = agg.withColumns({
        "Churn_Rate_%": pct("Churned", "Total_Sellers"),
        "Market_Share_%": pct("Total_Sellers", F.sum("Total_Sellers").over(Window.partitionBy("segment_column"))),
    })
    return out.select("segment_column", "Segment", *[c for c in out.columns if c not in ("segment_column", "Segment")])


def _profile_table(df: DataFrame, segment_col: str, label: str, extra_means=(),
                   sort_by_volume: bool = False, dormant: bool = True,
                   drop_missing: bool = False) -> DataFrame:
    key = F.col(segment_col).cast("string") if drop_missing else _clean(df, segment_col)
    src = df.filter(F.col(segment_col).isNotNull()) if drop_missing else df
    aggs = [F.count("seller_id").alias("Total_Sellers"),
            F.sum("churned").cast("long").alias("Churned"),
            F.sum("never_activated").cast("long").alias("Never_Activated")]
    if dormant:
        aggs.append(F.sum("dormant").cast("long").alias("Dormant"))
    aggs += [F.sum("active").cast("long").alias("Active"),
             exact_avg("total_gmv").alias("Avg_GMV")]
    for col, name in extra_means:
        aggs.append(F.avg(F.col(col).cast("double")).alias(name))
    out = src.groupBy(key.alias(label)).agg(*aggs)
    out = out.withColumns({
        "Churn_Rate_%": pct("Churned", "Total_Sellers"),
        "Activation_Rate_%": pct(F.col("Total_Sellers") - F.col("Never_Activated"), "Total_Sellers"),
    })
    order = F.col("Total_Sellers").desc() if sort_by_volume else F.col("Churn_Rate_%").desc()
    return out.orderBy(order, label)


def segment_profile(nb: DataFrame) -> DataFrame:
    """Behaviour-profile table (notebook): + dormant, mean orders, activation %."""
    return _profile_table(nb, "lead_behaviour_profile", "DISC_Profile", [("total_orders", "Avg_Orders")])


def segment_business(nb: DataFrame) -> DataFrame:
    return _profile_table(nb, "business_segment", "Business_Segment", [("total_orders", "Avg_Orders")],
                          sort_by_volume=True)


def segment_lead_type(nb: DataFrame) -> DataFrame:
    return _profile_table(nb, "lead_type", "Lead_Type",
                          [("total_orders", "Avg_Orders"), ("sales_cycle_days", "Avg_Sales_Cycle_Days")])


def segment_business_type(nb: DataFrame) -> DataFrame:
    return _profile_table(nb, "business_type", "Business_Type", [("total_orders", "Avg_Orders")],
                          sort_by_volume=True)


def _small_table(df: DataFrame, key: F.Column, label: str) -> DataFrame:
    out = df.groupBy(key.alias(label)).agg(
        F.count("seller_id").alias("Total_Sellers"),
        F.sum("churned").cast("long").alias("Churned"),
        F.sum("never_activated").cast("long").alias("Never_Activated"),
        F.sum("active").cast("long").alias("Active"))
    return out.withColumn("Churn_Rate_%", pct("Churned", "Total_Sellers"))


def segment_revenue_band(nb: DataFrame) -> DataFrame:
    """By declared-revenue band, all four bands listed in band order (an empty
    band has zero counts and a NULL rate); sellers outside every band (NULL
    revenue) are not counted, as in a categorical groupby."""
    spark = nb.sparkSession
    bands = spark.createDataFrame([(lab, i) for i, lab in enumerate(C.REVENUE_LABELS)],
                                  "Declared_Revenue string, band_order int")
    banded = nb.withColumn("_band", revenue_band("declared_monthly_revenue")).filter(F.col("_band").isNotNull())
    counts = _small_table(banded, F.col("_band"), "Declared_Revenue")
    out = bands.join(counts, "Declared_Revenue", "left").select(
        "Declared_Revenue", "band_order",
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c)
          for c in ("Total_Sellers", "Churned", "Never_Activated", "Active")],
        "Churn_Rate_%")
    return out.orderBy("band_order")


def segment_has_company(nb: DataFrame) -> DataFrame:
    """True / False / Unknown (missing) company flag."""
    key = F.coalesce(F.initcap(F.col("has_company").cast("string")), F.lit(C.UNKNOWN))
    return _small_table(nb, key, "Has_Company").orderBy("Has_Company")


def segment_origin(nb: DataFrame) -> DataFrame:
    """Lead source table, produced only when more than one source exists
    (the guard is a join against a one-row distinct count, not a fetch)."""
    key = _clean(nb, "origin")
    out = nb.groupBy(key.alias("Lead_Source")).agg(
        F.count("seller_id").alias("Total_Sellers"),
        F.sum("churned").cast("long").alias("Churned"),
        F.sum("never_activated").cast("long").alias("Never_Activated"),
        F.sum("active").cast("long").alias("Active"),
        exact_avg("total_gmv").alias("Avg_GMV"),
        F.avg(F.col("sales_cycle_days").cast("double")).alias("Avg_Sales_Cycle_Days"))
    out = out.withColumn("Churn_Rate_%", pct("Churned", "Total_Sellers"))
    # guard over the aggregated rows (one per source): evaluated once
    out = out.withColumn("_sources", F.count(F.lit(1)).over(Window.partitionBy()))
    out = out.filter(F.col("_sources") > 1).drop("_sources")
    return out.orderBy(F.col("Total_Sellers").desc(), "Lead_Source")


def segment_state_top10(nb: DataFrame, k: int = 10) -> DataFrame:
    """States by seller volume, top ``k``; missing states dropped."""
    out = nb.filter(F.col("seller_state").isNotNull()).groupBy(F.col("seller_state").alias("State")).agg(
        F.count("seller_id").alias("Total_Sellers"),
        F.sum("churned").cast("long").alias("Churned"),
        F.sum("never_activated").cast("long").alias("Never_Activated"),
        F.sum("active").cast("long").alias("Active"),
        exact_avg("total_gmv").alias("Avg_GMV"))
    out = out.withColumn("Churn_Rate_%", pct("Churned", "Total_Sellers"))
    return out.orderBy(F.col("Total_Sellers").desc(), "State").limit(k)


def segment_extremes(table: DataFrame, label: str, min_support: int = C.MIN_SEGMENT_SUPPORT) -> DataFrame:
    """One row: best and worst segment among those with >= min_support
    sellers, their rates and the range in points (first in label order wins
    ties)."""
    s = table.filter(F.col("Total_Sellers") >= min_support)
    r, seg = F.col("Churn_Rate_%"), F.col(label)
    return s.agg(
        F.count(F.lit(1)).alias("segments"),
        F.min_by(seg, F.struct(r, seg)).alias("best_segment"),
        F.min(r).alias("best_churn_rate"),
        F.min_by(seg, F.struct(-r, seg)).alias("worst_segment"),
        F.max(r).alias("worst_churn_rate"),
        round1(F.max(r) - F.min(r)).alias("churn_range_pp"))


def contingency_table(df: DataFrame, segment_col: str) -> DataFrame:
    """Counts of segment x churned for known segments: one row per segment
    with columns ``churned_0`` and ``churned_1`` (zero-filled)."""
    seg = _clean(df, segment_col)
    known = df.withColumn("_seg", seg).filter(F.col("_seg") != C.UNKNOWN)
    return (known.groupBy(F.col("_seg").alias("segment"))
            .agg(F.sum((F.col("churned") == 0).cast("long")).alias("churned_0"),
                 F.sum((F.col("churned") == 1).cast("long")).alias("churned_1")))


def chi_square_test(table: DataFrame) -> DataFrame:
    """Pearson chi-square of a segment x {0,1} table: statistic, dof and p.

    Expected counts come from one-row margins joined by broadcast; Yates'
    correction is applied only when dof = 1 (the scipy default). Columns
    with a zero total are dropped from the table first, as a crosstab only
    lists observed values. ``p_value`` is the chi-square survival function
    evaluated on the one-row result (``chi2_sf``).
    """
    # the contingency table is tiny (segments x 2) and feeds the margins, the
    # dimensions and the terms: cut its lineage once
    table = materialize(table)
    cells = table.select("segment", F.explode(F.array(
        F.struct(F.lit(0).alias("c"), F.col("churned_0").alias("o")),
        F.struct(F.lit(1).alias("c"), F.col("churned_1").alias("o")))).alias("x")).select("segment", "x.*")
    col_tot = cells.groupBy("c").agg(F.sum("o").alias("col_total")).filter(F.col("col_total") > 0)
    cells = cells.join(F.broadcast(col_tot), "c", "inner")
    row_tot = cells.groupBy("segment").agg(F.sum("o").alias("row_total"))
    dims = cells.agg(F.sum("o").alias("n"), F.countDistinct("segment").alias("r"),
                     F.countDistinct("c").alias("k"))
    e = F.col("row_total") * F.col("col_total") / F.col("n")
    dof = (F.col("r") - 1) * (F.col("k") - 1)
    diff = F.abs(F.col("o") - e)
    corr = F.when(dof == 1, F.least(F.lit(0.5), diff)).otherwise(F.lit(0.0))
    terms = (attach_scalars(cells.join(row_tot, "segment"), dims)
             .select(dof.alias("dof"), (F.pow(diff - corr, 2) / e).alias("t")))
    # terms summed as decimals: the statistic does not depend on summation order
    stat = terms.groupBy("dof").agg(F.sum(F.col("t").cast("decimal(38,9)")).cast("double").alias("chi2"))
    return stat.select("chi2", F.col("dof").cast("long").alias("dof"),
                       chi2_sf(F.col("chi2"), F.col("dof").cast("double")).alias("p_value"))


def chi2_sf(x: F.Column, dof: F.Column) -> F.Column:
    """P(X > x) for X ~ chi-square(dof), dof a whole number: the finite sum
    exp(-y) * sum(y^(a + i) / Gamma(a + i + 1)), y = x / 2, which starts at a = 0
    for even dof and at a = 1/2, after erfc(sqrt(y)), for odd ones."""
    y = x / 2
    odd = F.pmod(dof, F.lit(2)) == 1
    start = F.when(odd, F.sqrt(y) * 2 / math.sqrt(math.pi)).otherwise(F.lit(1.0))
    half = F.when(odd, F.lit(0.5)).otherwise(F.lit(0.0))
    steps = F.floor(dof / 2).cast("int")
    first = F.struct(start.alias("term"), F.lit(0.0).alias("total"))
    total = F.aggregate(
        F.when(steps > 0, F.sequence(F.lit(1), steps)).otherwise(F.array().cast("array<int>")), first,
        lambda acc, i: F.struct((acc["term"] * y / (i + half)).alias("term"), (acc["total"] + acc["term"]).alias("total")),
        lambda acc: acc["total"])
    out = F.when(odd, erfc(F.sqrt(y))).otherwise(F.lit(0.0)) + F.exp(-y) * total
    return F.when((dof > 0) & x.isNotNull(), F.when(x <= 0, F.lit(1.0)).otherwise(out)).otherwise(F.lit(float("nan")))


def erfc(z: F.Column) -> F.Column:
    """Complementary error function of z >= 0: a power series, from 2 on a continued fraction."""
    start = F.struct(z.alias("term"), z.alias("total"))
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(60)), start,
        lambda acc, n: F.struct((acc["term"] * 2 * z * z / (n * 2 + 1)).alias("term"),
                                (acc["total"] + acc["term"] * 2 * z * z / (n * 2 + 1)).alias("total")),
        lambda acc: acc["total"])
    fraction = F.aggregate(F.sequence(F.lit(120), F.lit(1), F.lit(-1)), F.lit(0.0), lambda acc, n: n / 2.0 / (z + acc))
    scale = F.exp(-z * z) / math.sqrt(math.pi)
    return F.when(z < 2, 1 - 2 * scale * series).otherwise(scale / (z + fraction))


def active_vs_dormant(nb: DataFrame) -> DataFrame:
    """Mean of five metrics for active and for dormant activated sellers and
    the difference in % of the dormant mean, one row per metric."""
    act = nb.filter(F.col("never_activated") == 0)
    metrics = [("Total Orders", "total_orders"), ("Total GMV (R$)", "total_gmv"),
               ("Avg Order Value (R$)", "avg_order_value"), ("Unique Customers", "unique_customers"),
               ("Days Active", "days_active")]
    aggs = []
    for i, (_, c) in enumerate(metrics):
        v = F.col(c).cast("double")
        aggs.append(decimal_mean(F.when(F.col("active") == 1, v), 6).alias(f"a{i}"))
        aggs.append(decimal_mean(F.when(F.col("dormant") == 1, v), 6).alias(f"d{i}"))
    one = act.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(name).alias("Metric"), F.col(f"a{i}").alias("Active_Sellers"),
                              F.col(f"d{i}").alias("Dormant_Sellers"), F.lit(i).alias("metric_order"))
                     for i, (name, _) in enumerate(metrics)])
    long = one.select(F.explode(rows).alias("m")).select("m.*")
    diff = F.try_divide(F.col("Active_Sellers") - F.col("Dormant_Sellers"), F.col("Dormant_Sellers")) * 100
    return long.withColumn("Difference_%", round1(diff)).orderBy("metric_order")


def zero_revenue_churn(nb: DataFrame) -> DataFrame:
    """One row: sellers declaring zero monthly revenue and their churn %."""
    z = nb.filter(F.col("declared_monthly_revenue") == 0)
    return z.agg(F.count(F.lit(1)).alias("sellers"),
                 (F.avg(F.col("churned").cast("double")) * 100).alias("churn_rate"))


def churn_drivers(nb: DataFrame) -> DataFrame:
    """The five-row driver table with numeric impacts (text is the caller's):
    never-activated share, worst known profile, worst supported business
    segment (with its range), zero-revenue churn, dormancy of activated."""
    never = nb.agg((F.avg(F.col("never_activated").cast("double")) * 100).alias("impact")).select(
        F.lit(1).alias("driver"), F.lit("Never Activated").alias("name"), "impact",
        F.lit(None).cast("double").alias("range_pp"))
    prof = segment_profile(nb).filter(F.col("DISC_Profile") != C.UNKNOWN)
    pe = segment_extremes(prof, "DISC_Profile", min_support=0).select(
        F.lit(2).alias("driver"), F.col("worst_segment").alias("name"),
        F.col("worst_churn_rate").alias("impact"), F.col("churn_range_pp").alias("range_pp"))
    be = segment_extremes(segment_business(nb), "Business_Segment").select(
        F.lit(3).alias("driver"), F.col("worst_segment").alias("name"),
        F.col("worst_churn_rate").alias("impact"), F.col("churn_range_pp").alias("range_pp"))
    zero = zero_revenue_churn(nb).select(F.lit(4).alias("driver"), F.lit("Zero Declared Revenue").alias("name"),
                                         F.col("churn_rate").alias("impact"),
                                         F.lit(None).cast("double").alias("range_pp"))
    dorm = nb.filter(F.col("never_activated") == 0).agg(
        (F.avg(F.col("dormant").cast("double")) * 100).alias("impact")).select(
        F.lit(5).alias("driver"), F.lit("Low First-Month Performance").alias("name"), "impact",
        F.lit(None).cast("double").alias("range_pp"))
    out = never.unionByName(pe).unionByName(be).unionByName(zero).unionByName(dorm)
    return out.filter(F.col("impact").isNotNull()).orderBy("driver")
