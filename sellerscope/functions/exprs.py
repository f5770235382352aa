"""Scalar column expressions.

Each function maps Column(s) to a Column built from ``pyspark.sql.functions``
so it stays inside whole-stage codegen. Predicates on nullable inputs are
wrapped in ``coalesce(pred, false)``: the reference compares with pandas,
where a comparison with a missing value is False, not NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sellerscope import config as C

MICROS_PER_DAY = 86_400_000_000


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def days_between(start, end) -> Column:
    """Whole days from ``start`` to ``end``, floored (-1.5 days -> -2).

    Counted in microseconds so the floor matches a timedelta's ``.days``;
    ``datediff`` counts calendar-date boundaries instead.
    """
    micros = F.timestamp_diff("MICROSECOND", _c(start), _c(end))
    return F.floor(micros / F.lit(MICROS_PER_DAY)).cast("long")


def month_key(ts) -> Column:
    """Timestamp -> 'yyyy-MM' (the monthly cohort label)."""
    return F.date_format(_c(ts), "yyyy-MM")


def flag(pred: Column) -> Column:
    """Boolean predicate -> 0/1 int, NULL counted as false."""
    return F.coalesce(pred, F.lit(False)).cast("int")


def money(c) -> Column:
    """Money as an exact decimal so sums do not depend on summation order."""
    return _c(c).cast("decimal(18,2)")


def clip_low(c, low: float = 1) -> Column:
    """Lower clip (NULL stays NULL)."""
    col = _c(c)
    return F.when(col.isNull(), F.lit(None)).otherwise(F.greatest(col, F.lit(low)))


def safe_ratio(num, den) -> Column:
    """num / clip_low(den, 1) as double."""
    return (_c(num).cast("double") / clip_low(den, 1).cast("double"))


def replace_inf(c) -> Column:
    """+/-inf -> 0 (NaN and NULL untouched)."""
    col = _c(c)
    return F.when(col.isin(float("inf"), float("-inf")), F.lit(0.0)).otherwise(col)


def round1(c) -> Column:
    """Round to one decimal, half to even (numpy's ``round``)."""
    return F.bround(_c(c).cast("double"), 1)


def bool_to_flag(c) -> Column:
    """True/'True' -> 1, False/'False' -> 0, anything else -> 0."""
    col = _c(c).cast("string")
    return (F.when(col.isin("True", "true"), F.lit(1))
            .when(col.isin("False", "false"), F.lit(0))
            .otherwise(F.lit(0)))


def activation_speed_score(days) -> Column:
    """3 if first sale within 7 days, 2 within 30, else 1 (NULL -> 1)."""
    d = _c(days)
    return (F.when(F.coalesce(d <= 7, F.lit(False)), F.lit(3))
            .when(F.coalesce(d <= 30, F.lit(False)), F.lit(2))
            .otherwise(F.lit(1)))


def _left_open_bins(c: Column, edges, labels) -> Column:
    """Bins (e0, e1], (e1, e2], ...; outside (incl. == e0) -> NULL."""
    expr = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = (c > F.lit(lo)) & (c <= F.lit(hi))
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr


def risk_category(risk, labels=C.RISK_LABELS) -> Column:
    """(0,.3] Low, (.3,.6] Medium, (.6,.8] High, (.8,1] Critical; 0 -> NULL."""
    return _left_open_bins(_c(risk), C.RISK_BINS, labels)


def revenue_band(revenue) -> Column:
    """Declared monthly revenue band (left-open bins, NULL stays NULL)."""
    return _left_open_bins(_c(revenue).cast("double"), C.REVENUE_BINS, C.REVENUE_LABELS)


def overall_risk_max(never_risk, dormancy_risk) -> Column:
    """Pre-activation risk when dormancy risk is missing, else the larger."""
    n, d = _c(never_risk), _c(dormancy_risk)
    return F.when(d.isNull(), n).otherwise(F.greatest(n, d))


def overall_risk_override(never_risk, dormancy_risk) -> Column:
    """Notebook variant: dormancy risk replaces the other when present."""
    return F.coalesce(_c(dormancy_risk), _c(never_risk))


def urgency(days_since_last_sale, dormant_days: int) -> Column:
    """Tier by days until the seller turns dormant."""
    until = F.lit(dormant_days) - _c(days_since_last_sale)
    lim = C.URGENCY_LIMITS
    lab = C.URGENCY_LABELS
    return (F.when(until <= lim[0], F.lit(lab[0]))
            .when(until <= lim[1], F.lit(lab[1]))
            .when(until <= lim[2], F.lit(lab[2]))
            .otherwise(F.lit(lab[3])))


def potential_value(total_gmv, declared_monthly_revenue) -> Column:
    """GMV when positive, else a year of declared monthly revenue."""
    g = _c(total_gmv)
    return F.when(F.coalesce(g > 0, F.lit(False)), g.cast("double")).otherwise(
        _c(declared_monthly_revenue).cast("double") * 12)


def recommended_action(never_activated, days_to_first_sale, total_orders,
                       days_since_last_sale) -> Column:
    """Five-way text rule of the notebook's action list."""
    na = _c(never_activated)
    d1 = _c(days_to_first_sale)
    orders = _c(total_orders)
    dsls = _c(days_since_last_sale)
    slow = F.coalesce(d1 > 30, F.lit(False)) | d1.isNull()
    return (F.when((na == 1) & slow, F.lit(C.ACTION_ACTIVATION_SPRINT))
            .when(na == 1, F.lit(C.ACTION_CATALOG_WORKSHOP))
            .when(F.coalesce(orders < 5, F.lit(False)), F.lit(C.ACTION_EARLY))
            .when(F.coalesce(dsls > 30, F.lit(False)), F.lit(C.ACTION_WIN_BACK))
            .otherwise(F.lit(C.ACTION_SUSTAIN)))


def at_risk_active(category, active) -> Column:
    """High/Critical risk and still active."""
    return F.coalesce(_c(category).isin(*C.HIGH_RISK_LABELS) & (_c(active) == 1), F.lit(False))


def currency_brl(c) -> Column:
    """'R$ 1.234,56' (thousands '.', decimals ',')."""
    return F.concat(F.lit("R$ "), F.translate(F.format_number(_c(c).cast("double"), 2), ",.", ".,"))


def short_id(c, n: int = 8) -> Column:
    """First ``n`` characters of an id followed by an ellipsis."""
    return F.concat(F.substring(_c(c).cast("string"), 1, n), F.lit("…"))


def pretty_feature_name(c) -> Column:
    """'business_segment_encoded' -> 'Business Segment'."""
    s = F.replace(_c(c), F.lit("_encoded"), F.lit(""))
    return F.initcap(F.replace(s, F.lit("_"), F.lit(" ")))


def exact_sum(c) -> Column:
    """Sum of a money column through decimal (order-independent) as double."""
    return F.sum(_c(c).cast("decimal(20,2)")).cast("double")


def exact_avg(c) -> Column:
    """Mean of a money column: exact decimal sum / non-null count."""
    return exact_sum(c) / F.count(_c(c))


def pct(num, den) -> Column:
    """num / den * 100 rounded to 1 dp (half even); NULL when den is 0."""
    return round1(F.try_divide(_c(num).cast("double"), _c(den).cast("double")) * 100)


def exact_stddev_samp(c) -> Column:
    """Sample standard deviation of a money column, exact up to the final
    sqrt: with cents x, var = (n * sum(x^2) - sum(x)^2) / (n (n - 1)) where the
    numerator is exact integer (decimal) arithmetic, so the result does not
    depend on summation order and equal values give exactly 0. NULL for n < 2.
    The sums are algebraic, so partial aggregation before the shuffle holds.
    """
    cents = F.round(_c(c).cast("decimal(18,2)") * 100, 0).cast("decimal(38,0)")
    return stddev_from_sums(F.count(cents), F.sum(cents), F.sum(cents * cents))


def stddev_from_sums(n: Column, s1: Column, s2: Column) -> Column:
    """Sample standard deviation from the count, sum and sum of squares of cents."""
    s1, s2 = s1.cast("decimal(38,0)"), s2.cast("decimal(38,0)")
    num = (n.cast("decimal(38,0)") * s2 - s1 * s1).cast("double")
    var = num / (n.cast("double") * (n - 1).cast("double")) / F.lit(10000.0)
    return F.when(n > 1, F.sqrt(var))


def decimal_mean(c, scale: int = 6) -> Column:
    """Order-independent mean of a double column: values rounded to
    ``scale`` decimals and summed exactly as decimals, so the result does
    not change with partitioning or merge order (a double ``avg`` can move
    in the last bits between runs). Pick ``scale`` so value * 10^scale stays
    well inside double precision (6 for money, 9 for probabilities)."""
    col = _c(c).cast("double")
    return F.sum(col.cast(f"decimal(38,{scale})")).cast("double") / F.count(col)
