"""Column -> Column building blocks (all JVM-side, no Python UDF)."""

from sellerscope.functions.exprs import (  # noqa: F401
    activation_speed_score,
    at_risk_active,
    bool_to_flag,
    clip_low,
    currency_brl,
    days_between,
    decimal_mean,
    exact_avg,
    exact_stddev_samp,
    exact_sum,
    pct,
    flag,
    money,
    month_key,
    overall_risk_max,
    overall_risk_override,
    potential_value,
    pretty_feature_name,
    recommended_action,
    replace_inf,
    revenue_band,
    risk_category,
    round1,
    safe_ratio,
    short_id,
    stddev_from_sums,
    urgency,
)
