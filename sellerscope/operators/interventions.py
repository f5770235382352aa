"""Intervention lists, urgency tiers and projected gains."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sellerscope import config as C
from sellerscope.config import DEFAULT_PARAMS, ChurnParams
from sellerscope.functions import (at_risk_active, exact_avg, exact_sum, potential_value,
                                   recommended_action, short_id, urgency)
from sellerscope.operators.ranking import average_rank_pct


def at_risk_active_sellers(scored: DataFrame) -> DataFrame:
    """High/Critical risk sellers that are still active."""
    return scored.filter(at_risk_active("risk_category", "active"))


def at_risk_not_churned(scored: DataFrame, threshold: float = 0.6) -> DataFrame:
    """Notebook variant: risk above the threshold and not churned."""
    return scored.filter(F.coalesce((F.col("overall_churn_risk") > threshold) & (F.col("churned") == 0),
                                    F.lit(False)))


def with_urgency(at_risk: DataFrame, params: ChurnParams = DEFAULT_PARAMS) -> DataFrame:
    """Days until dormant and urgency tier."""
    return at_risk.withColumns({
        "days_until_dormant": F.lit(params.dormant_days) - F.col("days_since_last_sale"),
        "urgency": urgency("days_since_last_sale", params.dormant_days),
    })


def prioritise(at_risk: DataFrame, params: ChurnParams = DEFAULT_PARAMS) -> DataFrame:
    """GMV percentile (average rank within the list), priority score,
    days until dormant and urgency tier."""
    ranked = average_rank_pct(at_risk, "total_gmv", "gmv_percentile")
    score = (F.col("overall_churn_risk") * C.PRIORITY_RISK_WEIGHT
             + F.col("gmv_percentile") * C.PRIORITY_GMV_WEIGHT)
    return with_urgency(ranked.withColumn("priority_score", score), params)


def intervention_list(scored: DataFrame, params: ChurnParams = DEFAULT_PARAMS) -> DataFrame:
    """At-risk active sellers by priority score (descending; seller id breaks
    ties), the exported columns that exist. Empty input -> empty table."""
    pr = prioritise(at_risk_active_sellers(scored), params)
    cols = [c for c in C.INTERVENTION_COLUMNS if c in pr.columns]
    return pr.orderBy(F.col("priority_score").desc(), "seller_id").select(*cols)


def intervention_top100(nb_scored: DataFrame, k: int = 100, threshold: float = 0.6) -> DataFrame:
    """Notebook list: risk > threshold and not churned, by (risk, potential
    value) descending, with a recommended action; first ``k`` rows."""
    out = at_risk_not_churned(nb_scored, threshold).withColumns({
        "potential_value": potential_value("total_gmv", "declared_monthly_revenue"),
        "recommended_action": recommended_action("never_activated", "days_to_first_sale",
                                                 "total_orders", "days_since_last_sale"),
    })
    order = [F.col("overall_churn_risk").desc(), F.col("potential_value").desc_nulls_last(), "seller_id"]
    return out.orderBy(*order).select(*C.TOP100_COLUMNS).limit(k)


def urgency_tiers(interventions: DataFrame) -> DataFrame:
    """Sellers and GMV per urgency tier, for the tiers the report lists. Needs
    ``with_urgency`` only, not the rank of ``prioritise``."""
    tiers = C.URGENCY_LABELS[:3]
    out = (interventions.filter(F.col("urgency").isin(*tiers))
           .groupBy("urgency").agg(F.count(F.lit(1)).alias("sellers"),
                                   exact_sum("total_gmv").alias("gmv_at_risk")))
    order = F.when(F.col("urgency") == tiers[0], 0).when(F.col("urgency") == tiers[1], 1).otherwise(2)
    return out.orderBy(order)


def top_immediate(interventions: DataFrame, k: int = 5) -> DataFrame:
    """First ``k`` sellers of the Immediate tier in priority order."""
    imm = interventions.filter(F.col("urgency") == C.URGENCY_LABELS[0])
    return (imm.orderBy(F.col("priority_score").desc(), "seller_id").limit(k)
            .select(short_id("seller_id").alias("seller_id_short"), "seller_state", "total_gmv",
                    "overall_churn_risk"))


def business_gains(interventions: DataFrame, params: ChurnParams = DEFAULT_PARAMS) -> DataFrame:
    """One row: sellers at risk, GMV at risk, mean GMV, success rate and the
    projection (GMV x rate x months; sellers = floor(n x rate)). An empty list
    gives zeros (and no mean)."""
    rate = params.intervention_success_rate
    one = interventions.agg(F.count(F.lit(1)).alias("total_at_risk"),
                            F.coalesce(exact_sum("total_gmv"), F.lit(0.0)).alias("gmv_at_risk"),
                            exact_avg("total_gmv").alias("avg_seller_gmv"))
    return one.withColumns({
        "intervention_success_rate": F.lit(rate),
        "projected_gmv_saved": F.col("gmv_at_risk") * F.lit(rate) * F.lit(float(params.retained_months)),
        "projected_sellers_saved": F.floor(F.col("total_at_risk") * F.lit(rate)).cast("long"),
    })


def intervention_payload(interventions: DataFrame, k: int = 30) -> DataFrame:
    """Dashboard rows: first ``k`` of the list, short id, risk in % (1 dp),
    score (3 dp), GMV (2 dp)."""
    cols = [c for c in C.PAYLOAD_COLUMNS if c in interventions.columns]
    top = interventions.orderBy(F.col("priority_score").desc(), "seller_id").limit(k).select(*cols)
    return top.withColumns({
        "seller_id_short": short_id("seller_id"),
        "overall_churn_risk": F.bround(F.col("overall_churn_risk") * 100, 1),
        "priority_score": F.bround("priority_score", 3),
        "total_gmv": F.bround("total_gmv", 2),
    })
