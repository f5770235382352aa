"""Business thresholds and fixed values.

The thresholds are parameters (a frozen dataclass so they can be passed
around and logged); the category labels and bin edges below are fixed
values that must equal the reference's for results to match.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass, field

# --- fixed values (must match the reference) --------------------------------
# Order statuses that count as a completed sale.
COMPLETED_STATUSES = ("delivered", "shipped", "approved", "invoiced")
# Categorical columns filled with 'Unknown' before analysis.
CATEGORICAL_FILL_COLUMNS = (
    "lead_behaviour_profile",
    "business_segment",
    "lead_type",
    "business_type",
    "origin",
    "seller_state",
)
# Numeric columns filled with 0 before analysis.
NUMERIC_FILL_COLUMNS = ("declared_monthly_revenue", "declared_product_catalog_size")
# Activity metrics that become 0 for sellers without a completed sale.
ACTIVITY_FILL_COLUMNS = (
    "total_orders",
    "total_gmv",
    "unique_customers",
    "total_items_sold",
    "total_freight",
)
UNKNOWN = "Unknown"
# Risk bins: (0, .3] Low, (.3, .6] Medium, (.6, .8] High, (.8, 1] Critical.
RISK_BINS = (0.0, 0.3, 0.6, 0.8, 1.0)
RISK_LABELS = ("Low", "Medium", "High", "Critical")
HIGH_RISK_LABELS = ("High", "Critical")
# The notebook labels the same bins with a suffix.
NOTEBOOK_RISK_LABELS = ("Low Risk", "Medium Risk", "High Risk", "Critical Risk")
# Declared revenue bands: (-0.1, 0] (0, 1000] (1000, 10000] (10000, inf).
REVENUE_BINS = (-0.1, 0.0, 1000.0, 10000.0, float("inf"))
REVENUE_LABELS = ("Zero", "Low (1-1K)", "Medium (1K-10K)", "High (>10K)")
# Urgency tiers by days until dormant: <=7, <=14, <=30, else.
URGENCY_LIMITS = (7, 14, 30)
URGENCY_LABELS = ("Immediate", "High", "Medium", "Low")
# Priority score weights: risk and GMV percentile.
PRIORITY_RISK_WEIGHT = 0.6
PRIORITY_GMV_WEIGHT = 0.4
# Recommended actions (notebook rule).
ACTION_ACTIVATION_SPRINT = "URGENT: 30-day activation sprint - weekly check-ins needed"
ACTION_CATALOG_WORKSHOP = "Monitor: Provide catalog-building workshop"
ACTION_EARLY = "Early intervention: Marketing co-op + category optimization"
ACTION_WIN_BACK = "Re-engagement: Win-back campaign + personalized outreach"
ACTION_SUSTAIN = "Monitor: Proactive support to sustain momentum"
# Pre-activation features (encoded categoricals, then numerics).
PRE_ACTIVATION_FEATURES = (
    "lead_behaviour_profile_encoded",
    "business_segment_encoded",
    "lead_type_encoded",
    "business_type_encoded",
    "origin_encoded",
    "seller_state_encoded",
    "declared_monthly_revenue",
    "declared_product_catalog_size",
    "sales_cycle_days",
)
# Retention feature list as declared (11 names).
RETENTION_FEATURES = (
    "lead_behaviour_profile_encoded",
    "business_segment_encoded",
    "total_orders",
    "total_gmv",
    "unique_customers",
    "days_active",
    "days_to_first_sale",
    "avg_order_value",
    "gmv_per_order",
    "customers_per_order",
    "activation_speed_score",
)
# Extra pre-activation features of the wide (notebook) variant.
WIDE_EXTRA_FEATURES = (
    "has_company_binary",
    "has_gtin_binary",
    "declared_revenue_zero",
    "declared_catalog_zero",
)
# Activity features added by the wide retention variant.
WIDE_ACTIVITY_FEATURES = (
    "total_orders",
    "total_gmv",
    "unique_customers",
    "days_active",
    "days_to_first_sale",
    "avg_order_value",
)
# Columns of the exported intervention list, in order.
INTERVENTION_COLUMNS = (
    "seller_id",
    "seller_city",
    "seller_state",
    "business_segment",
    "lead_behaviour_profile",
    "total_orders",
    "total_gmv",
    "unique_customers",
    "days_since_last_sale",
    "overall_churn_risk",
    "risk_category",
    "priority_score",
    "urgency",
    "declared_monthly_revenue",
)
# Columns of the notebook's top-100 list, in order.
TOP100_COLUMNS = (
    "seller_id",
    "seller_state",
    "business_segment",
    "lead_behaviour_profile",
    "overall_churn_risk",
    "risk_category",
    "churned",
    "never_activated",
    "total_orders",
    "total_gmv",
    "potential_value",
    "recommended_action",
)
# Columns of the dashboard's intervention payload, in order.
PAYLOAD_COLUMNS = (
    "seller_id",
    "seller_city",
    "seller_state",
    "business_segment",
    "lead_behaviour_profile",
    "total_orders",
    "total_gmv",
    "days_since_last_sale",
    "overall_churn_risk",
    "risk_category",
    "urgency",
    "priority_score",
)
# Preferred columns of the exported score file, in order.
SCORE_COLUMNS = (
    "seller_id",
    "seller_state",
    "business_segment",
    "lead_behaviour_profile",
    "never_activated",
    "dormant",
    "active",
    "churned",
    "total_orders",
    "total_gmv",
    "never_activated_risk",
    "dormancy_risk",
    "overall_churn_risk",
    "risk_category",
)
# Cohorts before this month are complete.
COHORT_CUTOFF = "2018-09"
# Segments need this many sellers to count as best/worst.
MIN_SEGMENT_SUPPORT = 10
# The dashboard counts an order as the predicted class above this score.
DECISION_THRESHOLD = 0.5
# ----------------------------------------------------------------------------


@dataclass(frozen=True)
class ChurnParams:
    """Tunable thresholds (defaults equal the reference configuration)."""

    never_activated_days: int = 90
    dormant_days: int = 60
    test_size: float = 0.25
    seed: int = 42
    cv_folds: int = 5
    intervention_success_rate: float = 0.25
    retained_months: int = 3
    completed_statuses: tuple = field(default=COMPLETED_STATUSES)

    def as_dict(self) -> dict:
        d = asdict(self)
        d["completed_statuses"] = ",".join(self.completed_statuses)
        return d


DEFAULT_PARAMS = ChurnParams()
