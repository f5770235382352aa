"""Feature pipelines (``pyspark.ml``): preprocessing, encoders, assembler.

All preprocessing is a stage (``SQLTransformer`` or the dictionary encoder), so the
fitted ``PipelineModel`` carries the encoders and fills with it: scoring a new batch
reuses the training encoding (unseen labels get an extra code) instead of
refitting per batch.

Encoded columns are the label's rank in text order as a plain double, i.e.
integer codes used as numbers, so trees do not treat them as nominal (which
would also cap them at ``maxBins``).
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sellerscope import config as C
from sellerscope.operators.encoding import DictionaryEncoder

CATEGORICALS = ("lead_behaviour_profile", "business_segment", "lead_type", "business_type",
                "origin", "seller_state")
PRE_NUMERIC = ("declared_monthly_revenue", "declared_product_catalog_size", "sales_cycle_days")
FEATURES_COL = "features"


def _sql_fill_numeric(cols) -> str:
    return ", ".join(f"CAST(coalesce({c}, 0) AS DOUBLE) AS {c}" for c in cols)


def _encoder_stages(missing_label: str | None, seller_state_missing: str | None):
    """Text preparation and the dictionary encoder."""
    prep = []
    for c in CATEGORICALS:
        miss = seller_state_missing if c == "seller_state" else missing_label
        expr = f"CAST({c} AS STRING)" if miss is None else f"coalesce(CAST({c} AS STRING), '{miss}')"
        prep.append(f"{expr} AS {c}_text")
    prep_sql = SQLTransformer(statement=f"SELECT *, {', '.join(prep)} FROM __THIS__")
    encoder = DictionaryEncoder(inputCols=[f"{c}_text" for c in CATEGORICALS],
                                outputCols=[f"{c}_encoded" for c in CATEGORICALS])
    return [prep_sql, encoder]


def pre_activation_pipeline(wide: bool = False) -> Pipeline:
    """Pre-activation features: 6 encoded categoricals + 3 numerics (the
    notebook's wide variant adds company/GTIN flags and two zero flags and
    fills categoricals with 'unknown', leaving seller_state as 'nan')."""
    if wide:
        stages = _encoder_stages("unknown", "nan")
        extra = SQLTransformer(statement=(
            "SELECT *, " + ", ".join(f"CAST(coalesce({c}, 0) AS DOUBLE) AS _f_{c}" for c in PRE_NUMERIC) + ", "
            "CAST(CASE WHEN CAST(has_company AS STRING) IN ('True','true') THEN 1 ELSE 0 END AS DOUBLE)"
            " AS has_company_binary, "
            "CAST(CASE WHEN CAST(has_gtin AS STRING) IN ('True','true') THEN 1 ELSE 0 END AS DOUBLE)"
            " AS has_gtin_binary FROM __THIS__"))
        rename = SQLTransformer(statement=(
            "SELECT * EXCEPT (" + ", ".join(PRE_NUMERIC) + "), "
            + ", ".join(f"_f_{c} AS {c}" for c in PRE_NUMERIC) + " FROM __THIS__"))
        zeros = SQLTransformer(statement=(
            "SELECT *, CAST(declared_monthly_revenue = 0 AS DOUBLE) AS declared_revenue_zero, "
            "CAST(declared_product_catalog_size = 0 AS DOUBLE) AS declared_catalog_zero FROM __THIS__"))
        cols = list(C.PRE_ACTIVATION_FEATURES) + list(C.WIDE_EXTRA_FEATURES)
        stages += [extra, rename, zeros]
    else:
        stages = _encoder_stages(None, None)
        fill = SQLTransformer(statement=(
            "SELECT * EXCEPT (" + ", ".join(PRE_NUMERIC) + "), " + _sql_fill_numeric(PRE_NUMERIC)
            + " FROM __THIS__"))
        cols = list(C.PRE_ACTIVATION_FEATURES)
        stages += [fill]
    stages.append(VectorAssembler(inputCols=cols, outputCol=FEATURES_COL, handleInvalid="keep"))
    return Pipeline(stages=stages)


def retention_feature_list(eleven: bool = False, wide: bool = False) -> list[str]:
    """The reference trains on the 9 of 11 listed columns present in the
    un-encoded activated frame; ``eleven`` keeps the two encoded ones."""
    if wide:
        return list(C.PRE_ACTIVATION_FEATURES) + list(C.WIDE_EXTRA_FEATURES) + list(C.WIDE_ACTIVITY_FEATURES)
    if eleven:
        return list(C.RETENTION_FEATURES)
    return [c for c in C.RETENTION_FEATURES if not c.endswith("_encoded")]


def retention_pipeline(eleven: bool = False, wide: bool = False) -> Pipeline:
    """Activity features (+ ratios and speed score); NULL/inf -> 0."""
    cols = retention_feature_list(eleven, wide)
    act_cols = [c for c in cols if not c.endswith("_encoded") and c not in C.WIDE_EXTRA_FEATURES
                and c not in C.PRE_ACTIVATION_FEATURES]
    stages = []
    if wide or eleven:
        stages += pre_activation_pipeline(wide=wide).getStages()[:-1]
    ratios = SQLTransformer(statement=(
        "SELECT *, "
        "CAST(total_gmv AS DOUBLE) / CAST(greatest(total_orders, 1) AS DOUBLE) AS gmv_per_order, "
        "CAST(unique_customers AS DOUBLE) / CAST(greatest(total_orders, 1) AS DOUBLE) AS customers_per_order, "
        "CAST(CASE WHEN days_to_first_sale <= 7 THEN 3 WHEN days_to_first_sale <= 30 THEN 2 ELSE 1 END AS DOUBLE)"
        " AS activation_speed_score FROM __THIS__"))
    clean = SQLTransformer(statement=(
        "SELECT *, " + ", ".join(
            f"CASE WHEN isnull(CAST({c} AS DOUBLE)) OR abs(CAST({c} AS DOUBLE)) = double('inf') THEN 0D "
            f"ELSE CAST({c} AS DOUBLE) END AS _r_{c}" for c in act_cols) + " FROM __THIS__"))
    vec_cols = [f"_r_{c}" if c in act_cols else c for c in cols]
    stages += [ratios, clean, VectorAssembler(inputCols=vec_cols, outputCol=FEATURES_COL, handleInvalid="keep")]
    return Pipeline(stages=stages)


def feature_frame(model, df: DataFrame, cols: list[str], keep=("seller_id",)) -> DataFrame:
    """Apply a fitted feature pipeline and return the named feature columns."""
    out = model.transform(df)
    pick = [f"_r_{c}" if f"_r_{c}" in out.columns else c for c in cols]
    return out.select(*keep, *[F.col(p).alias(c) for p, c in zip(pick, cols)])
