"""Scoring every seller with the fitted stage models, and the run drivers.

Both models score in one pass over the master: the retention model's
probability is kept only for activated sellers (a conditional column, not a
filter + join back), so scoring adds no shuffle.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sellerscope import config as C
from sellerscope.config import DEFAULT_PARAMS, ChurnParams
from sellerscope.operators.ranking import materialize
from sellerscope.operators.risk import combine_risk
from sellerscope.plans import training as TR


def score_sellers(master: DataFrame, pre_model: PipelineModel | None,
                  ret_model: PipelineModel | None, override: bool = False) -> DataFrame:
    """never_activated_risk (all), dormancy_risk (activated only, NULL
    otherwise), overall risk and category."""
    if pre_model is None:
        raise ValueError("no pre-activation model: nothing to score")
    out = TR.positive_probability(pre_model, master, "never_activated_risk")
    if ret_model is not None:
        out = TR.positive_probability(ret_model, out, "_ret")
        out = out.withColumn("dormancy_risk", F.when(F.col("never_activated") == 0, F.col("_ret"))).drop("_ret")
    else:
        out = out.withColumn("dormancy_risk", F.lit(None).cast("double"))
    return combine_risk(out, override)


def attach_dormancy_risk(master: DataFrame, subset_scores: DataFrame, key: str = "seller_id") -> DataFrame:
    """Generic form: scores computed on a subset, attached by key (others NULL)."""
    return master.join(subset_scores.select(key, "dormancy_risk"), key, "left")


def score_columns(scored: DataFrame) -> DataFrame:
    """The preferred exported columns that exist, in order."""
    return scored.select(*[c for c in C.SCORE_COLUMNS if c in scored.columns])


def train_and_score(labelled: DataFrame, params: ChurnParams = DEFAULT_PARAMS, algorithms=TR.ALGORITHMS):
    """The training run's model part: both stages, then scoring of all
    sellers (scores are in-sample for training rows, as in the reference)."""
    labelled = materialize(labelled)
    pre = TR.pre_activation(labelled, params, algorithms=algorithms)
    ret = TR.retention(labelled, params, algorithms=algorithms)
    scored = score_sellers(labelled, pre.model, ret.model) if pre.model is not None else None
    return pre, ret, scored
