"""Shared lazy inputs of the registered queries for one data folder."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from sellerscope.config import DEFAULT_PARAMS, ChurnParams
from sellerscope.operators import labels, master, risk
from sellerscope.sources import fixture


class Inputs:
    """Tables and stage outputs derived from ``sf_dir``; nothing is computed
    until an action runs on a returned DataFrame."""

    def __init__(self, spark: SparkSession, sf_dir: str, params: ChurnParams = DEFAULT_PARAMS):
        self.spark = spark
        self.sf_dir = sf_dir
        self.params = params

    @cached_property
    def tables(self) -> dict[str, DataFrame]:
        return fixture.funnel_tables(self.spark, self.sf_dir)

    @cached_property
    def seller_master(self) -> DataFrame:
        return master.seller_master(self.tables)

    @cached_property
    def activity(self) -> DataFrame:
        return master.seller_activity_metrics(self.tables["order_items"], self.tables["orders"],
                                              self.params.completed_statuses)

    @cached_property
    def master(self) -> DataFrame:
        """Filled master without labels."""
        return master.handle_missing_values(master.join_activity(self.seller_master, self.activity))

    @cached_property
    def labelled(self) -> DataFrame:
        return labels.define_churn_labels(self.master, self.params)

    @cached_property
    def notebook(self) -> DataFrame:
        """The notebook's master (fewer fills) with labels."""
        nb = master.build_notebook_master(self.tables, self.params.completed_statuses)
        return labels.define_churn_labels(nb, self.params)

    @cached_property
    def scored(self) -> DataFrame:
        return risk.formula_scores(self.labelled, self.params.dormant_days)

    @cached_property
    def notebook_scored(self) -> DataFrame:
        """Notebook scoring: dormancy risk overrides, suffixed labels. The
        formula's half-way point is half the dormancy bound, so active sellers
        reach the at-risk range."""
        from sellerscope import config as C
        return risk.formula_scores(self.notebook, self.params.dormant_days // 2, override=True,
                                   labels=C.NOTEBOOK_RISK_LABELS)
