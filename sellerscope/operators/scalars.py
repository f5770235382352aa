"""Attaching one-row aggregates (totals, bounds, quantiles, end date)."""

from __future__ import annotations

from pyspark.sql import DataFrame


def attach_scalars(df: DataFrame, one_row: DataFrame, columns=None) -> DataFrame:
    """Add the columns of ``one_row`` (a global aggregate, exactly one row)
    to every row of ``df`` as scalar subqueries: the value is computed once
    and shipped to the tasks like a literal. Spark raises if the subquery
    ever returns more than one row, so the bound is enforced, not assumed,
    and no join of two tables takes place."""
    cols = list(columns or one_row.columns)
    return df.withColumns({c: one_row.select(c).scalar() for c in cols})
