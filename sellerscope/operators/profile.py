"""Table profiling: null counts and date ranges in one aggregation pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_counts(df: DataFrame, columns=None) -> DataFrame:
    """(column_name, null_count) for columns with at least one NULL."""
    cols = [c for c in (columns or df.columns) if c in df.columns]
    one = df.agg(*[(F.count(F.lit(1)) - F.count(F.col(c))).alias(c) for c in cols])
    return one.unpivot([], cols, "column_name", "null_count").filter(F.col("null_count") > 0)


def date_ranges(df: DataFrame, columns) -> DataFrame:
    """One row: ``<col>_min`` / ``<col>_max`` of each date column."""
    aggs = []
    for c in columns:
        aggs += [F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max")]
    return df.agg(*aggs)


def pandas_divide(num: Column, den: Column) -> Column:
    """Division with numpy semantics (x/0 -> +-inf, 0/0 -> NaN) instead of
    the ANSI error, for operators that later replace the infinities."""
    n, d = num.cast("double"), den.cast("double")
    return (F.when(d == 0, F.when(n > 0, F.lit(float("inf"))).when(n < 0, F.lit(float("-inf")))
                   .otherwise(F.lit(float("nan"))))
            .otherwise(n / d))
