"""Sinks: projected exports, CSV/parquet writers."""

from __future__ import annotations

from pyspark.sql import DataFrame


def project_available(df: DataFrame, preferred) -> DataFrame:
    """Ordered projection restricted to the preferred columns that exist."""
    return df.select(*[c for c in preferred if c in df.columns])


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write (overwrite, so an empty result replaces an old one too), with a header row for CSV."""
    w = df.write.mode("overwrite")
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.parquet(path)


def read_back(spark, path: str, fmt: str = "parquet", schema=None) -> DataFrame:
    if fmt == "csv":
        r = spark.read.option("header", True)
        return (r.schema(schema) if schema is not None else r.option("inferSchema", True)).csv(path)
    return spark.read.parquet(path)
