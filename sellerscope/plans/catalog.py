"""Registry of named queries: Spark builder + DuckDB oracle SQL.

A builder takes ``Inputs`` (lazy tables for one data folder) and returns a
DataFrame. Column names are aliased identically on both sides.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from sellerscope.plans.context import Inputs


@dataclass
class Query:
    name: str
    build: Callable[[Inputs], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql)
        return fn
    return deco


def _load_modules() -> None:
    # importing the query modules fills REGISTRY
    from sellerscope.plans import (queries_analysis, queries_ml, queries_ops, queries_quality,  # noqa: F401
                                   queries_ranking, queries_segments)


def spark_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load_modules()

    def bind(q: Query):
        return lambda spark, sf_dir: q.build(Inputs(spark, sf_dir))
    return {name: bind(q) for name, q in REGISTRY.items()}


def oracle_queries() -> dict[str, str]:
    _load_modules()
    return {name: q.sql for name, q in REGISTRY.items() if q.sql is not None}
