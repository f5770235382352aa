"""Declarative table contracts, evaluated as one aggregation pass.

A contract is a list of rules; ``run_contract`` returns one row per rule
(rule, column, violations). Value rules ignore NULLs (a nullable column's
missing values are not violations); ``not_null`` and ``unique`` are explicit
rules. Uniqueness counts every row whose key occurs more than once and is
the one extra aggregation (a grouped count on the key, partially
aggregated, so a hot key costs one row per map task).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sellerscope import config as C


@dataclass(frozen=True)
class Rule:
    kind: str  # not_null | unique | isin | ge | le | dtype
    column: str
    arg: object = None

    @property
    def name(self) -> str:
        return f"{self.column}:{self.kind}" + ("" if self.arg is None or self.kind == "dtype" else f"({self.arg})")


def _bad(r: Rule):
    """Whether a row fails a value rule."""
    c = F.col(r.column)
    if r.kind == "not_null":
        bad = c.isNull()
    elif r.kind == "isin":
        bad = c.isNotNull() & ~c.isin(*r.arg)
    elif r.kind == "ge":
        bad = c.isNotNull() & (c < F.lit(r.arg))
    elif r.kind == "le":
        bad = c.isNotNull() & (c > F.lit(r.arg))
    else:
        raise ValueError(r.kind)
    return bad


def _violation(r: Rule, df: DataFrame):
    return F.sum(_bad(r).cast("long"))


_DTYPES = {
    "string": (T.StringType, T.LongType, T.IntegerType),  # ids may be numeric keys
    "datetime": (T.TimestampNTZType, T.TimestampType, T.DateType),
    "int": (T.IntegerType, T.LongType, T.ShortType, T.ByteType),
    "float": (T.DoubleType, T.FloatType, T.DecimalType, T.LongType, T.IntegerType),
}


def run_contract(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """(rule, column, violations) for every rule, in rule order. A missing
    column is one violation of every rule on it; a type rule is 0/1."""
    spark = df.sparkSession
    value_rules = [r for r in rules if r.kind not in ("unique", "dtype") and r.column in df.columns]
    aggs = [_violation(r, df).alias(f"r{i}") for i, r in enumerate(value_rules)]
    one = df.agg(*aggs) if aggs else spark.range(1).select()
    parts = []
    for i, r in enumerate(value_rules):
        parts.append((r, F.coalesce(F.col(f"r{i}"), F.lit(0)).cast("long")))
    out = one.select(*[F.struct(F.lit(r.name).alias("rule"), F.lit(r.column).alias("column_name"),
                                v.alias("violations"), F.lit(rules.index(r)).alias("rule_order"))
                       .alias(f"s{i}") for i, (r, v) in enumerate(parts)]) if parts else None
    tables = []
    if out is not None:
        tables.append(out.select(F.explode(F.array(*[F.col(f"s{i}") for i in range(len(parts))])).alias("x"))
                      .select("x.*"))
    for r in rules:
        order = rules.index(r)
        if r.column not in df.columns:
            tables.append(spark.range(1).select(F.lit(r.name).alias("rule"), F.lit(r.column).alias("column_name"),
                                                F.lit(1).cast("long").alias("violations"),
                                                F.lit(order).alias("rule_order")))
        elif r.kind == "unique":
            dup = (df.filter(F.col(r.column).isNotNull()).groupBy(r.column).count()
                   .filter(F.col("count") > 1).agg(F.coalesce(F.sum("count"), F.lit(0)).alias("violations")))
            tables.append(dup.select(F.lit(r.name).alias("rule"), F.lit(r.column).alias("column_name"),
                                     F.col("violations").cast("long"), F.lit(order).alias("rule_order")))
        elif r.kind == "dtype":
            ok = isinstance(df.schema[r.column].dataType, _DTYPES[r.arg])
            tables.append(spark.range(1).select(F.lit(r.name).alias("rule"), F.lit(r.column).alias("column_name"),
                                                F.lit(0 if ok else 1).cast("long").alias("violations"),
                                                F.lit(order).alias("rule_order")))
    res = tables[0]
    for t in tables[1:]:
        res = res.unionByName(t)
    return res.orderBy("rule_order").drop("rule_order")


def failing_rows(df: DataFrame, rules: list[Rule], key: str) -> DataFrame:
    """(rule, key, value) of every row and rule it fails, both as text: the rows behind
    the counts of ``run_contract``. Value rules are one pass that explodes a row's failed
    rules; a uniqueness rule joins the values that occur more than once, from one
    count per value. Rules of a missing column, or of a type, name no row."""
    value_rules = [r for r in rules if r.kind not in ("unique", "dtype") and r.column in df.columns]
    failed = F.array_compact(F.array(*[
        F.when(_bad(r), F.struct(F.lit(r.name).alias("rule"), F.col(r.column).cast("string").alias("value"))) for r in value_rules]))
    own = F.col(key).cast("string").alias("key")
    out = df.sparkSession.createDataFrame([], "rule string, key string, value string")
    if value_rules:
        out = out.union(df.select(own, F.explode(failed).alias("f")).select("f.rule", "key", "f.value"))
    for r in (r for r in rules if r.kind == "unique" and r.column in df.columns):
        often = (df.filter(F.col(r.column).isNotNull()).groupBy(F.col(r.column).alias("_value")).count()
                 .filter(F.col("count") > 1).select("_value"))
        rows = df.select(own, F.col(r.column).alias("_own")).join(often, F.col("_own") == F.col("_value"), "left_semi")
        out = out.union(rows.select(F.lit(r.name).alias("rule"), "key", F.col("_own").cast("string").alias("value")))
    return out


FLAGS = ("never_activated", "dormant", "active", "churned")

MASTER_CONTRACT = [
    Rule("not_null", "seller_id"), Rule("unique", "seller_id"),
    Rule("not_null", "won_date"), Rule("dtype", "won_date", "datetime"),
    Rule("ge", "total_orders", 0), Rule("ge", "total_gmv", 0),
    *[Rule("isin", f, (0, 1)) for f in FLAGS],
]
LEADS_CONTRACT = [
    Rule("not_null", "mql_id"), Rule("unique", "mql_id"),
    Rule("dtype", "first_contact_date", "datetime"),
    Rule("dtype", "landing_page_id", "string"), Rule("dtype", "origin", "string"),
]
DEALS_CONTRACT = [
    Rule("not_null", "mql_id"), Rule("not_null", "seller_id"), Rule("unique", "seller_id"),
    Rule("not_null", "won_date"),
]
ITEMS_CONTRACT = [
    Rule("not_null", "order_id"), Rule("unique", "order_id"), Rule("not_null", "seller_id"),
    Rule("ge", "price", 0), Rule("le", "price", 90_000), Rule("le", "freight_value", 7_000),
]
SCORES_CONTRACT = [
    Rule("not_null", "seller_id"), Rule("unique", "seller_id"),
    *[r for c in ("never_activated_risk", "dormancy_risk", "overall_churn_risk")
      for r in (Rule("ge", c, 0), Rule("le", c, 1))],
    Rule("not_null", "overall_churn_risk"),
    Rule("isin", "risk_category", C.RISK_LABELS),
]


def check_master(df: DataFrame) -> DataFrame:
    return run_contract(df, MASTER_CONTRACT)


def check_leads(df: DataFrame) -> DataFrame:
    return run_contract(df, LEADS_CONTRACT)


def check_deals(df: DataFrame) -> DataFrame:
    return run_contract(df, DEALS_CONTRACT)


def check_items(df: DataFrame) -> DataFrame:
    return run_contract(df, ITEMS_CONTRACT)


def check_scores(df: DataFrame) -> DataFrame:
    return run_contract(df, SCORES_CONTRACT)


def raise_on_violations(report: DataFrame) -> None:
    """Optional strict mode: fail when any rule has violations (one small
    fetch of the failing rule names)."""
    bad = report.filter(F.col("violations") > 0).select("rule").collect()  # a row per rule at most
    if bad:
        raise ValueError("contract violations: " + ", ".join(r.rule for r in bad))
