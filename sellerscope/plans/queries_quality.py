"""Registered queries: data contracts."""

from __future__ import annotations

from pyspark.sql import functions as F

from sellerscope.operators import quality as Q
from sellerscope.oracle.base import q, with_ctes
from sellerscope.plans.catalog import register


def _rule_sql(rule: Q.Rule, table: str, order: int, types: dict) -> str:
    c = rule.column
    head = f"SELECT {q(rule.name)} AS rule, {q(c)} AS column_name, "
    if rule.kind == "not_null":
        body = f"count(*) - count({c})"
    elif rule.kind == "isin":
        vals = ", ".join(q(v) if isinstance(v, str) else str(v) for v in rule.arg)
        body = f"count(*) FILTER (WHERE {c} IS NOT NULL AND {c} NOT IN ({vals}))"
    elif rule.kind == "ge":
        body = f"count(*) FILTER (WHERE {c} IS NOT NULL AND {c} < {rule.arg})"
    elif rule.kind == "le":
        body = f"count(*) FILTER (WHERE {c} IS NOT NULL AND {c} > {rule.arg})"
    elif rule.kind == "unique":
        return (head + f"coalesce(sum(n), 0) AS violations, {order} AS o FROM "
                f"(SELECT count(*) AS n FROM {table} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)")
    elif rule.kind == "dtype":
        return head + f"{0 if types.get(c) == rule.arg else 1} AS violations, {order} AS o"
    return head + f"{body} AS violations, {order} AS o FROM {table}"


def _contract_sql(rules, table: str, types: dict) -> str:
    parts = " UNION ALL ".join(_rule_sql(r, table, i, types) for i, r in enumerate(rules))
    return with_ctes(f"SELECT rule, column_name, CAST(violations AS BIGINT) AS violations FROM ({parts}) ORDER BY o")


TYPES = {"won_date": "datetime", "first_contact_date": "datetime", "landing_page_id": "string", "origin": "string"}


@register("check_master", sql=_contract_sql(Q.MASTER_CONTRACT, "f_labelled", TYPES))
def q_check_master(inp):
    return Q.check_master(inp.labelled)


@register("check_leads", sql=_contract_sql(Q.LEADS_CONTRACT, "f_mqls", TYPES))
def q_check_leads(inp):
    return Q.check_leads(inp.tables["mqls"])


@register("check_deals", sql=_contract_sql(Q.DEALS_CONTRACT, "f_deals", TYPES))
def q_check_deals(inp):
    return Q.check_deals(inp.tables["deals"])


@register("check_scores", sql=_contract_sql(Q.SCORES_CONTRACT, "f_scored", TYPES))
def q_check_scores(inp):
    return Q.check_scores(inp.scored)


@register("check_items", sql=_contract_sql(Q.ITEMS_CONTRACT, "f_items", TYPES))
def q_check_items(inp):
    return Q.check_items(inp.tables["order_items"])


def _failing_sql(rules, table: str, key: str) -> str:
    bad = {"not_null": "{c} IS NULL", "ge": "{c} < {a}", "le": "{c} > {a}",
           "unique": "{c} IN (SELECT {c} FROM {t} GROUP BY {c} HAVING count(*) > 1)"}
    return with_ctes(" UNION ALL ".join(
        f"SELECT {q(r.name)} AS rule, CAST({key} AS VARCHAR) AS key, CAST({r.column} AS VARCHAR) AS value FROM {table} "
        f"WHERE {bad[r.kind].format(c=r.column, a=r.arg, t=table)}" for r in rules))


@register("failing_rows", sql=_failing_sql(Q.ITEMS_CONTRACT, "f_items", "order_id"))
def q_failing_rows(inp):
    """The order items behind every violation of ``check_items``."""
    return Q.failing_rows(inp.tables["order_items"], Q.ITEMS_CONTRACT, "order_id")


_COUNTS = " UNION ALL ".join(f"SELECT rule, violations FROM ({_rule_sql(r, 'f_items', 0, TYPES)})" for r in Q.ITEMS_CONTRACT)


@register("failing_rows_facts", sql=with_ctes(
    f"SELECT rule, CAST(violations AS BIGINT) AS rows, TRUE AS equals_count FROM ({_COUNTS})"))
def q_failing_rows_facts(inp):
    """Rows per rule against the counts of the contract."""
    items = inp.tables["order_items"]
    rows = Q.failing_rows(items, Q.ITEMS_CONTRACT, "order_id").groupBy(F.col("rule").alias("r")).agg(F.count("*").alias("rows"))
    both = Q.check_items(items).join(rows, F.col("rule") == F.col("r"), "left").withColumn("rows", F.coalesce("rows", F.lit(0)))
    return both.select("rule", "rows", (F.col("rows") == F.col("violations")).alias("equals_count"))
