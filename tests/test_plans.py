"""Plan regressions: pruning, no cartesian products, no Python in headline plans."""

import pytest

from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def plans(spark):
    from bench import HEADLINE
    from __spark_entry__ import queries
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    qs = queries()
    return {n: qs[n](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString() for n in HEADLINE}


def test_no_cartesian_or_python(plans):
    for name, plan in plans.items():
        assert "CartesianProduct" not in plan, name
        assert "BroadcastNestedLoopJoin" not in plan, name
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name


def test_flagship_pruning(plans):
    plan = plans["cohort_analysis"]
    # only the needed columns are read from lineitem
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_extendedprice:double>" in plan


def test_adapter_keeps_every_row(spark):
    from sellerscope.sources import fixture
    tables, scan = fixture.funnel_tables(spark, SF_SMALL), lambda t: spark.read.parquet(f"{SF_SMALL}/{t}.parquet").count()
    assert tables["order_items"].count() == scan("lineitem")
    assert tables["orders"].count() == scan("orders")
    assert tables["mqls"].count() == tables["sellers"].count() == scan("part")
    assert tables["deals"].count() == scan("part") + scan("customer")


def test_scans_are_pruned(plans):
    for name, plan in plans.items():
        for line in plan.splitlines():
            if "FileScan parquet" in line and "lineitem" in line:
                schema = line.split("ReadSchema: ")[1]
                assert schema.count(":") <= 5, (name, schema)   # lineitem has 11 columns
