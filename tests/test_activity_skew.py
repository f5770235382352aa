"""Seller activity against pandas, including a seller with a third of all items."""

from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest

from sellerscope import config as C
from sellerscope.operators import master, segments
from sellerscope.plans import features as FE


@pytest.fixture(scope="module")
def orders_items(spark):
    rng = np.random.default_rng(3)
    n_orders, n_items = 4000, 12000
    base = datetime(2017, 1, 1)
    orders = pd.DataFrame({
        "order_id": np.arange(n_orders),
        "customer_id": rng.integers(0, 1500, n_orders),
        "order_status": rng.choice(["delivered", "shipped", "canceled", "approved"], n_orders),
        "order_purchase_timestamp": [base + timedelta(minutes=int(m)) for m in rng.integers(0, 600_000, n_orders)],
    })
    seller = rng.integers(1, 300, n_items)
    seller[: n_items // 3] = 0  # hot seller: a third of all items
    items = pd.DataFrame({"order_id": rng.integers(0, n_orders, n_items), "seller_id": seller,
                          "price": np.round(rng.gamma(2.0, 50.0, n_items), 2),
                          "freight_value": np.round(rng.gamma(2.0, 5.0, n_items), 2)})
    return orders, items, spark.createDataFrame(orders).repartition(5), spark.createDataFrame(items).repartition(7)


def test_activity_matches_pandas_with_hot_seller(orders_items):
    orders, items, so, si = orders_items
    got = master.seller_activity(master.completed_items(si, so)).toPandas().set_index("seller_id").sort_index()
    m = items.merge(orders, on="order_id")
    m = m[m.order_status.isin(C.COMPLETED_STATUSES)]
    exp = m.groupby("seller_id").agg(total_orders=("order_id", "nunique"), unique_customers=("customer_id", "nunique"),
                                     total_gmv=("price", "sum"), avg_order_value=("price", "mean"),
                                     std_order_value=("price", "std"), total_freight=("freight_value", "sum"),
                                     total_items_sold=("order_purchase_timestamp", "count"))
    assert list(got.index) == list(exp.index)
    for c in exp.columns:
        assert np.allclose(got[c].astype(float), exp[c].astype(float), rtol=1e-9, atol=1e-6, equal_nan=True), c
    assert got.loc[0, "total_items_sold"] > 2500  # the hot seller is really there


def test_orders_of_more_customers(spark):
    """Repeated orders with other or no customers count once; the figures of an order are not gathered as sets."""
    orders = [(1, 10), (1, 11), (1, 12), (1, 11), (2, None), (2, 10), (3, None), (4, 13)]
    so = spark.createDataFrame([(o, c, "delivered", datetime(2020, 1, o)) for o, c in orders],
                               "order_id long, customer_id long, order_status string, order_purchase_timestamp timestamp_ntz")
    si = spark.createDataFrame([(1, 7, 1.25), (1, 7, 2.5), (2, 7, None), (3, 7, 4.0), (4, 8, 0.1), (3, None, 5.0)],
                               "order_id long, seller_id long, price double").selectExpr("*", "price AS freight_value")
    act = master.seller_activity(master.completed_items(si, so))
    got = {r.seller_id: r for r in act.collect()}
    assert set(got) == {7, 8, None}
    r = got[7]
    assert (r.total_orders, r.unique_customers, r.total_items_sold, r.total_gmv) == (3, 3, 11, 19.0)
    assert r.std_order_value == pytest.approx(np.std([1.25] * 4 + [2.5] * 4 + [4.0], ddof=1))
    assert (r.first_sale_date, r.last_sale_date) == (datetime(2020, 1, 1), datetime(2020, 1, 3))
    assert (got[8].total_orders, got[8].std_order_value, got[None].unique_customers) == (1, None, 0)
    assert "ObjectHashAggregate" not in act._jdf.queryExecution().executedPlan().toString()


def test_std_edge_cases(spark):
    df = spark.createDataFrame([(1, 10.0), (2, 5.25), (2, 5.25), (2, 5.25), (3, 1.0), (3, 3.0)],
                               "seller_id long, price double")
    df = df.selectExpr("seller_id", "seller_id AS order_id", "seller_id AS customer_id", "price",
                       "price AS freight_value", "timestamp_ntz'2020-01-01 00:00:00' AS order_purchase_timestamp")
    got = {r.seller_id: r.std_order_value for r in master.seller_activity(df).collect()}
    assert got[1] is None        # one row: NULL (pandas NaN)
    assert got[2] == 0.0         # equal values: exactly 0
    assert got[3] == pytest.approx(np.std([1.0, 3.0], ddof=1), abs=0)


def test_retention_feature_lists():
    assert len(FE.retention_feature_list()) == 9
    assert len(FE.retention_feature_list(eleven=True)) == 11
    assert len(FE.retention_feature_list(wide=True)) == 19


def test_state_top10_drops_missing(spark):
    rows = [(i, "A" if i % 3 else None, 1, 0, 1, 10.0) for i in range(30)]
    df = spark.createDataFrame(rows, "seller_id long, seller_state string, churned int, never_activated int, "
                                     "active int, total_gmv double")
    out = segments.segment_state_top10(df).collect()
    assert [r.State for r in out] == ["A"] and out[0].Total_Sellers == 20
