"""The loader on CSV extracts: missing files, other column orders, extra columns, bad values."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sellerscope.sources import registry

TABLES = {
    "deals": ("deals_file", T.StructType([T.StructField("seller_id", T.StringType()), T.StructField("won_date", T.TimestampNTZType()),
                                          T.StructField("declared_monthly_revenue", T.DoubleType())])),
    "orders": ("orders_file", T.StructType([T.StructField("order_id", T.StringType()), T.StructField("price", T.DoubleType())])),
}


def write(tmp_path, stem, text):
    (tmp_path / f"{stem}.csv").write_text(text)


def test_missing_file(spark, tmp_path):
    write(tmp_path, "deals_file", "seller_id,won_date,declared_monthly_revenue\na,2020-01-01 00:00:00,1\n")
    with pytest.raises(FileNotFoundError, match="orders_file"):
        registry.TableRegistry(spark, str(tmp_path), tables=TABLES).load_all()


def test_load_all(spark, tmp_path):
    write(tmp_path, "deals_file", "note,won_date,seller_id,declared_monthly_revenue\nx,2020-03-29 02:30:00,a,1.5\ny,never,b,much\nz,,c,\n")
    write(tmp_path, "orders_file", "order_id\n1\n2\n")
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")  # 02:30 does not exist there on that day
    try:
        data = registry.TableRegistry(spark, str(tmp_path), tables=TABLES).load_all()
        rows = {r.seller_id: r for r in data["deals"].select("*", F.col("won_date").cast("string").substr(12, 5).alias("at")).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert data["deals"].columns == ["seller_id", "won_date", "declared_monthly_revenue"]
    assert rows["a"].at == "02:30" and rows["a"].declared_monthly_revenue == 1.5
    assert rows["b"].won_date is None and rows["b"].declared_monthly_revenue is None
    counts = {r.table_name: r.row_count for r in registry.row_counts(data).collect()}
    assert counts == {"deals": 3, "orders": 2}


def test_malformed_counts(spark, tmp_path):
    write(tmp_path, "deals_file", "note,won_date,seller_id,declared_monthly_revenue\nx,2020-03-29 02:30:00,a,1.5\ny,never,b,much\nz,,c,\n")
    write(tmp_path, "orders_file", "order_id\n1\n2\n")
    got = lambda t: {r["column"]: (r.malformed, r.missing) for r in registry.malformed_counts(
        spark, str(tmp_path / f"{TABLES[t][0]}.csv"), TABLES[t][1]).collect()}
    assert got("deals") == {"seller_id": (0, False), "won_date": (1, False), "declared_monthly_revenue": (1, False)}
    assert got("orders") == {"order_id": (0, False), "price": (0, True)}


def test_quarantine(spark, tmp_path):
    write(tmp_path, "deals_file", "note,won_date,seller_id,declared_monthly_revenue\nx,2020-03-29 02:30:00,a,1.5\ny,never,b,much\n"
                                  "z,,c,\nshort,,d\nlong,,e,1,2\n")
    write(tmp_path, "orders_file", "order_id\n1\n2\n3,4\n")
    loader = registry.TableRegistry(spark, str(tmp_path), tables=TABLES)
    data = loader.load_all(set_aside=True)
    assert data["deals"].columns == ["seller_id", "won_date", "declared_monthly_revenue"]
    assert sorted(r.seller_id for r in data["deals"].collect()) == ["a", "c"]
    gone = {r.record: r.reasons for r in loader.quarantined["deals"].collect()}
    assert gone["short,,d"] == gone["long,,e,1,2"] == ["record"] and len(gone) == 3
    assert [v for k, v in gone.items() if "never" in k] == [["won_date", "declared_monthly_revenue"]]
    assert data["orders"].count() == 2 and loader.quarantined["orders"].count() == 1
