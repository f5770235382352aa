"""Adapter from the TPC-H-like test tables to the funnel / order shapes.

The seller role is played by ``part`` (an order holds items of many parts
and has one customer), ``k = p_partkey``, and by ``customer``, whose keys,
moved by ``CUSTOMER_OFFSET``, own no item: these sellers never sold. The
attribute rules are plain arithmetic on ``k`` so the DuckDB oracle can state
them identically. Every row of every table is used; a lead or location that
shall not match has its key negated.
Nothing here collects: each table is a lazy projection of a parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values of the adapter (must equal the oracle's) -------------------
BASE_DATE = "1994-07-01 00:00:00"
LEAD_TYPES = ("online_big", "online_medium", "online_small", "offline", "industry",
              "online_top", "online_beginner", "other", None)
PROFILES = ("cat", "eagle", "wolf", "shark", "eagle, cat", None)
BUSINESS_TYPES = ("reseller", "manufacturer", None)
ORDER_STATUS = {"F": "delivered", "O": "shipped", "P": "canceled"}
CUSTOMER_OFFSET = 1_000_000_000
# -----------------------------------------------------------------------------


def _pick(index: F.Column, values) -> F.Column:
    """values[index] as a CASE chain (NULL entries stay NULL)."""
    expr = None
    for i, v in enumerate(values):
        cond = index == i
        lit = F.lit(v).cast("string")
        expr = F.when(cond, lit) if expr is None else expr.when(cond, lit)
    return expr


def _won_date(k: F.Column) -> F.Column:
    base = F.to_timestamp_ntz(F.lit(BASE_DATE))
    day = F.timestamp_add("DAY", (k * 37) % 2000, base)
    return F.timestamp_add("SECOND", (k * 7919) % 86400, day)


def _path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


_SCANS: dict = {}


def _scan(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet relation per (application, table): file listing and
    footer reads happen once on the driver, not once per derived table."""
    key = (spark.sparkContext.applicationId, _path(sf_dir, name))
    if key not in _SCANS:
        _SCANS[key] = spark.read.parquet(key[1])
    return _SCANS[key]


def _deal(k: F.Column, segment: F.Column, price: F.Column, size: F.Column) -> list[F.Column]:
    return [
        k.alias("mql_id"),
        k.alias("seller_id"),
        _won_date(k).alias("won_date"),
        (F.when(k % 50 == 0, F.lit(None).cast("string"))
         .when(k % 499 == 1, F.concat(F.lit("NICHE_"), (k % 5).cast("string")))  # thin groups
         .otherwise(segment)).alias("business_segment"),
        _pick(k % 9, LEAD_TYPES).alias("lead_type"),
        _pick(F.floor(k / 9) % 6, PROFILES).alias("lead_behaviour_profile"),
        _pick(k % 3, BUSINESS_TYPES).alias("business_type"),
        (F.when(k % 4 == 0, F.lit(None).cast("double"))
         .when(k % 4 == 1, F.lit(0.0))
         .when(k % 4 == 2, price)
         .otherwise(price * 12)).alias("declared_monthly_revenue"),
        (F.when(k % 5 == 0, F.lit(None).cast("double"))
         .when(k % 5 == 1, F.lit(0.0))
         .otherwise(size.cast("double"))).alias("declared_product_catalog_size"),
        (F.when(k % 3 == 0, F.lit(None).cast("boolean"))
         .when(k % 3 == 1, F.lit(True))
         .otherwise(F.lit(False))).alias("has_company"),
        (k % 2 == 0).alias("has_gtin"),
    ]


def deals(spark: SparkSession, sf_dir: str) -> DataFrame:
    part, customer = _scan(spark, sf_dir, "part"), _scan(spark, sf_dir, "customer")
    sold = part.select(*_deal(F.col("p_partkey"), F.col("p_brand"), F.col("p_retailprice").cast("double"), F.col("p_size")))
    never = customer.select(*_deal(F.col("c_custkey") + CUSTOMER_OFFSET, F.col("c_mktsegment"),
                                   F.abs("c_acctbal").cast("double"), F.col("c_custkey") % 50 + 1))
    return sold.unionByName(never)


def mqls(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = _scan(spark, sf_dir, "part")
    k = F.col("p_partkey")
    first = F.timestamp_add("DAY", -((k * 13) % 120), _won_date(k))
    return part.select(
        F.when(k % 20 == 0, -k).otherwise(k).alias("mql_id"),
        F.when(k % 11 == 0, F.lit(None).cast("timestamp_ntz")).otherwise(first).alias("first_contact_date"),
        F.concat(F.lit("lp"), F.col("p_size").cast("string")).alias("landing_page_id"),
        F.when(k % 17 == 0, F.lit(None).cast("string")).otherwise(F.col("p_type")).alias("origin"),
    )


def sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = _scan(spark, sf_dir, "part")
    # nation has 25 rows by definition of the schema: a proven broadcast bound
    nation = _scan(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    k = F.col("p_partkey")
    return (part.join(F.broadcast(nation), (k % 25) == F.col("n_nationkey"), "inner")
            .select(F.when(k % 10 == 9, -k).otherwise(k).alias("seller_id"),
                    F.concat(F.lit("CITY_"), F.col("p_size").cast("string")).alias("seller_city"),
                    F.col("n_name").alias("seller_state")))


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _scan(spark, sf_dir, "orders")
    status = None
    for code, name in ORDER_STATUS.items():
        cond = F.col("o_orderstatus") == code
        status = F.when(cond, F.lit(name)) if status is None else status.when(cond, F.lit(name))
    return o.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        status.alias("order_status"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("order_purchase_timestamp"),
        F.lit(None).cast("timestamp_ntz").alias("order_delivered_customer_date"),
    )


def _items(li: DataFrame, seller_col: str, free: F.Column | None = None) -> DataFrame:
    """Lines as items; ``free`` marks those given away: sales and freight without revenue."""
    price = F.col("l_extendedprice")
    freight = F.round(price.cast("decimal(18,2)") * F.col("l_tax").cast("decimal(6,4)"), 2)
    return li.select(
        F.col("l_orderkey").alias("order_id"),
        F.col(seller_col).alias("seller_id"),
        (price.cast("double") if free is None else F.when(free, F.lit(0.0)).otherwise(price.cast("double"))).alias("price"),
        freight.cast("double").alias("freight_value"),
    )


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line item, the part as seller."""
    return _items(_scan(spark, sf_dir, "lineitem"), "l_partkey", F.col("l_partkey") % 40 == 7)


def order_items_by_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line item, the supplier as seller (repeat buyers and multi-item orders)."""
    li = _scan(spark, sf_dir, "lineitem")
    return _items(li, "l_suppkey")


def funnel_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The five tables the analytics read, keyed like the registry."""
    return {
        "deals": deals(spark, sf_dir),
        "mqls": mqls(spark, sf_dir),
        "sellers": sellers(spark, sf_dir),
        "orders": orders(spark, sf_dir),
        "order_items": order_items(spark, sf_dir),
    }
