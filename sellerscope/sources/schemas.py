"""Declared schemas of the marketplace extracts (no schema inference).

Only the columns the analytics read are declared for the five tables that
are used; CSV readers ignore extra columns only when ``enforceSchema`` is
off, so the registry reads the header and selects these by name.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, D, TS, B = T.StringType(), T.DoubleType(), T.TimestampNTZType(), T.BooleanType()


def _schema(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


DEALS = _schema(
    ("mql_id", S), ("seller_id", S), ("won_date", TS),
    ("business_segment", S), ("lead_type", S), ("lead_behaviour_profile", S),
    ("has_company", S), ("has_gtin", S),
    ("business_type", S), ("declared_product_catalog_size", D), ("declared_monthly_revenue", D),
)
MQLS = _schema(("mql_id", S), ("first_contact_date", TS), ("landing_page_id", S), ("origin", S))
SELLERS = _schema(("seller_id", S), ("seller_zip_code_prefix", S), ("seller_city", S), ("seller_state", S))
ORDERS = _schema(
    ("order_id", S), ("customer_id", S), ("order_status", S),
    ("order_purchase_timestamp", TS), ("order_approved_at", TS),
    ("order_delivered_carrier_date", TS), ("order_delivered_customer_date", TS),
    ("order_estimated_delivery_date", TS),
)
ORDER_ITEMS = _schema(
    ("order_id", S), ("order_item_id", T.IntegerType()), ("product_id", S), ("seller_id", S),
    ("shipping_limit_date", TS), ("price", D), ("freight_value", D),
)

# --- fixed values: file stems of the public marketplace extracts ------------
# Registry name -> (file stem, schema). The last five are registered but no
# column of them is read; they stay lazy here. Pass ``tables=`` to
# TableRegistry for other file names.
TABLES = {
    "mqls": ("olist_marketing_qualified_leads_dataset", MQLS),
    "deals": ("olist_closed_deals_dataset", DEALS),
    "sellers": ("olist_sellers_dataset", SELLERS),
    "orders": ("olist_orders_dataset", ORDERS),
    "order_items": ("olist_order_items_dataset", ORDER_ITEMS),
    "products": ("olist_products_dataset", None),
    "customers": ("olist_customers_dataset", None),
    "reviews": ("olist_order_reviews_dataset", None),
    "payments": ("olist_order_payments_dataset", None),
    "translation": ("product_category_name_translation", None),
}

# Date columns parsed per table.
DATE_COLUMNS = {
    "deals": ("won_date",),
    "orders": ("order_purchase_timestamp", "order_delivered_customer_date"),
    "mqls": ("first_contact_date",),
}
