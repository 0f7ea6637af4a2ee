"""Source and target schemas, plus the fixed values the outputs depend on.

Identifier columns are 64-bit everywhere.  The source DDL declared them as
32-bit INT, but a multi-terabyte order history passes 2**31 orders, and the
warehouse targets are 64-bit already, so widening at the source avoids an
overflow cast in the middle of a job.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must stay equal to the source system's for right results)
# ---------------------------------------------------------------------------
# Order status values written by the source system, in lifecycle order.
STATUS_RECEIVED = "Received"
STATUS_IN_PROGRESS = "InProgress"
STATUS_DELIVERED = "Delivered"
STATUS_DOMAIN = (STATUS_RECEIVED, STATUS_IN_PROGRESS, STATUS_DELIVERED)
# The spelling the pandas transform filtered on (it never matches the seeded
# 'InProgress'; kept verbatim for the *_pipeline variants).
PIPELINE_IN_PROGRESS_LITERAL = "In_progress"
# Open-ended validity date used by the pandas product dimension.
PIPELINE_END_DATE = dt.date(2030, 12, 31)
# First value of the positional address surrogate key.
ADDRESS_KEY_START = 100
# VARCHAR(n) limits of the source DDL: (table, column) -> n.
VARCHAR_LIMITS = {
    ("customer_master", "name"): 50,
    ("customer_master", "address"): 100,
    ("customer_master", "city"): 30,
    ("customer_master", "state"): 30,
    ("product_master", "productcode"): 100,
    ("product_master", "productname"): 100,
    ("product_master", "sku"): 100,
    ("order_details", "order_status"): 20,
}
# ---------------------------------------------------------------------------

L, I, S, B = T.LongType(), T.IntegerType(), T.StringType(), T.BooleanType()
TS, D = T.TimestampNTZType(), T.DateType()


def _schema(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


# --- sources ---------------------------------------------------------------
CUSTOMER_MASTER = _schema(
    ("customerid", L, False), ("name", S, True), ("address", S, True),
    ("city", S, True), ("state", S, True), ("pincode", I, True),
    ("update_timestamp", TS, True))
PRODUCT_MASTER = _schema(
    ("productid", L, False), ("productcode", S, True), ("productname", S, True),
    ("sku", S, True), ("rate", I, True), ("isactive", B, True))
ORDER_DETAILS = _schema(
    ("orderid", L, True), ("customerid", L, True),
    ("order_status_update_timestamp", TS, True), ("order_status", S, True))
ORDER_ITEMS = _schema(
    ("orderid", L, False), ("productid", L, True), ("quantity", I, True))

SOURCES = {
    "customer_master": CUSTOMER_MASTER,
    "product_master": PRODUCT_MASTER,
    "order_details": ORDER_DETAILS,
    "order_items": ORDER_ITEMS,
}
PRIMARY_KEYS = {"customer_master": ["customerid"], "product_master": ["productid"]}
# (child table, child column, parent table, parent column)
FOREIGN_KEYS = [
    ("order_details", "customerid", "customer_master", "customerid"),
    ("order_items", "productid", "product_master", "productid"),
]

# --- canonical targets (warehouse DDL; INTEGER is 64-bit) ------------------
DIM_ORDER = _schema(
    ("orderid", L, False), ("order_status_update_timestamp", TS, False),
    ("order_status", S, False))
FACT_DAILY_ORDERS = _schema(
    ("customerid", L, False), ("orderid", L, False),
    ("order_received_timestamp", TS, False), ("order_delivery_timestamp", TS, False),
    ("pincode", L, False), ("order_amount", L, False), ("item_count", L, False),
    ("order_delivery_time_seconds", L, False))
DIM_CUSTOMER = _schema(
    ("customerid", L, False), ("name", S, False), ("address_id", L, False),
    ("start_date", D, True), ("end_date", D, True))
DIM_ADDRESS = _schema(
    ("address_id", L, False), ("address", S, False), ("city", S, False),
    ("state", S, False), ("pincode", L, False))
DIM_PRODUCT = _schema(
    ("productid", L, False), ("productcode", S, False), ("productname", S, False),
    ("sku", S, False), ("rate", L, False), ("isactive", B, False),
    ("start_date", D, True), ("end_date", D, True))
F_ORDER_DETAILS = _schema(
    ("orderid", L, False), ("order_delivery_timestamp", TS, False),
    ("productid", L, False), ("quantity", L, False))

TARGETS = {
    "dim_order": DIM_ORDER,
    "fact_daily_orders": FACT_DAILY_ORDERS,
    "dim_customer": DIM_CUSTOMER,
    "dim_address": DIM_ADDRESS,
    "dim_product": DIM_PRODUCT,
    "f_order_details": F_ORDER_DETAILS,
}


def not_null_columns(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields if not f.nullable]


# NOT NULL columns of the published tables by variant.  The SQL variant keeps
# undelivered orders, so its delivery columns may be NULL.
_DELIVERY = ("order_delivery_timestamp", "order_delivery_time_seconds")
_CANONICAL = {t: not_null_columns(s) for t, s in TARGETS.items()}
NOT_NULL = {
    "canonical": _CANONICAL,
    "sql": {**_CANONICAL, "fact_daily_orders": [c for c in _CANONICAL["fact_daily_orders"] if c not in _DELIVERY]},
    "pipeline": {
        "dim_orders": ["order_id", "order_status_update_timestamp", "order_status"],
        "dim_product": ["product_id", "product_code", "product_name", "sku", "rate", "isactive"],
        "dim_address": ["addr", "city", "state", "pincode", "addr_id"],
        "dim_cust": ["customer_id", "customer_name", "addr_id"],
        "fact_daily_orders": ["cust_id", "pincode", "order_id", "order_received_timestamp", "order_delivery_timestamp",
                              "item_count", "order_amount", "order_delivery_time_sec"],
        "f_order_details": ["order_id", "product_id", "quantity", "order_delivery_timestamp"],
    },
}
