"""The order facts.

* ``fact_daily_orders`` - canonical, one row per delivered order.  Both sides
  are reduced to order grain *before* they meet: the status history by one
  conditional aggregate, the items by one sum.  Nothing fans out.
* ``fact_daily_orders_pipeline`` - the pandas transform's semantics (item
  lines de-duplicated, item-less orders kept with zeros, float seconds).
* ``fact_daily_orders_sql`` - the SQL transform's semantics, where the
  status rows are joined to the item rows before summing, so sums are
  multiplied by the number of status rows.  The result is reproduced
  exactly, but computed as (status-row count) x (customer-row count) x
  (item sums) per order, which never materialises the fan-out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import schemas
from ..functions import is_status, is_status_exact, seconds_between, whole_seconds_between
from ..operators.lifecycle import TS, delivered_only, order_lifecycle
from ..operators.totals import line_amount, order_item_totals
from ..sinks.conform import conform

Sources = dict[str, DataFrame]


def fact_daily_orders(src: Sources) -> DataFrame:
    """One row per delivered order.  The lifecycle is grouped by the order key
    (its customer carried along), so lifecycle and item totals come out of
    their aggregates hash-partitioned the same way and meet without another
    exchange.  An order whose status rows disagree on the customer is a data
    error reported by ``check_order_customer``."""
    life = delivered_only(order_lifecycle(
        src["order_details"].filter(F.col("orderid").isNotNull() & F.col("customerid").isNotNull()),
        keys=("orderid",), carry=("customerid",)))
    totals = order_item_totals(src["order_items"], src["product_master"])
    pincodes = src["customer_master"].select("customerid", "pincode")
    fact = (life.join(totals, "orderid", "left")
            .join(pincodes, "customerid", "inner")
            .select("customerid", "orderid", "order_received_timestamp", "order_delivery_timestamp",
                    "pincode",
                    F.coalesce("order_amount", F.lit(0)).alias("order_amount"),
                    F.coalesce("item_count", F.lit(0)).alias("item_count"),
                    whole_seconds_between("order_received_timestamp", "order_delivery_timestamp")
                    .alias("order_delivery_time_seconds")))
    return conform(fact, schemas.FACT_DAILY_ORDERS)


def fact_daily_orders_pipeline(src: Sources) -> DataFrame:
    # group rows: (customer, pincode, order) with first Received / Delivered
    life = delivered_only(order_lifecycle(
        src["order_details"].filter(F.col("orderid").isNotNull()),
        exact=True, delivered_agg="min"))
    customers = (src["customer_master"].select("customerid", "pincode")
                 .filter(F.col("pincode").isNotNull()).distinct())
    groups = life.join(customers, "customerid", "inner")
    # item lines of one order are de-duplicated on (product, quantity, rate)
    items = (src["order_items"].join(src["product_master"].select("productid", "rate"), "productid", "left")
             .select("orderid", "productid", "quantity", "rate").distinct())
    totals = items.groupBy("orderid").agg(
        F.sum(F.col("quantity").cast("bigint")).alias("item_count"),
        F.sum(F.col("quantity").cast("bigint") * F.col("rate").cast("bigint")).alias("order_amount"))
    return (groups.join(totals, "orderid", "left")
            .select(F.col("customerid").alias("cust_id"), "pincode",
                    F.col("orderid").alias("order_id"),
                    "order_received_timestamp", "order_delivery_timestamp",
                    F.coalesce("item_count", F.lit(0)).alias("item_count"),
                    F.coalesce("order_amount", F.lit(0)).alias("order_amount"),
                    seconds_between("order_received_timestamp", "order_delivery_timestamp")
                    .alias("order_delivery_time_sec")))


def fact_daily_orders_sql(src: Sources, ordered: bool = False) -> DataFrame:
    """``ordered`` adds the original ORDER BY orderid (a range-partitioned
    global sort); leave it off when the result is written or aggregated."""
    od = src["order_details"].filter(F.col("orderid").isNotNull() & F.col("customerid").isNotNull())
    status = od.groupBy("orderid", "customerid").agg(
        F.count(F.lit(1)).alias("_n_status"),
        F.min(F.when(is_status_exact(schemas.STATUS_RECEIVED), F.col(TS))).alias("order_received_timestamp"),
        F.max(F.when(is_status_exact(schemas.STATUS_DELIVERED), F.col(TS))).alias("order_delivery_timestamp"))
    customers = (src["customer_master"].filter(F.col("customerid").isNotNull())
                 .groupBy("customerid", "pincode").agg(F.count(F.lit(1)).alias("_n_customer")))
    items = (line_amount(src["order_items"].filter(F.col("orderid").isNotNull()), src["product_master"])
             .groupBy("orderid")
             .agg(F.sum("line_amount").alias("_amount"),
                  F.sum(F.col("quantity").cast("bigint")).alias("_count")))
    fan_out = F.col("_n_status") * F.col("_n_customer")
    out = (status.join(customers, "customerid").join(items, "orderid")
            .select("customerid", "orderid", "order_received_timestamp", "order_delivery_timestamp",
                    "pincode",
                    (fan_out * F.col("_amount")).alias("order_amount"),
                    (fan_out * F.col("_count")).alias("item_count"),
                    whole_seconds_between("order_received_timestamp", "order_delivery_timestamp")
                    .alias("order_delivery_time_seconds")))
    return out.orderBy("orderid") if ordered else out


def f_order_details(src: Sources) -> DataFrame:
    """Item lines of delivered orders (bag; one row per item x Delivered row)."""
    delivered = (src["order_details"].filter(is_status(schemas.STATUS_DELIVERED))
                 .select("orderid", F.col(TS).alias("order_delivery_timestamp")))
    out = src["order_items"].join(delivered, "orderid", "inner")
    return conform(out, schemas.F_ORDER_DETAILS)


def f_order_details_pipeline(src: Sources) -> DataFrame:
    delivered = (src["order_details"].filter(is_status_exact(schemas.STATUS_DELIVERED))
                 .select("orderid", F.col(TS).alias("order_delivery_timestamp")))
    return (src["order_items"].join(delivered, "orderid", "inner")
            .select(F.col("orderid").alias("order_id"), F.col("productid").alias("product_id"),
                    "quantity", "order_delivery_timestamp")
            .distinct())
