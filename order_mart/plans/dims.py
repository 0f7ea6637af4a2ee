"""The dimensions.  Canonical outputs follow the warehouse DDL; *_pipeline
outputs keep the pandas transform's names and rules."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from .. import schemas
from ..functions import as_of_date
from ..operators.keys import dense_surrogate_key
from ..operators.lifecycle import TS, customer_first_events
from ..sinks.conform import conform

Sources = dict[str, DataFrame]
DateLike = dt.date | str | None


def dim_order(src: Sources) -> DataFrame:
    """Status events, one row per distinct (order, time, status)."""
    out = src["order_details"].select("orderid", TS, "order_status").distinct()
    return conform(out, schemas.DIM_ORDER)


def dim_product(src: Sources, as_of: DateLike = None) -> DataFrame:
    """Products valid from the run date, open-ended (end_date NULL)."""
    out = src["product_master"].select(
        "productid", "productcode", "productname", "sku", "rate", "isactive",
        as_of_date(as_of).alias("start_date"), F.lit(None).cast("date").alias("end_date"))
    return conform(out, schemas.DIM_PRODUCT)


def dim_product_pipeline(src: Sources, as_of: DateLike = None) -> DataFrame:
    return (src["product_master"].select(
        F.col("productid").alias("product_id"), F.col("productcode").alias("product_code"),
        F.col("productname").alias("product_name"), "sku", "rate", "isactive",
        as_of_date(as_of).alias("start_date"),
        F.lit(schemas.PIPELINE_END_DATE).alias("end_date"))
        .distinct())


def dim_address(src: Sources) -> DataFrame:
    """One address per customer; the key is the customer id (stable across runs)."""
    out = src["customer_master"].select(
        F.col("customerid").alias("address_id"), "address", "city", "state", "pincode")
    return conform(out, schemas.DIM_ADDRESS)


def address_keys(src: Sources) -> DataFrame:
    """Customer addresses numbered densely from 100 in customerid order."""
    return dense_surrogate_key(
        src["customer_master"].select("customerid", "address", "city", "state", "pincode"),
        ["customerid"], "address_id", start=schemas.ADDRESS_KEY_START)


def dim_address_pipeline(src: Sources, keyed: DataFrame | None = None) -> DataFrame:
    keyed = keyed if keyed is not None else address_keys(src)
    return keyed.select(F.col("address").alias("addr"), "city", "state", "pincode",
                        F.col("address_id").alias("addr_id"))


def dim_customer(src: Sources) -> DataFrame:
    """Customer valid from the date of its last update, open-ended."""
    out = src["customer_master"].select(
        "customerid", "name", F.col("customerid").alias("address_id"),
        F.col("update_timestamp").cast("date").alias("start_date"),
        F.lit(None).cast("date").alias("end_date"))
    return conform(out, schemas.DIM_CUSTOMER)


def dim_customer_pipeline(src: Sources, keyed: DataFrame | None = None) -> DataFrame:
    """Customer with its first Received (start) and first Delivered (end)
    time over all of its orders, and the dense address key."""
    keyed = keyed if keyed is not None else address_keys(src)
    firsts = customer_first_events(src["customer_master"], src["order_details"])
    return (firsts.join(keyed.select("customerid", "address_id"), "customerid", "left")
            .select(F.col("customerid").alias("customer_id"), F.col("name").alias("customer_name"),
                    F.col("first_received_timestamp").alias("start_date"),
                    F.col("first_delivered_timestamp").alias("end_date"),
                    F.col("address_id").alias("addr_id")))
