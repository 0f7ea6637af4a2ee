"""Binding of the shared test tables (TPC-H-like) to the four order sources.

Every expression is deterministic integer arithmetic so the same values can
be produced by any SQL engine.  One scan of ``orders`` produces the whole
status history (an array of up to three events per order, exploded), rather
than three scans glued by a union.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import schemas
from ..functions import join_words, plus_seconds, with_unit

# Fixed values of the binding (seconds arithmetic that spreads status steps).
BASE_UPDATE_TS = "2023-01-01 00:00:00"
UPDATE_TS_STEP, UPDATE_TS_RANGE = 86399, 31536000
PINCODE_BASE, PINCODE_RANGE = 100000, 900000
IN_PROGRESS_MULT, DELIVERED_MULT, DAY_SECONDS = 7919, 104729, 86400


# Column types of the shared test tables (read with a schema: no footer
# inference pass, and a changed file fails loudly instead of drifting).
TEST_TABLE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TEST_TABLE_SCHEMAS[name]).parquet(os.path.join(sf_dir, f"{name}.parquet"))


def customer_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _read(spark, sf_dir, "customer")
    n = _read(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = _read(spark, sf_dir, "region").select("r_regionkey", "r_name")
    key = F.col("c_custkey")
    return (c.join(n, c.c_nationkey == n.n_nationkey, "left")
             .join(r, F.col("n_regionkey") == r.r_regionkey, "left")
             .select(key.cast("bigint").alias("customerid"),
                     F.col("c_name").alias("name"),
                     F.concat(key.cast("string"), F.lit(" "), F.col("c_mktsegment")).alias("address"),
                     F.col("n_name").alias("city"),
                     F.col("r_name").alias("state"),
                     (F.lit(PINCODE_BASE) + key % PINCODE_RANGE).cast("int").alias("pincode"),
                     plus_seconds(F.lit(BASE_UPDATE_TS).cast("timestamp_ntz"),
                                  (key * UPDATE_TS_STEP) % UPDATE_TS_RANGE).alias("update_timestamp")))


def product_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _read(spark, sf_dir, "part")
    key = F.col("p_partkey")
    return p.select(
        key.cast("bigint").alias("productid"),
        F.concat(F.expr("chr(97 + p_partkey % 26)"),
                 F.lpad((key % 100).cast("string"), 2, "0")).alias("productcode"),
        join_words("p_brand", "p_type").alias("productname"),
        with_unit(F.lit(1) + F.col("p_size") % 8, "KG").alias("sku"),
        F.floor("p_retailprice").cast("int").alias("rate"),
        (key % 2 == 0).alias("isactive"))


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("bigint").alias("orderid"),
        F.col("l_partkey").cast("bigint").alias("productid"),
        F.col("l_quantity").cast("int").alias("quantity"))


def _status_steps(o: DataFrame) -> DataFrame:
    """orders -> (orderid, customerid, status flags, the three step times)."""
    received = F.col("o_orderdate")
    in_progress = plus_seconds(received, F.lit(1) + (F.col("o_orderkey") * IN_PROGRESS_MULT) % DAY_SECONDS)
    delivered = plus_seconds(in_progress, F.lit(1) + (F.col("o_orderkey") * DELIVERED_MULT) % DAY_SECONDS)
    return o.select(
        F.col("o_orderkey").cast("bigint").alias("orderid"),
        F.col("o_custkey").cast("bigint").alias("customerid"),
        F.col("o_orderstatus").alias("_st"),
        received.alias("_t0"), in_progress.alias("_t1"), delivered.alias("_t2"))


def order_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status history: Received for every order, InProgress for status P/F,
    Delivered for status F.  Single scan + explode (Generate)."""
    steps = _status_steps(_read(spark, sf_dir, "orders"))
    ev = lambda status, ts: F.struct(F.lit(status).alias("order_status"),
                                     ts.alias("order_status_update_timestamp"))
    events = F.array(
        ev(schemas.STATUS_RECEIVED, F.col("_t0")),
        F.when(F.col("_st").isin("P", "F"), ev(schemas.STATUS_IN_PROGRESS, F.col("_t1"))),
        F.when(F.col("_st") == "F", ev(schemas.STATUS_DELIVERED, F.col("_t2"))))
    return (steps.select("orderid", "customerid",
                         F.explode(F.filter(events, lambda e: e.isNotNull())).alias("_e"))
                 .select("orderid", "customerid", "_e.order_status_update_timestamp",
                         "_e.order_status"))


def status_frames(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three per-status frames (as the source system appended them)."""
    steps = _status_steps(_read(spark, sf_dir, "orders"))
    cols = lambda ts, status: [F.col("orderid"), F.col("customerid"),
                               F.col(ts).alias("order_status_update_timestamp"),
                               F.lit(status).alias("order_status")]
    return (steps.select(*cols("_t0", schemas.STATUS_RECEIVED)),
            steps.filter(F.col("_st").isin("P", "F")).select(*cols("_t1", schemas.STATUS_IN_PROGRESS)),
            steps.filter(F.col("_st") == "F").select(*cols("_t2", schemas.STATUS_DELIVERED)))


def bind_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All four sources as lazy DataFrames over ``sf_dir``; every call lists
    the files anew."""
    return {
        "customer_master": customer_master(spark, sf_dir),
        "product_master": product_master(spark, sf_dir),
        "order_details": order_details(spark, sf_dir),
        "order_items": order_items(spark, sf_dir),
    }


def faulty_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The four sources with faults planted by fixed rules on the keys:
    repeated masters, over-long names, missing pincodes, orphan and missing
    foreign keys, several customers in one order, other status spellings, no
    status, and orders without history."""
    src = bind_sources(spark, sf_dir)
    order, status = F.col("orderid") % 50, F.col("order_status")
    customers = src["customer_master"].withColumns({
        "name": F.when(F.col("customerid") % 25 == 4, F.repeat("name", 5)).otherwise(F.col("name")),
        "pincode": F.when(F.col("customerid") % 30 == 7, None).otherwise(F.col("pincode"))})
    details = src["order_details"].filter(order != 21).withColumns({
        "customerid": F.when(order == 7, F.col("customerid") + 1_000_000_000)
        .when((order == 11) & (status == schemas.STATUS_RECEIVED), None)
        .when((order == 13) & (status == schemas.STATUS_IN_PROGRESS), F.col("customerid") + 1).otherwise(F.col("customerid")),
        "order_status": F.when((order == 8) & (status == schemas.STATUS_IN_PROGRESS), schemas.PIPELINE_IN_PROGRESS_LITERAL)
        .when(order == 9, None).when(order == 12, F.repeat("order_status", 3)).otherwise(status)})
    items = src["order_items"].withColumn(
        "productid", F.when(order == 14, None).when(order == 15, F.col("productid") + 1_000_000_000).otherwise(F.col("productid")))
    products = src["product_master"]
    return {
        "customer_master": customers.unionByName(customers.filter(F.col("customerid") % 40 == 3)),
        "product_master": products.unionByName(products.filter(F.col("productid") % 50 == 5)),
        "order_details": details,
        "order_items": items,
    }
