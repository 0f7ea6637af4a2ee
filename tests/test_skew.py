"""A customer holding a third of all orders: AQE splits the hot partition.

Thresholds are lowered so the effect shows on test-sized data; broadcasts
are off so the joins are the shuffled joins a large cluster would run.
"""

import contextlib
import datetime as dt

from pyspark.sql import functions as F

from order_mart import schemas
from order_mart.operators import lifecycle
from order_mart.plans import facts

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "8",
}


@contextlib.contextmanager
def conf(spark, kv):
    old = {k: spark.conf.get(k, None) for k in kv}
    for k, v in kv.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def skewed_sources(spark, n=30000):
    ids = spark.range(1, n + 1).select(F.col("id").alias("orderid"))
    cust = F.when(F.col("orderid") % 3 == 0, F.lit(1)).otherwise(F.col("orderid") % 97 + 2).cast("bigint")
    t0 = F.lit("2023-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("orderid").cast("decimal(18,6)"))
    details = ids.select("orderid", cust.alias("customerid"), F.explode(F.array(
        F.struct(t0.alias("ts"), F.lit("Received").alias("st")),
        F.struct((t0 + F.expr("INTERVAL 1 HOUR")).alias("ts"), F.lit("Delivered").alias("st")))).alias("e")
    ).select("orderid", "customerid", F.col("e.ts").alias("order_status_update_timestamp"),
             F.col("e.st").alias("order_status"))
    items = ids.select("orderid", (F.col("orderid") % 10 + 1).alias("productid"), F.lit(2).alias("quantity"))
    customers = spark.range(1, 100).select(
        F.col("id").alias("customerid"), F.lit("n").alias("name"), F.lit("a").alias("address"),
        F.lit("c").alias("city"), F.lit("s").alias("state"), F.lit(1).alias("pincode"),
        F.lit(None).cast("timestamp_ntz").alias("update_timestamp"))
    products = spark.range(1, 11).select(
        F.col("id").alias("productid"), F.lit("p").alias("productcode"), F.lit("p").alias("productname"),
        F.lit("1KG").alias("sku"), F.lit(5).alias("rate"), F.lit(True).alias("isactive"))
    return {
        "customer_master": spark.createDataFrame(customers.rdd, schemas.CUSTOMER_MASTER),
        "product_master": spark.createDataFrame(products.rdd, schemas.PRODUCT_MASTER),
        "order_details": details, "order_items": items,
    }


def final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_customer_is_split_in_the_fact(spark):
    with conf(spark, SKEW_CONF):
        src = skewed_sources(spark)
        df = facts.fact_daily_orders(src)
        plan = final_plan(df)
        assert df.count() == 30000
    assert "SortMergeJoin" in plan and "skewed" in plan, plan


def test_hot_customer_is_split_in_history_lookup(spark):
    with conf(spark, SKEW_CONF):
        src = skewed_sources(spark)
        df = lifecycle.customer_status_history(src["customer_master"], src["order_details"])
        plan = final_plan(df)
        assert df.filter(F.col("customerid") == 1).count() == 2 * 10000
    assert "skewed" in plan, plan


def test_plain_left_join_is_not_split(spark):
    """Why left_join_split exists: the same lookup as a plain LEFT JOIN keeps
    the hot customer's whole history in one task (only the preserved side of
    an outer join can be split)."""
    with conf(spark, SKEW_CONF):
        src = skewed_sources(spark)
        df = (src["customer_master"].select("customerid", "name")
              .join(src["order_details"].select("customerid", "order_status"), "customerid", "left"))
        plan = final_plan(df)
    assert "SortMergeJoin" in plan and "skewed" not in plan, plan
