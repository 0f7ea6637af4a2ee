"""Item amounts and per-order item totals."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def line_amount(order_items: DataFrame, product_master: DataFrame, how: str = "inner") -> DataFrame:
    """Each item line with its product rate and quantity x rate (64-bit).

    The product side is a dimension; Spark broadcasts it only while its
    estimated size is under ``spark.sql.autoBroadcastJoinThreshold`` and AQE
    can still switch at run time; otherwise the join is shuffled and AQE splits
    a hot product key.
    """
    rates = product_master.select("productid", "rate")
    return (order_items.join(rates, "productid", how)
            .select("orderid", "productid", "quantity", "rate",
                    (F.col("quantity").cast("bigint") * F.col("rate").cast("bigint")).alias("line_amount")))


def order_item_totals(order_items: DataFrame, product_master: DataFrame, how: str = "inner") -> DataFrame:
    """Per order: order_amount = sum(quantity x rate), item_count = sum(quantity)."""
    return (line_amount(order_items, product_master, how)
            .groupBy("orderid")
            .agg(F.sum("line_amount").alias("order_amount"),
                 F.sum(F.col("quantity").cast("bigint")).alias("item_count")))
