"""High-water-mark increments.

An increment is the set of status rows at or after a cutoff.  Items have no
timestamp, so they are selected through the affected order keys.  A fact
refresh rebuilds exactly the affected orders from their *full* history (an
order received before the cutoff and delivered after it needs both rows) and
swaps them into the previous fact; the result equals a full rebuild.
"""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import ntz_literal
from ..operators.lifecycle import TS
from ..sinks.writers import stage_frame
from .facts import fact_daily_orders

Sources = dict[str, DataFrame]


def incremental_status(order_details: DataFrame, cutoff: dt.datetime | str) -> DataFrame:
    """Status rows with ts >= cutoff (a plain comparison, so it reaches the
    Parquet reader as a pushed filter / row-group skip)."""
    return order_details.filter(F.col(TS) >= ntz_literal(cutoff))


def affected_orders(increment: DataFrame) -> DataFrame:
    return increment.select("orderid").filter(F.col("orderid").isNotNull()).distinct()


def incremental_items(order_items: DataFrame, increment: DataFrame) -> DataFrame:
    """Item lines of the orders touched by the increment (semi join)."""
    return (order_items.join(affected_orders(increment), "orderid", "left_semi")
            .select(*order_items.columns))


def refresh_fact(previous_fact: DataFrame, src: Sources, increment: DataFrame) -> DataFrame:
    """previous fact minus affected orders, plus those orders rebuilt."""
    affected = affected_orders(increment)
    scoped = dict(src)
    for name in ("order_details", "order_items"):
        scoped[name] = src[name].join(affected, "orderid", "left_semi").select(*src[name].columns)
    return _replace_orders(previous_fact, fact_daily_orders(scoped), affected)


def stage_increment(spark: SparkSession, src: Sources, cutoff: dt.datetime | str,
                    stage_dir: str) -> tuple[Sources, DataFrame]:
    """(scoped sources, affected orders).  The affected orders' whole status
    history and item lines are written once under ``stage_dir`` and read by
    every target and check; the masters stay as they are."""
    return stage_affected(src, incremental_status(src["order_details"], cutoff), stage_dir)


def stage_affected(src: Sources, increment: DataFrame, stage_dir: str) -> tuple[Sources, DataFrame]:
    """The same for an increment given as status rows."""
    affected = stage_frame(affected_orders(increment), os.path.join(stage_dir, "increment__orders"))
    scoped = dict(src)
    for name in ("order_details", "order_items"):
        scoped[name] = stage_frame(src[name].join(affected, "orderid", "left_semi").select(*src[name].columns),
                                   os.path.join(stage_dir, f"increment__{name}"))
    return scoped, affected


def gate_sources(src: Sources, scoped: Sources, increment: DataFrame) -> Sources:
    """What the quality gate of an increment reads.  Status rows: the staged
    history of the affected orders and the increment's rows without an order
    key, which no semi join reaches.  Item lines have no timestamp, so those
    without a key or new for an order that the increment does not touch cannot
    be told from the others: all are gated, by one scan of the two key columns
    that is aggregated map-side (``item_summary``)."""
    unkeyed = increment.filter(F.col("orderid").isNull()).select(*scoped["order_details"].columns)
    return dict(scoped, order_details=scoped["order_details"].unionByName(unkeyed), order_items=src["order_items"])


def max_keys(src: Sources) -> DataFrame:
    """Current maximum of each source key, one row per table."""
    def one(table: str, col: str) -> DataFrame:
        return src[table].agg(F.max(col).cast("bigint").alias("max_key")).select(
            F.lit(table).alias("table_name"), F.lit(col).alias("key_column"), "max_key")
    return (one("order_details", "orderid")
            .unionByName(one("customer_master", "customerid"))
            .unionByName(one("product_master", "productid")))


def _replace_orders(previous: DataFrame, rebuilt: DataFrame, affected: DataFrame) -> DataFrame:
    kept = previous.join(affected, "orderid", "left_anti").select(*previous.columns)
    return kept.unionByName(rebuilt.select(*previous.columns))


def refresh_targets(previous: dict[str, DataFrame], src: Sources, scoped: Sources, affected: DataFrame,
                    as_of: dt.date | str | None = None) -> dict[str, DataFrame]:
    """Apply an increment to all six canonical targets.

    Order-keyed targets (``fact_daily_orders``, ``f_order_details``,
    ``dim_order``) keep every unaffected order's rows and rebuild the affected
    orders from ``scoped`` (their full history and items), so replaying an
    increment is harmless.  Rows of unaffected orders are frozen as they were
    computed: a product rate or customer pincode changed since shows only in
    orders touched again or after a full build.  The customer, address and
    product dimensions are rebuilt from the (small) master tables and always
    show the current masters.
    """
    from . import dims
    from .facts import f_order_details

    return {
        "dim_order": _replace_orders(previous["dim_order"], dims.dim_order(scoped), affected),
        "fact_daily_orders": _replace_orders(previous["fact_daily_orders"], fact_daily_orders(scoped),
                                             affected),
        "dim_customer": dims.dim_customer(src),
        "dim_address": dims.dim_address(src),
        "dim_product": dims.dim_product(src, as_of),
        "f_order_details": _replace_orders(previous["f_order_details"], f_order_details(scoped), affected),
    }
