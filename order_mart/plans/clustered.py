"""Increments over sources clustered by the order key.

The two large sources are kept as range-clustered tables with zone maps
(``sinks.clustered``).  An increment's orders are looked up in the zone maps,
and only the files that can hold them are scanned: new orders have the highest
keys and late deliveries follow soon, so these are few of a long history.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from ..config import scratch_path
from ..sinks.clustered import read_keys, write_clustered
from ..sinks.writers import stage_frame
from .facts import fact_daily_orders
from .incremental import _replace_orders, affected_orders

Sources = dict[str, DataFrame]
KEYED = ("order_details", "order_items")


def cluster_sources(spark: SparkSession, src: Sources, location: str | None = None, files: int | None = None) -> str:
    """Write the order-keyed sources in ranges of the order key under
    ``location`` (by default the shared checkpoint folder) and return it.
    ``files`` should follow the size of the history (about 256 MB each)."""
    location = location or scratch_path(spark, "clustered")
    files = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    for name in KEYED:
        write_clustered(src[name], os.path.join(location, name), "orderid", files)
    return location


def clustered_scope(spark: SparkSession, src: Sources, location: str, affected: DataFrame) -> Sources:
    """``src`` with the order-keyed sources limited to the orders of
    ``affected``, read from the clustered tables under ``location``."""
    return {**src, **{name: read_keys(spark, os.path.join(location, name), "orderid", affected) for name in KEYED}}


def refresh_fact_clustered(spark: SparkSession, previous_fact: DataFrame, src: Sources, location: str,
                           increment: DataFrame) -> DataFrame:
    """As ``incremental.refresh_fact``, with the affected orders' history and
    item lines read through the zone maps.  The clustered tables hold the
    increment's rows too."""
    affected = stage_frame(affected_orders(increment), scratch_path(spark, "clustered-orders"))
    return _replace_orders(previous_fact, fact_daily_orders(clustered_scope(spark, src, location, affected)), affected)
