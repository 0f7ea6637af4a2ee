"""Sources staged in buckets of the order key.

The two large sources are written once, hashed and sorted by ``orderid``, into
as many buckets each.  Every later aggregate by order and every join on the
order key then reads its bucket and needs no exchange: the fact's lifecycle
and item totals are both grouped and joined in place, for all the plans that
are run over the staged sources.

A bucket is read by one task, so the number of buckets should follow the size
of the history (about 256 MB each).  An order is one task's work; its status
rows and lines are a handful, and a source where one order is not should be
joined by the unstaged plans, whose partial aggregates take hot orders.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from ..config import scratch_path
from ..sinks.ddl import create_database

Sources = dict[str, DataFrame]
KEYED = ("order_details", "order_items")


def stage_by_order(spark: SparkSession, src: Sources, buckets: int | None = None, database: str | None = None,
                   location: str | None = None) -> Sources:
    """``src`` with the order-keyed tables read from bucketed copies, in
    ``database`` (a new one by default) under ``location`` (by default the
    shared checkpoint folder)."""
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    database = database or f"by_order_{uuid.uuid4().hex}"
    location = location or scratch_path(spark, "by-order")
    create_database(spark, database, location)
    out = dict(src)
    for name in KEYED:
        table = f"{database}.{name}"
        (src[name].repartition(n, "orderid").sortWithinPartitions("orderid").write.format("parquet").mode("overwrite")
         .option("path", os.path.join(location, name)).bucketBy(n, "orderid").sortBy("orderid").saveAsTable(table))
        out[name] = spark.table(table)
    return out
