"""Fact kept current by keyed streaming state and an epoch ledger.

Status rows and item lines arrive as files.  Both become per-order states
(``operators.order_state``) and one streaming aggregate, keyed by order, merges
them; its state store is the history, so no batch reads earlier rows.  A batch
hands out the merged states of the orders that it changed.  Their rows replace
the old ones in the ranges of the order key that they lie in, and the new
version of the fact is committed together with the batch's id (stream name and
epoch) in the store's manifest.

A stream that dies before that commit publishes nothing and does the epoch
again; one that dies after it, before its own checkpoint, finds the epoch's id
in the manifest and skips it.  Either way the table is the same.
"""

from __future__ import annotations

import contextlib
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..config import scratch_path
from ..operators import order_state as ops
from ..plans.state import RANGE_WIDTH, order_range, touched_ranges
from ..sinks.manifest import VersionedStore, open_store
from ..sinks.writers import stage_frame

FACT = "fact_daily_orders"
#: Order states outgrow executor heaps: they are kept in RocksDB, within one
#: bound of native memory for all partitions of an executor.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "500",
}


@contextlib.contextmanager
def _settings(spark: SparkSession, conf: dict[str, str]):
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def open_fact(spark: SparkSession, database: str) -> VersionedStore:
    return open_store(spark, database, {FACT: schemas.FACT_DAILY_ORDERS})


def publish_states(store: VersionedStore, changed: DataFrame, customer_master: DataFrame, batch_id: str, width: int = RANGE_WIDTH) -> bool:
    """Replace the facts of the ``changed`` orders (whole merged states) and
    commit under ``batch_id``; False if that was done before.  Orders that are
    not delivered have no row."""
    base = store.snapshot()
    if batch_id in base.batches:
        return False
    ranges = touched_ranges(changed.withColumn("_range", order_range(width)), base, FACT)
    kept = base.table(FACT, ranges).join(changed.select("orderid"), "orderid", "left_anti").select(*schemas.FACT_DAILY_ORDERS.names)
    fact = kept.unionByName(ops.fact_of_states(changed, customer_master))
    staged = store.stage(FACT, fact.withColumn("_range", order_range(width)), "_range", ("orderid",))
    store.commit(base, batch_id, {FACT: staged}, {FACT: ranges})
    return True


def start_state_stream(spark: SparkSession, status_path: str, items_path: str, load_masters: Callable[[], dict[str, DataFrame]],
                       database: str, checkpoint_location: str, name: str = "fact", available_now: bool = True,
                       width: int = RANGE_WIDTH, max_files: int | None = None,
                       after_publish: Callable[[int], None] | None = None) -> StreamingQuery:
    """Keep ``database``'s fact current as files arrive in the two folders.

    ``name`` is the stream's identity in the ledger; keep it with the
    checkpoint.  ``load_masters`` returns ``customer_master`` and
    ``product_master``; rates are those at a line's arrival, pincodes those at
    an order's last change.  ``after_publish`` is called with the epoch once
    its version is published.
    """
    def files(path, schema):
        reader = spark.readStream.schema(schema)
        return (reader.option("maxFilesPerTrigger", max_files) if max_files else reader).parquet(path)

    store = open_fact(spark, database)
    states = ops.status_states(files(status_path, schemas.ORDER_DETAILS)).unionByName(
        ops.item_states(files(items_path, schemas.ORDER_ITEMS), load_masters()["product_master"]))
    merged = ops.merge_states(states)

    def on_batch(batch: DataFrame, epoch: int) -> None:
        # a known epoch is computed too: the state store commits with its batch
        changed = stage_frame(batch, os.path.join(scratch_path(spark, "state-stream"), "changed"))
        publish_states(store, changed, load_masters()["customer_master"], f"{name}:{epoch}", width)
        if after_publish is not None:
            after_publish(epoch)

    with _settings(spark, STATE_CONF):
        writer = merged.writeStream.outputMode("update").foreachBatch(on_batch).option("checkpointLocation", checkpoint_location)
        writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
        return writer.start()
