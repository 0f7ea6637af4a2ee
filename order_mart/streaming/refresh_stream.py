"""File-stream fed fact refresh.

New status rows land as Parquet files in a folder.  A Structured Streaming
query picks up each new batch of files and ``foreachBatch`` runs the
incremental refresh: the affected orders are rebuilt from their full history
and swapped into the fact table.  The refresh is idempotent (a replayed batch
gives the same fact), and the stream checkpoint records which files were
processed, so the pair survives a restart at any point.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..plans.facts import fact_daily_orders
from ..plans.incremental import refresh_fact
from ..plans.partitioned import refresh_partitions
from ..sinks.writers import swap_in

Sources = dict[str, DataFrame]


def start_stream_refresh(spark: SparkSession, increments_path: str, load_sources: Callable[[], Sources],
                         fact_table: str, checkpoint_location: str,
                         available_now: bool = True, grain: str | None = None) -> StreamingQuery:
    """Keep ``fact_table`` current as status files arrive in ``increments_path``.

    With ``grain`` ('day' or 'month') the fact is partitioned by its received
    date and a batch reads and rewrites only the partitions that it touches;
    without it a batch rewrites the whole (small) table.

    ``load_sources`` returns the current full sources (the status history
    already contains the new rows).  The first batch builds the fact if the
    table does not exist yet.
    """
    stream = spark.readStream.schema(schemas.ORDER_DETAILS).parquet(increments_path)

    def on_batch(batch: DataFrame, epoch_id: int) -> None:
        src = load_sources()
        if grain is not None:
            refresh_partitions(spark, src, batch, fact_table, grain)
        elif not spark.catalog.tableExists(fact_table):
            swap_in(spark, fact_daily_orders(src), fact_table)
        else:
            swap_in(spark, refresh_fact(spark.table(fact_table), src, batch), fact_table)

    writer = (stream.writeStream.foreachBatch(on_batch)
              .option("checkpointLocation", checkpoint_location))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


stream_refresh = start_stream_refresh
