"""Dense, ordered surrogate keys without a single-partition window.

``row_number() OVER (ORDER BY k)`` moves every row into one task.  Here the
rows are range-partitioned on the ordering key, sorted inside each range, and
numbered by position inside the partition; a prefix sum over the per-partition
row counts (one row per partition, so its size is bounded by the partition
count, not by the data) turns positions into global ranks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

# monotonically_increasing_id() keeps the partition id in the upper 31 bits
# and the record number inside the partition in the lower 33 bits.
_ROW_BITS = 33
#: Copies of a row that stay together in a range.
_CHUNK = 100_000


def dense_surrogate_key(df: DataFrame, order_by: list[str], key_col: str, start: int = 1,
                        num_partitions: int | None = None) -> DataFrame:
    """Add ``key_col`` = start, start+1, ... in ``order_by`` order; rows with
    equal keys are ordered by their other columns.

    Exact copies are first counted as one row, which becomes a row for every
    ``_CHUNK`` copies, so that the ranges can cut a large group; within its
    range each is expanded again, in order, and the rows are numbered by
    position.  No value is random, so a recomputed task gives the same ranges.
    This runs jobs when called: the numbered rows are checkpointed to the
    shared checkpoint folder, and the offsets and final ids are two reads of
    that copy.  ``num_partitions`` (default: the session's shuffle partitions)
    should follow the size of the data.
    """
    from ..config import checkpoint_dir

    spark = df.sparkSession
    checkpoint_dir(spark)
    unordered = ("map", "variant")
    if any(f.dataType.typeName().startswith(unordered) for f in df.schema.fields):
        raise ValueError("dense keys need columns that can be ordered (no map or variant)")
    sort_cols = [*order_by, *[c for c in df.columns if c not in order_by]]
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    chunks = F.sequence(F.lit(0), F.floor((F.col("_n") - 1) / _CHUNK).cast("bigint"))
    rows = counted.withColumn("_chunk", F.explode(chunks)).withColumn(
        "_copies", F.least(F.lit(_CHUNK), F.col("_n") - F.col("_chunk") * _CHUNK)).drop("_n")
    numbered = (rows.repartitionByRange(n, *sort_cols, "_chunk").sortWithinPartitions(*sort_cols, "_chunk")
                .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
                .withColumn("_pid", F.spark_partition_id())
                .withColumn("_pos", F.monotonically_increasing_id()
                            - F.shiftleft(F.col("_pid").cast("bigint"), _ROW_BITS))
                .drop("_chunk", "_copies", "_copy").checkpoint(eager=True))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (numbered.groupBy("_pid").agg(F.count(F.lit(1)).alias("_rows"))
               .select("_pid", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset")))
    placed = numbered.join(F.broadcast(offsets), "_pid")
    return (placed.withColumn(key_col, F.lit(start).cast("bigint") + F.col("_offset") + F.col("_pos"))
            .drop("_pid", "_pos", "_offset"))


def current_max(df: DataFrame, col: str) -> Column:
    """max(col) of ``df`` as a scalar subquery column (evaluated once)."""
    return df.select(F.max(col)).scalar()


def continue_keys(batch: DataFrame, existing: DataFrame, existing_key: str, order_by: list[str],
                  key_col: str) -> DataFrame:
    """Number a new batch above the current maximum key of ``existing``
    (max + 1, max + 2, ... in ``order_by`` order; from 1 when empty)."""
    numbered = dense_surrogate_key(batch, order_by, "_rank", start=1)
    return (numbered.withColumn(key_col, F.coalesce(current_max(existing, existing_key), F.lit(0))
                                .cast("bigint") + F.col("_rank"))
            .drop("_rank"))
