"""Shared helpers: staged tables, document bindings, partition counts."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import scratch_path

#: ASCII white space: the separators of the word definition ``[^\x20\x09-\x0D]+``.
SPACE_CLASS = r"[\x20\x09-\x0D]"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` to a new folder under the shared checkpoint folder and read
    it back: cuts the lineage, survives lost executors, computes ``df`` once."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def in_remainder(column: str, modulus: int, remainder: int):
    """crc32 of the id's decimal text modulo ``modulus`` is ``remainder``;
    a null id counts as the empty text."""
    text = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(modulus)) == F.lit(remainder)


def at_most(rows: DataFrame, kind: str, sample: int) -> DataFrame:
    """(``kind``, text): of each kind at most ``sample`` distinct texts, those
    with the smallest hashes.  Copies are one text, aggregated before they
    move, and a task hands on no more than ``sample`` texts of a kind."""
    one = rows.groupBy(kind, F.xxhash64("text").alias("_hash")).agg(F.min("text").alias("text"))
    place = F.row_number().over(Window.partitionBy(kind).orderBy("_hash"))
    return one.withColumn("_place", place).filter(F.col("_place") <= sample).select(kind, "text")


def record_batch(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)],
        schema=schema)


def slices(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into row slices whose ``column`` holds about
    ``max_bytes`` bytes (one row at least), so that working memory does not
    depend on the batch size Spark uses."""
    import numpy as np

    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets, _ = raw_bytes(batch.column(batch.schema.get_field_index(column)))
        start = 0
        while start < batch.num_rows:
            stop = int(np.searchsorted(offsets, offsets[start] + max_bytes, side="right")) - 1
            stop = min(max(stop, start + 1), batch.num_rows)
            yield batch.slice(start, stop - start)
            start = stop


def raw_bytes(column: pa.Array):
    """(bytes, offsets, is_null) of a string or binary Arrow column, without
    making Python objects.  Null entries have length zero."""
    import numpy as np

    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    nulls = np.asarray(column.is_null())
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = column.cast(pa.large_binary())
    _, offsets, data = wide.buffers()
    offsets = np.frombuffer(offsets, np.int64)[wide.offset: wide.offset + len(wide) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    base = int(offsets[0]) if len(offsets) else 0
    return data[base: int(offsets[-1])], offsets - base, nulls
