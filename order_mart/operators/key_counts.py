"""Key checks maintained by increments: stored row counts by key.

Each batch's rows by key are stored as one clustered table, a segment.  After a
further batch only its own keys can change their verdict, so the gate reads the
stored counts of these keys alone, through the segments' zone maps, and the
verdicts of all other keys stand.  The results equal the full checks of
``operators.quality`` over all rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..config import scratch_path
from ..sinks.clustered import read_keys, write_clustered
from ..sinks.writers import stage_frame


def key_counts(df: DataFrame, key: str) -> DataFrame:
    """(key, n_rows); null keys are counted as one."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))


def write_segment(batch: DataFrame, path: str, key: str, files: int | None = None) -> DataFrame:
    """Store a batch's counts under ``path`` and return them.  Writing the
    same batch there again replaces it, so a replay counts once."""
    spark = batch.sparkSession
    counts = stage_frame(key_counts(batch, key), scratch_path(spark, "key-counts"))
    return write_clustered(counts, path, key, files or int(spark.conf.get("spark.sql.shuffle.partitions")))


def counts_of(spark: SparkSession, segments: list[str], key: str, keys: DataFrame) -> DataFrame:
    """(key, n_rows) of ``keys`` over all segments.  Null keys sort first, so
    their count is read from few row groups by the pushed filter."""
    if not segments:
        raise ValueError("no segment")
    wanted = keys.select(key).distinct()
    parts = [read_keys(spark, path, key, wanted) for path in segments]
    if not wanted.filter(F.col(key).isNull()).isEmpty():
        parts += [spark.read.parquet(f"{path}/rows").filter(F.col(key).isNull()) for path in segments]
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    return merged.groupBy(key).agg(F.sum("n_rows").alias("n_rows"))


def primary_key_violations(counts: DataFrame, table: str, key: str) -> DataFrame:
    """As ``quality.check_primary_key``, from counts."""
    return counts.filter((F.col("n_rows") > 1) | F.col(key).isNull()).select(
        F.lit(table).alias("table_name"), F.coalesce(F.col(key).cast("string"), F.lit("NULL")).alias("key_value"), "n_rows")


def foreign_key_violations(counts: DataFrame, table: str, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """As ``quality.check_foreign_key``, from counts."""
    lost = counts.filter(F.col(key).isNotNull()).join(parent.select(F.col(parent_key).alias(key)), key, "left_anti")
    return lost.select(F.lit(table).alias("table_name"), F.lit(key).alias("column_name"), F.col(key).alias("key_value"), "n_rows")


def standing(earlier: DataFrame, now: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The verdicts after a batch: ``now`` for the batch's ``keys``, and
    ``earlier`` ones (with a key_value) for all others."""
    kind = earlier.schema["key_value"].dataType.simpleString()
    value = F.col(key).cast(kind)
    touched = keys.select((F.coalesce(value, F.lit("NULL")) if kind == "string" else value).alias("key_value")).distinct()
    return earlier.join(touched, "key_value", "left_anti").select(*now.columns).unionByName(now)
