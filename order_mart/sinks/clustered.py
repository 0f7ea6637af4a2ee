"""Range-clustered tables with a zone map, so that keyed reads open few files.

``write_clustered`` cuts a table into files by ranges of an integer key, sorts
each file, lets the writer store Bloom filters of the key, and keeps a zone map
(file, lowest and highest key, rows) beside the data.  ``read_keys`` joins the
wanted keys with the zone map first and scans only the files whose zone holds
one of them; within these, row-group statistics and Bloom filters skip further.

Rows of one key are cut into several files if they are many, as ties are
ordered by a hash of the row; such files share the key as a bound.  Rows with a
null key are kept and are never found by key.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import ByteType, IntegerType, LongType, ShortType

#: Files that a keyed read lists by name; a read that touches more scans the
#: whole table, with the same result.
MAX_FILES = 10_000
#: Keys that a keyed read passes to the scan as literals.
MAX_LITERALS = 1_000

_TIE = "_cluster_tie"


def _rows(path: str) -> str:
    return os.path.join(path, "rows")


def zones(spark: SparkSession, path: str) -> DataFrame:
    """(file, low, high, n) of a clustered table: bounds are null where a
    file holds null keys only."""
    return spark.read.parquet(os.path.join(path, "zones"))


def write_clustered(df: DataFrame, path: str, key: str, files: int) -> DataFrame:
    """Write ``df`` under ``path`` in about ``files`` files by ranges of
    ``key`` and return it as read from there.  ``df`` should be staged or
    scanned, as the range bounds are sampled in a job of their own."""
    if not isinstance(df.schema[key].dataType, (ByteType, ShortType, IntegerType, LongType)):
        raise ValueError(f"{key} is not an integer column")
    spark = df.sparkSession
    (df.withColumn(_TIE, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
     .repartitionByRange(files, key, _TIE).sortWithinPartitions(key, _TIE).drop(_TIE)
     .write.mode("overwrite").option(f"parquet.bloom.filter.enabled#{key}", "true")
     .option("parquet.bloom.filter.adaptive.enabled", "true").parquet(_rows(path)))
    rows = spark.read.schema(df.schema).parquet(_rows(path))
    (rows.groupBy(F.col("_metadata.file_name").alias("file"))
     .agg(F.min(key).cast("long").alias("low"), F.max(key).cast("long").alias("high"), F.count("*").alias("n"))
     .write.mode("overwrite").parquet(os.path.join(path, "zones")))
    return rows


def touched_files(spark: SparkSession, path: str, key: str, keys: DataFrame) -> DataFrame:
    """(file): the files whose zone holds one of ``keys``.

    Zones are laid over bins as wide as a zone is on average, so the match is
    an equi-join on the bin and not a comparison of all zones with all keys.
    Zones overlap in their bounds only, hence there are at most about two bins
    a file."""
    z = zones(spark, path).filter("low IS NOT NULL")
    n, low, high = z.agg(F.count("*"), F.min("low"), F.max("high")).first()
    if not n:
        return z.select("file")
    width = (high - low) // n + 1
    bins = z.select("file", "low", "high", F.explode(F.expr(f"sequence(low div {width}, high div {width})")).alias("bin"))
    wanted = (keys.select(F.col(key).cast("long").alias("wanted")).filter(F.col("wanted").between(low, high)).distinct()
              .withColumn("bin", F.expr(f"wanted div {width}")))
    bins = F.broadcast(bins) if n <= MAX_FILES else bins
    return wanted.join(bins, "bin").filter("wanted BETWEEN low AND high").select("file").distinct()


def read_keys(spark: SparkSession, path: str, key: str, keys: DataFrame) -> DataFrame:
    """The rows whose ``key`` is in ``keys`` (a frame with that column, read
    several times; repeated and null keys are allowed)."""
    whole = spark.read.parquet(_rows(path))
    hit = [r.file for r in touched_files(spark, path, key, keys).limit(MAX_FILES + 1).collect()]
    if not hit:
        return whole.filter(F.lit(False))
    rows = whole if len(hit) > MAX_FILES else spark.read.schema(whole.schema).parquet(*[os.path.join(_rows(path), f) for f in sorted(hit)])
    wanted = keys.select(key).filter(F.col(key).isNotNull()).distinct()
    few = [r[0] for r in wanted.limit(MAX_LITERALS + 1).collect()]
    if len(few) <= MAX_LITERALS:
        return rows.filter(F.col(key).isin(few))
    return rows.join(wanted, key, "left_semi").select(*whole.columns)
