"""Exact deduplication through the keyed state of a streaming query.

Documents are staged once with the SHA-256 digest of their normalised text.
A Structured Streaming query reads the staged keys and keeps, in RocksDB state
without any expiry, one entry per digest: the stable identifier (smallest
doc_id) of the holder, the locator of its bytes (staged file and row) and the
group's size.  The state is read back as a table.  Every other row that hits
an entry is compared with the holder's full bytes, found through the locator;
rows whose digest agrees but whose bytes differ form groups of their own.

Only DataFrame operations run; the stream ends in a no-op sink because its
result is the state itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import scratch_path
from .common import read_table, stage

#: Copies that are compared with one replica of their holder's text.
COPIES_PER_REPLICA = 1000

_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: RocksDB for the state, all partitions of an executor within one bound of native
#: memory; no preallocated files, which would outweigh small state partitions.
_STATE_CONF = {"spark.sql.streaming.stateStore.providerClass": _ROCKSDB,
               "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
               "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
               "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "200"}
_ADDED = ("keep_id", "group_size", "kept", "text_sha256")


def normalise(text: Column) -> Column:
    """Null becomes empty; every run of ASCII white space becomes one space.
    The pattern skips single spaces, which need no change."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+", " ")


def sha256_hex(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def _locator() -> Column:
    return F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))


def _state(spark: SparkSession, path: str, schema, max_files: int | None) -> DataFrame:
    """Stream the staged keys through keyed state and read the state:
    (_digest, _holder, _size)."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    order = F.struct(F.col("_doc.doc_id").isNull().alias("no_id"), F.col("_doc.doc_id").alias("id"),
                     _locator().alias("at"))
    entries = (reader.parquet(path).select("_digest", order.alias("_order"))
               .groupBy("_digest").agg(F.min("_order").alias("holder"), F.count(F.lit(1)).alias("size")))
    checkpoint = scratch_path(spark, "exact-dedup-state")
    before = {k: spark.conf.get(k, None) for k in _STATE_CONF}
    for k, v in _STATE_CONF.items():
        spark.conf.set(k, v)
    try:
        (entries.writeStream.format("noop").outputMode("update")
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination())
        state = spark.read.format("statestore").load(checkpoint)
        holder, size = state.schema["value"].dataType.names
        return stage(state.select(state["key"].getField("_digest").alias("_digest"),
                                  state["value"].getField(holder).alias("_holder"),
                                  state["value"].getField(size).alias("_size")), "exact-dedup-index")
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def exact_dedup(docs: DataFrame, digest=sha256_hex, max_files: int | None = None) -> DataFrame:
    """Every row of ``docs`` with its columns plus keep_id (doc_id of the row
    that stays), group_size, kept and text_sha256.

    Texts are equal when identical after white-space normalisation; null
    counts as empty.  Of equal texts the row with the smallest doc_id stays; a
    null doc_id comes last, and of rows that repeat a doc_id exactly one
    stays.  An empty table gives an empty result.  Columns of ``docs`` that
    bear a result's name are replaced.  ``digest`` may be any expression of
    the normalised text, since bytes decide; ``max_files`` bounds the staged
    files in a micro-batch.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "exact-dedup-content")
    norm = normalise(F.col("text"))
    (docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in _ADDED]).alias("_doc"),
                 digest(norm).alias("_digest"), sha256_hex(norm).alias("_sha"))
         .write.option("compression", "zstd").parquet(path))
    content = spark.read.parquet(path)
    state = _state(spark, path, content.schema, max_files)
    rows = content.withColumn("_at", _locator()).join(state, "_digest")
    other = _differing(content, state)
    if other.isEmpty():
        keep_id, size, kept = F.col("_holder.id"), F.col("_size"), F.col("_at") == F.col("_holder.at")
    else:
        rows = _regrouped(rows, other)
        keep_id, size, kept = F.col("_first.id"), F.col("_count"), F.col("_at") == F.col("_first.at")
    return rows.select("_doc.*", keep_id.alias("keep_id"), size.alias("group_size"),
                       kept.alias("kept"), F.col("_sha").alias("text_sha256"))


def _differing(content: DataFrame, state: DataFrame) -> DataFrame:
    """Compare each hit with its holder's bytes; return the hits that differ:
    (_at, _order, _digest, _norm).

    Keys find the members of shared digests first, so only their texts are
    fetched, by locator.  A holder's text is replicated in proportion to its
    group, and each copy meets one replica.
    """
    replicas = F.ceil(F.col("_size") / F.lit(COPIES_PER_REPLICA)).cast("int")
    members = (content.select("_digest", F.col("_doc.doc_id").alias("_id"), _locator().alias("_at"))
               .join(state.filter("_size > 1"), "_digest")
               .select("_at", "_digest", "_id", (F.col("_at") == F.col("_holder.at")).alias("_first"),
                       replicas.alias("_replicas")))
    texts = content.select(_locator().alias("_at"), F.col("_doc.text").alias("_text"))
    found = stage(members.join(texts, "_at").withColumn("_norm", normalise(F.col("_text"))).drop("_text"),
                  "exact-dedup-hits")
    held = found.filter("_first").select(
        "_digest", F.col("_norm").alias("_held"), F.explode(F.sequence(F.lit(0), F.col("_replicas") - 1)).alias("_replica"))
    hits = found.filter("NOT _first").withColumn("_replica", F.pmod(F.xxhash64("_at"), F.col("_replicas")).cast("int"))
    return (hits.join(held, ["_digest", "_replica"]).filter(F.col("_norm") != F.col("_held"))
            .select("_at", F.struct(F.col("_id").isNull().alias("no_id"), F.col("_id").alias("id"),
                                    F.col("_at").alias("at")).alias("_order"), "_digest", "_norm"))


def _regrouped(rows: DataFrame, other: DataFrame) -> DataFrame:
    """Rows with (_first, _count) of their true group when digests collide."""
    other = stage(other, "exact-dedup-collisions")
    groups = other.groupBy("_digest", "_norm").agg(F.min("_order").alias("_own"), F.count(F.lit(1)).alias("_own_size"))
    owned = other.join(groups, ["_digest", "_norm"]).select("_at", "_own", "_own_size")
    left = other.groupBy("_digest").agg(F.count(F.lit(1)).alias("_gone"))
    return (rows.join(owned, "_at", "left").join(left, "_digest", "left")
            .withColumn("_first", F.coalesce("_own", "_holder"))
            .withColumn("_count", F.coalesce("_own_size", F.col("_size") - F.coalesce("_gone", F.lit(0)))))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP5_SQL = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents),
g AS (SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size, sha256(norm) AS text_sha256 FROM t GROUP BY norm)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, g.text_sha256
FROM t JOIN g USING (norm)
"""
