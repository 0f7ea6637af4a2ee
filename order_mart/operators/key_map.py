"""Persistent surrogate keys: a stored map from natural to surrogate keys.

A run numbers only the natural keys that the map does not hold yet, above the
map's highest surrogate, and appends them as a segment of the map's store.
Keys once given never change, whatever later runs bring, and the map is not
renumbered or written again.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from ..sinks.manifest import WHOLE, VersionedStore
from .keys import dense_surrogate_key

TABLE = "key_map"


def open_key_map(spark: SparkSession, location: str, natural: T.StructType, key_col: str) -> VersionedStore:
    """The map at ``location``: the natural key's columns and ``key_col``."""
    schema = T.StructType([*natural.fields, T.StructField(key_col, T.LongType(), False)])
    return VersionedStore(spark, os.path.join(location, TABLE), {TABLE: schema})


def new_keys(rows: DataFrame, held: DataFrame, natural: list[str], key_col: str, start: int = 1,
             num_partitions: int | None = None) -> DataFrame:
    """Natural keys of ``rows`` that ``held`` does not have, numbered in order
    above its highest surrogate (from ``start`` on where it is empty).  A NULL
    part of a key equals NULL.  One anti-join; only new keys are sorted."""
    fresh = rows.select(*natural).distinct().alias("r")
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"h.{c}")) for c in natural]
    missing = fresh.join(held.alias("h"), same, "left_anti")
    ranked = dense_surrogate_key(missing, natural, "_rank", start=1, num_partitions=num_partitions)
    above = F.coalesce(held.select(F.max(key_col)).scalar(), F.lit(start - 1))
    return ranked.select(*natural, (above + F.col("_rank")).cast("bigint").alias(key_col))


def extend_key_map(store: VersionedStore, rows: DataFrame, start: int = 1, batch_id: str | None = None) -> DataFrame:
    """Give every natural key of ``rows`` a surrogate and return the map.

    Running it again, or with rows seen before, changes nothing.  ``batch_id``
    names the run in the store's ledger; by default each run is its own.
    """
    base = store.snapshot()
    *natural, key_col = store.tables[TABLE].names
    batch_id = batch_id or f"run-{uuid.uuid4().hex}"
    if batch_id not in base.batches:
        staged = store.stage(TABLE, new_keys(rows, base.table(TABLE), natural, key_col, start))
        part = f"{base.version + 1}"                              # a segment a run; parts stay
        if store.spark.read.schema(store.tables[TABLE]).parquet(staged[WHOLE]).isEmpty():
            return base.table(TABLE)
        base = store.commit(base, batch_id, {TABLE: {part: staged[WHOLE]}}, {TABLE: [part]})
    return base.table(TABLE)


def with_surrogate(rows: DataFrame, key_map: DataFrame, natural: list[str]) -> DataFrame:
    """``rows`` with the map's surrogate, by an inner join (an extended map has
    every key).  NULL key parts match."""
    key_col = next(c for c in key_map.columns if c not in natural)
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"m.{c}")) for c in natural]
    return rows.alias("r").join(key_map.alias("m"), same).select("r.*", f"m.{key_col}")
