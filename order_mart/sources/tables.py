"""Parquet sources with explicit schemas, and staged-table maps."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .. import schemas


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Full scan of one Parquet table.  With a schema the files are read with
    it (no inference pass; missing columns read as NULL).  Column pruning and
    filter pushdown happen when the caller selects/filters the result."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def read_sources(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """The four source tables stored as ``{base}/{name}`` Parquet folders."""
    return {name: read_table(spark, os.path.join(base, name), schema)
            for name, schema in schemas.SOURCES.items()}


def read_stage(spark: SparkSession, base: str, names: list[str] | dict[str, T.StructType]
               ) -> dict[str, DataFrame]:
    """Read a staged map of tables back (name -> DataFrame)."""
    if isinstance(names, dict):
        return {n: read_table(spark, os.path.join(base, n), s) for n, s in names.items()}
    return {n: read_table(spark, os.path.join(base, n)) for n in names}
