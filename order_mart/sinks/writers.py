"""Sinks: CSV, Parquet staging, warehouse tables, JDBC.

Writes are synchronous and per-table atomic at the file-commit level; the
pipeline gates all of them behind the quality checks.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header row; timestamps in ISO-8601 so they parse back."""
    (df.write.mode(mode).option("header", True)
       .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]")
       .csv(path))


def write_stage(frames: dict[str, DataFrame], base: str, mode: str = "overwrite") -> dict[str, str]:
    """Stage a map of frames as Parquet folders; returns name -> path."""
    paths = {}
    for name, df in frames.items():
        path = os.path.join(base, name)
        df.write.mode(mode).parquet(path)
        paths[name] = path
    return paths


def stage_frame(df: DataFrame, path: str) -> DataFrame:
    """Write one frame as Parquet and read it back under its own schema (an
    empty frame keeps its columns)."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def check_repoint(spark: SparkSession, table: str, schema: T.StructType) -> None:
    """Refuse to re-point ``table`` where that would publish something else
    than the staged rows: other columns (the catalog keeps its schema, absent
    ones would read as NULL), a partitioned table (partitions keep their old
    locations), or a table that owns its files or is a view.  No table yet is
    fine."""
    from .manifest import StoreError, check_fits
    if not spark.catalog.tableExists(table):
        return
    kind = spark.catalog.getTable(table).tableType
    if kind != "EXTERNAL":
        raise StoreError(f"{table} is {kind}; only an external table can change its location: drop it, or publish by 'copy' or 'manifest'")
    parts = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    if parts:
        raise StoreError(f"{table} is partitioned by {parts}; its partitions would keep their old files")
    check_fits(table, spark.table(table).schema, schema)


def repoint(spark: SparkSession, table: str, path: str) -> None:
    """Publish a staged folder as ``table`` (see ``check_repoint``): an
    existing table's location is changed in one catalog step, so the table
    never goes missing and its old files stay; otherwise an external table is
    created."""
    if spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
        spark.catalog.refreshTable(table)
    else:
        spark.catalog.createTable(table, path=path, source="parquet")


def publish(df: DataFrame, table: str, mode: str = "overwrite", path: str | None = None,
            partition_by: list[str] | None = None) -> None:
    """Write a warehouse table (catalog table, Parquet).

    ``overwrite`` replaces the table's data and schema; ``append`` adds rows by
    column name to an existing table (or creates it).
    """
    writer = df.write.mode(mode).format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path:
        writer = writer.option("path", path)
    if mode == "append" and df.sparkSession.catalog.tableExists(table):
        df.select(*df.sparkSession.table(table).columns).write.insertInto(table)
        return
    writer.saveAsTable(table)


def publish_overwrite(df: DataFrame, table: str, **kw) -> None:
    publish(df, table, "overwrite", **kw)


def publish_append(df: DataFrame, table: str, **kw) -> None:
    publish(df, table, "append", **kw)


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append",
               properties: dict[str, str] | None = None, batch_size: int = 10_000,
               num_partitions: int | None = None) -> None:
    """Append (or overwrite) rows into a relational table.  Each Spark task
    writes its partition over its own connection; ``num_partitions`` caps the
    number of concurrent connections."""
    out = df.coalesce(num_partitions) if num_partitions else df
    writer = (out.write.format("jdbc").mode(mode).option("url", url).option("dbtable", table)
              .option("batchsize", batch_size))
    for k, v in (properties or {}).items():
        writer = writer.option(k, v)
    writer.save()


def staging_table_name(table: str) -> str:
    return f"{table}__staging"


def swap_in(spark: SparkSession, df: DataFrame, table: str) -> None:
    """Overwrite a table with a result that was computed *from* that table:
    materialise to a staging table first, then overwrite from the staging copy
    (Spark refuses to overwrite a table it is reading)."""
    stage = staging_table_name(table)
    df.write.mode("overwrite").format("parquet").saveAsTable(stage)
    spark.table(stage).write.mode("overwrite").format("parquet").saveAsTable(table)
    spark.sql(f"DROP TABLE IF EXISTS {stage}")
