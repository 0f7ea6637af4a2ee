"""Date-partitioned targets and partition-scoped increments.

The order-keyed targets are published partitioned by a date taken from their
own timestamp:

* ``fact_daily_orders``  by ``received_date`` (an order's received date never
  moves, so an order's row stays in one partition across refreshes);
* ``f_order_details``    by ``delivery_date``;
* ``dim_order``          by ``event_date``.

An increment then rewrites only the partitions that hold an affected order,
before or after the refresh.  New orders and late deliveries sit in recent
dates, so a daily increment touches a handful of partitions.  The rest of the
table is neither read (static partition filter from the bounded list of
touched dates) nor rewritten (dynamic partition overwrite).  The master-data dimensions are small
and are rebuilt.
"""

from __future__ import annotations

import contextlib
import datetime as dt
import os

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import schemas
from ..config import scratch_path
from ..sinks.writers import stage_frame
from . import dims
from .facts import f_order_details, fact_daily_orders
from .incremental import gate_sources, incremental_status, stage_affected, stage_increment
from .pipeline import PipelineResult, QualityError, _run_all, build_targets, check_summary, target_checks

Sources = dict[str, DataFrame]

DATE_PARTITIONS = {
    "fact_daily_orders": ("received_date", "order_received_timestamp"),
    "f_order_details": ("delivery_date", "order_delivery_timestamp"),
    "dim_order": ("event_date", "order_status_update_timestamp"),
}


def with_partition_date(name: str, df: DataFrame, grain: str = "day") -> DataFrame:
    """Add the partition date (``grain`` 'day' or 'month': first day of the
    month, for histories too thin to fill daily partitions)."""
    if name not in DATE_PARTITIONS:
        return df
    date_col, ts_col = DATE_PARTITIONS[name]
    day = F.to_date(ts_col)
    return df.withColumn(date_col, day if grain == "day" else F.trunc(day, "month"))


@contextlib.contextmanager
def _dynamic_overwrite(spark: SparkSession):
    key = "spark.sql.sources.partitionOverwriteMode"
    old = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(key, old)


def _check(src: Sources, staged: dict[str, DataFrame], enforce: bool, stage_dir: str, more: DataFrame | None = None) -> list[dict]:
    violations = [r.asDict() for r in check_summary(src, {}, stage_dir, more).collect()]
    canonical = {n: df.drop(*[c for c, _ in DATE_PARTITIONS.values() if c in df.columns])
                 for n, df in staged.items()}
    violations += [r.asDict() for r in target_checks(canonical).collect()]
    if violations and enforce:
        raise QualityError(violations)
    return violations


def run_pipeline_partitioned(spark: SparkSession, src: Sources, database: str,
                             as_of: dt.date | str | None = None, stage_dir: str | None = None,
                             enforce: bool = True, concurrency: int = 3, grain: str = "day",
                             more_checks: DataFrame | None = None) -> PipelineResult:
    """Full build with the order-keyed targets partitioned by date."""
    targets = {n: with_partition_date(n, df, grain) for n, df in build_targets(src, as_of).items()}
    stage_dir = stage_dir or scratch_path(spark, "stage")
    staged = {n: os.path.join(stage_dir, n) for n in targets}

    _run_all([lambda n=n: stage_frame(targets[n], staged[n]) for n in targets], concurrency)
    frames = {n: spark.read.schema(targets[n].schema).parquet(p) for n, p in staged.items()}
    violations = _check(src, frames, enforce, stage_dir, more_checks)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for n, df in frames.items():
        w = df.select(*targets[n].columns).write.mode("overwrite").format("parquet")
        if n in DATE_PARTITIONS:
            w = w.partitionBy(DATE_PARTITIONS[n][0])
        w.saveAsTable(f"{database}.{n}")
    return PipelineResult([f"{database}.{n}" for n in targets], staged, violations)


#: Touched partitions that an increment may have; beyond it, rebuild the table.
MAX_TOUCHED = 10_000


def touched_partitions(rebuilt: DataFrame, previous: DataFrame, affected: DataFrame, date_col: str) -> list:
    """Partition values that hold a rebuilt row, or held a row of an affected
    order before (read from key and partition column only).  The list is used
    as a static partition filter, so untouched partitions are neither listed,
    read nor rewritten; its length is checked against ``MAX_TOUCHED``."""
    held = previous.select("orderid", date_col).join(affected, "orderid", "left_semi").select(date_col)
    values = rebuilt.select(date_col).unionByName(held).distinct().limit(MAX_TOUCHED + 1).collect()
    if len(values) > MAX_TOUCHED:
        raise ValueError(f"the increment touches more than {MAX_TOUCHED} partitions of {date_col}; "
                         "run a full build or use grain='month'")
    return [r[0] for r in values]


def refreshed_partitions(previous: DataFrame, rebuilt: DataFrame, affected: DataFrame,
                         date_col: str, touched: list) -> DataFrame:
    """New content of the touched partitions (the one without a date among
    them): their rows of unaffected orders plus the rebuilt rows."""
    held = F.col(date_col).isin([v for v in touched if v is not None])
    kept = (previous.filter(held | F.col(date_col).isNull() if None in touched else held)
            .join(affected, "orderid", "left_anti").select(*previous.columns))
    return kept.unionByName(rebuilt.select(*previous.columns))


def _drop_emptied(spark: SparkSession, table: str, date_col: str, touched: list, staged: DataFrame) -> None:
    """Drop touched partitions without a row left, which a dynamic overwrite
    leaves as they were."""
    left = {r[0] for r in staged.select(date_col).distinct().collect()}
    for value in touched:
        if value not in left:
            literal = "NULL" if value is None else f"DATE'{value}'"
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({date_col} = {literal})")


def refresh_partitions(spark: SparkSession, src: Sources, increment: DataFrame, table: str, grain: str = "day") -> None:
    """Bring one date-partitioned ``fact_daily_orders`` table up to date with
    an increment of status rows; the table is built if it does not exist."""
    name = "fact_daily_orders"
    date_col = DATE_PARTITIONS[name][0]
    if not spark.catalog.tableExists(table):
        (with_partition_date(name, fact_daily_orders(src), grain).write.format("parquet")
         .partitionBy(date_col).saveAsTable(table))
        return
    stage_dir = scratch_path(spark, "stream")
    scoped, affected = stage_affected(src, increment, stage_dir)
    previous = spark.table(table)
    fresh = stage_frame(with_partition_date(name, fact_daily_orders(scoped), grain), os.path.join(stage_dir, "rebuilt"))
    touched = touched_partitions(fresh, previous, affected, date_col)
    if touched:
        staged = stage_frame(refreshed_partitions(previous, fresh, affected, date_col, touched), os.path.join(stage_dir, name))
        with _dynamic_overwrite(spark):
            staged.select(*previous.columns).write.insertInto(table, overwrite=True)
        _drop_emptied(spark, table, date_col, touched, staged)


def run_incremental_partitioned(spark: SparkSession, src: Sources, database: str,
                                cutoff: dt.datetime | str, as_of: dt.date | str | None = None,
                                stage_dir: str | None = None, enforce: bool = True,
                                grain: str = "day", more_checks: DataFrame | None = None) -> PipelineResult:
    """Apply the status rows at/after ``cutoff``, rewriting only the date
    partitions that hold or held affected orders (tables from
    ``run_pipeline_partitioned`` with the same ``grain``).  An increment that
    rebuilds nothing for a target leaves its other partitions alone."""
    stage_dir = stage_dir or scratch_path(spark, "stage")
    scoped, affected = stage_increment(spark, src, cutoff, stage_dir)
    rebuilt = {
        "dim_order": dims.dim_order(scoped),
        "fact_daily_orders": fact_daily_orders(scoped),
        "f_order_details": f_order_details(scoped),
    }
    staged: dict[str, str] = {}
    frames: dict[str, DataFrame] = {}
    touched: dict[str, list] = {}
    for n, df in rebuilt.items():
        date_col = DATE_PARTITIONS[n][0]
        previous = spark.table(f"{database}.{n}")
        fresh = stage_frame(with_partition_date(n, df, grain), os.path.join(stage_dir, f"{n}__rebuilt"))
        touched[n] = touched_partitions(fresh, previous, affected, date_col)
        if touched[n]:
            staged[n] = os.path.join(stage_dir, n)
            frames[n] = stage_frame(refreshed_partitions(previous, fresh, affected, date_col, touched[n]), staged[n])
    full_dims = {"dim_customer": dims.dim_customer(src), "dim_address": dims.dim_address(src),
                 "dim_product": dims.dim_product(src, as_of)}
    for n, df in full_dims.items():
        staged[n] = os.path.join(stage_dir, n)
        frames[n] = stage_frame(df, staged[n])
    gated = gate_sources(src, scoped, incremental_status(src["order_details"], cutoff))
    violations = _check(gated, frames, enforce, stage_dir, more_checks)
    with _dynamic_overwrite(spark):
        for n in rebuilt:
            if touched[n]:
                table, date_col = f"{database}.{n}", DATE_PARTITIONS[n][0]
                frames[n].select(*spark.table(table).columns).write.insertInto(table, overwrite=True)
                _drop_emptied(spark, table, date_col, touched[n], frames[n])
    for n in full_dims:
        frames[n].write.mode("overwrite").format("parquet").saveAsTable(f"{database}.{n}")
    return PipelineResult([f"{database}.{n}" for n in schemas.TARGETS], staged, violations)
