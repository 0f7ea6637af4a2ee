"""run_pipeline: sources -> six targets -> quality gate -> publish.

1. Every target is computed once and staged as Parquet in the shared
   checkpoint folder (durable: a lost executor costs a task retry, not a
   re-run, and the publish step reads files, not a recomputed plan).
2. All checks run on the staged copies and on the sources; the outcome is a
   small summary (one row per check), the only thing the driver collects.
3. Only when every check is clean are the targets published, each from its
   staged copy.
"""

from __future__ import annotations

import datetime as dt
import os
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from .. import schemas
from ..config import scratch_path
from ..functions import normalized_status
from ..operators import quality, relational
from ..sinks.manifest import WHOLE, Snapshot, open_store
from ..sinks.writers import check_repoint, publish, repoint, stage_frame
from . import dims, facts

Sources = dict[str, DataFrame]


def build_targets(src: Sources, as_of: dt.date | str | None = None) -> dict[str, DataFrame]:
    """The six canonical targets as lazy DataFrames."""
    return {
        "dim_order": dims.dim_order(src),
        "fact_daily_orders": facts.fact_daily_orders(src),
        "dim_customer": dims.dim_customer(src),
        "dim_address": dims.dim_address(src),
        "dim_product": dims.dim_product(src, as_of),
        "f_order_details": facts.f_order_details(src),
    }


def build_pipeline_targets(src: Sources, as_of: dt.date | str | None = None) -> dict[str, DataFrame]:
    """The same six tables with the pandas transform's rules and names."""
    keyed = dims.address_keys(src)
    return {
        "dim_orders": relational.rename_columns(
            dims.dim_order(src), {"orderid": "order_id"}),
        "dim_product": dims.dim_product_pipeline(src, as_of),
        "dim_address": dims.dim_address_pipeline(src, keyed),
        "dim_cust": dims.dim_customer_pipeline(src, keyed),
        "fact_daily_orders": facts.fact_daily_orders_pipeline(src),
        "f_order_details": facts.f_order_details_pipeline(src),
    }


def build_sql_targets(src: Sources, as_of: dt.date | str | None = None) -> dict[str, DataFrame]:
    """The tables of the SQL transform: the canonical dimensions and item fact
    with the SQL variant of the order fact, sorted by order as it was."""
    return {**build_targets(src, as_of), "fact_daily_orders": facts.fact_daily_orders_sql(src, ordered=True)}


def check_summary(src: Sources, targets: dict[str, DataFrame], stage_dir: str | None = None,
                  more: DataFrame | None = None) -> DataFrame:
    """One row per check: (check, table_name, column_name, n_violations).
    ``more`` adds rows of the same columns, such as the values that a text
    source lost (``sources.files.lost_values``).

    The two large tables are read once each: a grouping-sets aggregate of all
    that their checks need (see ``status_history_summary``, ``item_summary``)
    is written under ``stage_dir`` (a scratch folder by default), and every
    check reads that summary.  This runs two jobs; the checks themselves are
    lazy and reduce to one number or one row per column.
    """
    spark = src["order_details"].sparkSession
    stage_dir = stage_dir or scratch_path(spark, "gate")
    history = stage_frame(status_history_summary(src["order_details"]), os.path.join(stage_dir, "gate__order_details"))
    items = stage_frame(item_summary(src["order_items"]), os.path.join(stage_dir, "gate__order_items"))
    parts: list[DataFrame] = []
    for table, keys in schemas.PRIMARY_KEYS.items():
        parts.append(_total(quality.check_primary_key(src[table], table, keys),
                            "primary_key", table, ",".join(keys), "n_rows"))
    for table in ("customer_master", "product_master"):
        parts.append(_per_column(
            quality.check_varchar_length(src[table], table, quality.source_varchar_limits(table)),
            "varchar_length", "n_too_long"))
    parts += _status_history_checks(history, src["customer_master"])
    parts += _item_checks(items, src["product_master"])
    if targets:
        parts.append(target_checks(targets))
    if more is not None:
        parts.append(more.select("check", "table_name", "column_name", F.col("n_violations").cast("bigint")))
    return relational.union_all(*parts).filter(F.col("n_violations") > 0)


def _total(df: DataFrame, check: str, table: str, column: str, count_col: str | None = None) -> DataFrame:
    n = F.sum(count_col) if count_col else F.count(F.lit(1))
    return df.agg(F.coalesce(n.cast("bigint"), F.lit(0)).alias("n_violations")).select(
        F.lit(check).alias("check"), F.lit(table).alias("table_name"),
        F.lit(column).alias("column_name"), "n_violations")


def _per_column(df: DataFrame, check: str, count_col: str) -> DataFrame:
    return df.select(F.lit(check).alias("check"), "table_name", "column_name",
                     F.col(count_col).cast("bigint").alias("n_violations"))


def status_history_summary(order_details: DataFrame) -> DataFrame:
    """What the checks of ``order_details`` need, in one scan and one exchange:
    a grouping-sets aggregate by customer, by status, by order and overall
    (``gid`` 3, 5, 6, 7), whose partial step runs map-side."""
    limit = schemas.VARCHAR_LIMITS[("order_details", "order_status")]
    return (order_details.groupingSets([["customerid"], ["order_status"], ["orderid"], []],
                                       "customerid", "order_status", "orderid")
            .agg(F.grouping_id().alias("gid"),
                 F.count(F.lit(1)).alias("n_rows"),
                 F.min("customerid").alias("min_customerid"),
                 F.max("customerid").alias("max_customerid"),
                 F.count_if(F.col("customerid").isNull()).alias("n_null_customer"),
                 F.count_if(F.char_length("order_status") > limit).alias("n_too_long")))


def item_summary(order_items: DataFrame) -> DataFrame:
    """The same for ``order_items``: by product and overall (``gid`` 0, 1)."""
    return (order_items.groupingSets([["productid"], []], "productid")
            .agg(F.grouping_id().alias("gid"), F.count(F.lit(1)).alias("n_rows"),
                 F.count_if(F.col("orderid").isNull()).alias("n_null")))


def _status_history_checks(summary: DataFrame, customers: DataFrame) -> list[DataFrame]:
    """Foreign key, status domain, one customer per order and VARCHAR length."""
    by_customer, by_status, by_order, overall = (summary.filter(F.col("gid") == i) for i in (3, 5, 6, 7))
    orphans = by_customer.filter(F.col("customerid").isNotNull()).join(customers.select("customerid"), "customerid", "left_anti")
    domain = [s.lower() for s in schemas.STATUS_DOMAIN]
    bad_status = by_status.filter(~F.coalesce(normalized_status("order_status").isin(*domain), F.lit(False)))
    several = by_order.filter(F.col("orderid").isNotNull() & (
        (F.col("min_customerid") != F.col("max_customerid"))
        | ((F.col("n_null_customer") > 0) & F.col("min_customerid").isNotNull())))
    return [
        _total(orphans, "foreign_key", "order_details", "customerid", "n_rows"),
        _total(bad_status, "status_domain", "order_details", "order_status", "n_rows"),
        _total(several, "one_customer_per_order", "order_details", "customerid"),
        _total(overall, "varchar_length", "order_details", "order_status", "n_too_long"),
    ]


def _item_checks(summary: DataFrame, products: DataFrame) -> list[DataFrame]:
    """Foreign key (productid) and NOT NULL (orderid)."""
    orphans = (summary.filter((F.col("gid") == 0) & F.col("productid").isNotNull())
               .join(products.select("productid"), "productid", "left_anti"))
    return [
        _total(orphans, "foreign_key", "order_items", "productid", "n_rows"),
        _total(summary.filter(F.col("gid") == 1), "not_null", "order_items", "orderid", "n_null"),
    ]


def target_checks(targets: dict[str, DataFrame], not_null: dict[str, list[str]] | None = None) -> DataFrame:
    """NOT NULL columns of every (staged) target, one row per column; by
    default those of the canonical targets."""
    if not_null is None:
        not_null = {t: schemas.not_null_columns(s) for t, s in schemas.TARGETS.items()}
    parts = []
    for table, df in targets.items():
        cols = not_null.get(table, [])
        if cols:
            parts.append(quality.check_not_null(df, table, cols).select(
                F.lit("not_null").alias("check"), "table_name", "column_name",
                F.col("n_null").cast("bigint").alias("n_violations")))
    spark = next(iter(targets.values())).sparkSession if targets else None
    if not parts:
        return spark.createDataFrame([], "check string, table_name string, column_name string, "
                                         "n_violations bigint") if spark else None
    return relational.union_all(*parts).filter(F.col("n_violations") > 0)


def declared(targets: dict[str, DataFrame], not_null: dict[str, list[str]] | None) -> dict[str, T.StructType]:
    """Schemas that the targets are published under, NOT NULL columns marked."""
    if not_null is None:
        return schemas.TARGETS
    return {n: T.StructType([T.StructField(f.name, f.dataType, f.name not in not_null.get(n, [])) for f in df.schema.fields])
            for n, df in targets.items()}


class QualityError(RuntimeError):
    def __init__(self, violations: list[dict]):
        self.violations = violations
        super().__init__(f"{len(violations)} quality check(s) failed: {violations[:5]}")


@dataclass
class PipelineResult:
    published: list[str]
    staged: dict[str, str]
    violations: list[dict] = field(default_factory=list)


def run_pipeline(spark: SparkSession, src: Sources, database: str, as_of: dt.date | str | None = None,
                 variant: str = "canonical", mode: str = "overwrite",
                 stage_dir: str | None = None, enforce: bool = True,
                 concurrency: int = 3, publish_by: str = "copy", more_checks: DataFrame | None = None) -> PipelineResult:
    """Build, stage, check and publish the six targets into ``database``.

    The targets are independent jobs; ``concurrency`` of them are submitted
    at once from driver threads so one job's tail tasks overlap the next
    job's work (only job handles live on the driver, never data).
    ``more_checks`` adds rows to the gate (see ``check_summary``).

    ``publish_by`` (the last two for overwrite only, both without a second write):

    * ``"copy"`` writes each table again from its staged copy;
    * ``"swap"`` re-points each catalog table at its folder in ``stage_dir``
      (durable, versioned, the caller's, e.g. ``<warehouse>/<db>/run=<id>``).
      Tables of other columns, partitioned ones and those that own their files
      are refused before anything is staged.  The tables change one by one;
    * ``"manifest"`` stages into the database's store and publishes all six
      tables by one pointer (``sinks.manifest``): readers see the old version
      or the new one, and a failed run leaves the old one."""
    builders = {"canonical": build_targets, "pipeline": build_pipeline_targets, "sql": build_sql_targets}
    targets = builders[variant](src, as_of)
    return stage_check_publish(spark, src, targets, database, mode=mode, stage_dir=stage_dir,
                               enforce=enforce, concurrency=concurrency, publish_by=publish_by,
                               not_null=schemas.NOT_NULL[variant], more_checks=more_checks)


def run_incremental(spark: SparkSession, src: Sources, database: str, cutoff: dt.datetime | str,
                    as_of: dt.date | str | None = None, stage_dir: str | None = None,
                    enforce: bool = True, concurrency: int = 3, publish_by: str = "copy",
                    more_checks: DataFrame | None = None) -> PipelineResult:
    """Apply the status rows at/after ``cutoff`` to the published targets.

    The affected orders' history and items are staged once for the targets;
    the quality gate reads ``gate_sources`` (the masters in full).  The
    refreshed targets read the published tables, so they are staged before
    anything is overwritten.  ``plans.state.apply_batch`` does the same
    without reading the history."""
    from .incremental import gate_sources, incremental_status, refresh_targets, stage_increment
    _needs_folder(publish_by, stage_dir)
    stage_dir = stage_dir or scratch_path(spark, "stage")
    base = open_store(spark, database, schemas.TARGETS).snapshot() if publish_by == "manifest" else None
    previous = {t: base.table(t) if base else spark.table(f"{database}.{t}") for t in schemas.TARGETS}
    scoped, affected = stage_increment(spark, src, cutoff, stage_dir)
    targets = refresh_targets(previous, src, scoped, affected, as_of)
    gated = gate_sources(src, scoped, incremental_status(src["order_details"], cutoff))
    return stage_check_publish(spark, gated, targets, database, mode="overwrite", stage_dir=stage_dir,
                               enforce=enforce, concurrency=concurrency, publish_by=publish_by, more_checks=more_checks, base=base)


def _needs_folder(publish_by: str, stage_dir: str | None) -> None:
    if publish_by == "swap" and not stage_dir:
        raise ValueError("publish_by='swap' publishes the staged files themselves; name their durable folder with stage_dir")


def stage_check_publish(spark: SparkSession, src: Sources, targets: dict[str, DataFrame], database: str,
                        mode: str = "overwrite", stage_dir: str | None = None, enforce: bool = True,
                        concurrency: int = 3, publish_by: str = "copy", not_null: dict[str, list[str]] | None = None,
                        more_checks: DataFrame | None = None, base: Snapshot | None = None) -> PipelineResult:
    _needs_folder(publish_by, stage_dir)
    if publish_by != "copy" and mode != "overwrite":
        raise ValueError(f"publish_by={publish_by!r} replaces tables; it cannot append")
    stage_dir = stage_dir or scratch_path(spark, "stage")
    staged = {name: os.path.join(stage_dir, name) for name in targets}
    if publish_by == "swap":
        for n, df in targets.items():
            check_repoint(spark, f"{database}.{n}", df.schema)
    if publish_by == "manifest" and base is None:
        base = open_store(spark, database, declared(targets, not_null)).snapshot()

    def stage_one(n: str) -> None:
        if publish_by == "manifest":
            staged[n] = base.store.stage(n, targets[n])[WHOLE]
        else:
            stage_frame(targets[n], staged[n])

    source_violations: list[dict] = []
    jobs = [lambda n=n: stage_one(n) for n in targets]
    jobs.append(lambda: source_violations.extend(r.asDict() for r in check_summary(src, {}, stage_dir, more_checks).collect()))
    _run_all(jobs, concurrency)
    staged_frames = {n: spark.read.schema(targets[n].schema).parquet(p) for n, p in staged.items()}
    violations = source_violations + [r.asDict() for r in target_checks(staged_frames, not_null).collect()]
    if violations and enforce:
        raise QualityError(violations)
    published = [f"{database}.{name}" for name in staged_frames]
    if publish_by == "manifest":
        base.store.commit(base, f"run-{uuid.uuid4().hex}", {n: {WHOLE: p} for n, p in staged.items()})
        return PipelineResult(published, staged, violations)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    if publish_by == "swap":
        for n, path in staged.items():
            check_repoint(spark, f"{database}.{n}", targets[n].schema)
        for n, path in staged.items():
            repoint(spark, f"{database}.{n}", path)
        return PipelineResult(published, staged, violations)
    _run_all([lambda n=n: publish(staged_frames[n], f"{database}.{n}", mode) for n in staged_frames],
             concurrency)
    return PipelineResult(published, staged, violations)


def _run_all(jobs: list, concurrency: int) -> None:
    """Run Spark actions from a few driver threads; re-raise the first error."""
    if concurrency <= 1:
        for job in jobs:
            job()
        return
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=concurrency) as pool:
        for fut in [pool.submit(job) for job in jobs]:
            fut.result()
