"""Increments on stored state: a batch is merged, the history is not read.

``apply_batch`` takes the new status rows and item lines alone (and the
masters), under a batch id.  State tables are kept beside the six
targets, all order-keyed tables split into ranges of the order key:

* ``order_state``   one merged state per order (see ``operators.order_state``);
* ``order_events``  distinct status events with counts;
* ``order_lines``   distinct item lines with counts.

Two more hold the number of rows by foreign key, ``customer_rows`` and
``product_rows``, so that the foreign keys of all batches are checked against
the masters as they are now without reading those batches.

A batch touches the ranges that its orders lie in.  New orders have the
highest keys and late deliveries follow soon, so these are few; no file of
another range is listed, read or written.  The touched ranges are merged,
their targets derived from the merged state, checked, and published together
with the batch id as the next version of the database's store
(``sinks.manifest``).  A batch id that was published before changes nothing.

Item amounts are taken at the product's rate when a line arrives; pincodes are
those of the masters when an order's range was last touched.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import schemas
from ..config import scratch_path
from ..operators import order_state as ops
from ..operators import quality, relational
from ..sinks.manifest import MAX_PARTS, Segment, Snapshot, StoreError, VersionedStore, open_parts, open_store
from . import dims
from .pipeline import PipelineResult, QualityError, _run_all, check_summary, target_checks

Sources = dict[str, DataFrame]

STATE_TABLES = {"order_state": ops.ORDER_STATE, "order_events": ops.ORDER_EVENTS, "order_lines": ops.ORDER_LINES}
#: Rows by foreign key: state table -> (source, key, master, master's key).
KEY_ROWS = {"customer_rows": ("order_details", "customerid", "customer_master", "customerid"),
            "product_rows": ("order_items", "productid", "product_master", "productid")}
#: Tables split by the order key, or by their own; the masters' are replaced.
BY_RANGE = (*STATE_TABLES, "dim_order", "fact_daily_orders", "f_order_details")
#: Order keys in a range: some hundred megabytes of state, events or lines.
RANGE_WIDTH = 1_000_000


def order_range(width: int, col: str = "orderid") -> Column:
    """Name of the range that an order key lies in; it says the width, so a
    store is not mixed from ranges of several widths."""
    return F.concat_ws("x", F.lit(width).cast("string"), F.floor(F.col(col) / width).cast("string"))


def open_state(spark: SparkSession, database: str) -> VersionedStore:
    return open_store(spark, database, {**schemas.TARGETS, **STATE_TABLES, **{n: ops.key_rows_schema(k[1]) for n, k in KEY_ROWS.items()}})


def touched_ranges(orders: DataFrame, base: Snapshot, table: str = "order_state") -> list[str]:
    """Ranges of the batch's orders; their number is checked, and that
    ``table`` is split into ranges of the same width."""
    found = [r[0] for r in orders.select("_range").distinct().limit(MAX_PARTS + 1).collect()]
    if len(found) > MAX_PARTS:
        raise StoreError(f"the batch touches more than {MAX_PARTS} ranges; choose wider ones")
    width = found[0].split("x")[0] if found else None
    if any(p.split("x")[0] != width for p in base.parts(table)) and width:
        raise StoreError(f"the store's ranges are not {width} keys wide")
    return found


def batch_states(src: Sources, width: int) -> dict[str, DataFrame]:
    """The batch's own state tables."""
    made = {"order_state": ops.order_state(src["order_details"], src["order_items"], src["product_master"]),
            "order_events": ops.event_counts(src["order_details"]), "order_lines": ops.line_counts(src["order_items"])}
    return {name: df.withColumn("_range", order_range(width)) for name, df in made.items()}


def batch_ranges(src: Sources, width: int) -> DataFrame:
    """(_range): the ranges of the batch's rows, read from their keys alone."""
    keys = relational.union_all(*[src[t].select("orderid") for t in ("order_details", "order_items")])
    return keys.filter(F.col("orderid").isNotNull()).select(order_range(width).alias("_range")).distinct()


def merged(base: Snapshot, fresh: dict[str, DataFrame], ranges: list[str], width: int) -> dict[str, DataFrame]:
    """The touched ranges of the state tables after the batch.  Where none of
    them holds rows yet, the batch's own states are all there is."""
    out = {}
    for name, df in fresh.items():
        if not any(r in base.parts(name) for r in ranges):
            out[name] = df
            continue
        merge = ops.merge_states if name == "order_state" else ops.merge_counts
        out[name] = merge(base.table(name, ranges), df.drop("_range")).withColumn("_range", order_range(width))
    return out


def apply_batch(spark: SparkSession, src: Sources, database: str, batch_id: str, as_of: dt.date | str | None = None,
                width: int = RANGE_WIDTH, enforce: bool = True, concurrency: int = 3,
                more_checks: DataFrame | None = None) -> PipelineResult:
    """Merge a batch into a database's state and publish its targets.

    ``src``: the new rows of ``order_details`` and ``order_items``, and both
    masters in full.  The first batch of a database builds it.  The result
    equals a full build over the rows of all batches (with masters as they
    were), whatever their order; rows repeated in other batches count as in a
    full build.  The gate checks the batch's rows, the masters, the touched
    orders' customers over all batches, and the touched ranges' targets.
    """
    store = open_state(spark, database)
    base = store.snapshot()
    published = [f"{database}.{t}" for t in schemas.TARGETS]
    if batch_id in base.batches:
        return PipelineResult(published, {})
    folder = scratch_path(spark, "batch")
    violations: list[dict] = []
    own = batch_states(src, width)
    ranges = touched_ranges(batch_ranges(src, width), base)

    staged: dict[str, dict[str, str]] = {}

    def stage(tables: dict[str, DataFrame], part: str | None = None) -> list:
        return [lambda n=n, df=df: staged.update({n: store.stage(n, df, part, ("orderid",) if part else ())}) for n, df in tables.items()]

    masters = {"dim_customer": dims.dim_customer(src), "dim_address": dims.dim_address(src), "dim_product": dims.dim_product(src, as_of)}
    with open_parts(spark):
        _run_all([*stage(merged(base, own, ranges, width), "_range"), lambda: violations.extend(_rows(check_summary(src, {}, folder, more_checks))),
                  *stage(masters), *stage(merged_keys(base, src))], concurrency)
    state, events, lines = (_staged(store, base, staged).table(n) for n in STATE_TABLES)
    targets = {"dim_order": ops.dim_order_of(events),
               "fact_daily_orders": ops.fact_of_states(state, src["customer_master"]),
               "f_order_details": ops.f_order_details_of(events, lines)}
    with open_parts(spark):
        _run_all(stage({n: df.withColumn("_range", order_range(width)) for n, df in targets.items()}, "_range"), concurrency)

    after = _staged(store, base, staged)
    violations += _rows(_state_checks(src, state).unionByName(_key_checks(src, after)).unionByName(target_checks({t: after.table(t) for t in schemas.TARGETS})))
    if violations and enforce:
        raise QualityError(violations)
    store.commit(base, batch_id, staged, {n: ranges for n in BY_RANGE})
    return PipelineResult(published, {n: p for n, own in staged.items() for p in own.values()}, violations)


def merged_keys(base: Snapshot, src: Sources) -> dict[str, DataFrame]:
    """Rows by foreign key after the batch: as many rows as there are keys."""
    out = {}
    for name, (table, key, _, _) in KEY_ROWS.items():
        out[name] = ops.merge_counts(base.table(name), ops.key_rows(src[table], key))
    return out


def _key_checks(src: Sources, after: Snapshot) -> DataFrame:
    """Foreign keys of the rows of all batches without a master now.  The rows
    of this batch among them are reported by ``check_summary`` too."""
    parts = []
    for name, (table, key, master, master_key) in KEY_ROWS.items():
        masters = src[master].select(F.col(master_key).alias(key))
        orphans = after.table(name).join(masters, key, "left_anti")
        parts.append(orphans.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_violations")).select(
            F.lit("foreign_key_all_batches").alias("check"), F.lit(table).alias("table_name"), F.lit(key).alias("column_name"), "n_violations"))
    return relational.union_all(*parts).filter(F.col("n_violations") > 0)


def _rows(df: DataFrame) -> list[dict]:
    return [r.asDict() for r in df.collect()]


def _staged(store: VersionedStore, base: Snapshot, staged: dict[str, dict[str, str]]) -> Snapshot:
    """The staged segments as they would be read."""
    return Snapshot(store, base.version, [Segment(n, part, part, path) for n, own in staged.items() for part, path in own.items()])


def _state_checks(src: Sources, state: DataFrame) -> DataFrame:
    """Status rows without an order key, which no state holds, and touched
    orders of several customers over all batches."""
    nulls = quality.check_not_null(src["order_details"], "order_details", ["orderid"]).select(
        F.lit("not_null").alias("check"), "table_name", "column_name", F.col("n_null").cast("bigint").alias("n_violations"))
    several = ops.states_of_several_customers(state).agg(F.count(F.lit(1)).alias("n_violations")).select(
        F.lit("one_customer_per_order").alias("check"), F.lit("order_state").alias("table_name"),
        F.lit("customerid").alias("column_name"), "n_violations")
    return nulls.unionByName(several).filter(F.col("n_violations") > 0)
