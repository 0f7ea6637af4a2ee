"""Named queries over the shared test tables: name -> callable(spark, sf_dir).

Each callable binds the test tables to the four sources and returns one lazy
DataFrame; nothing is collected.  The queries with a dense key number a
checkpointed copy when called (see ``operators.keys``).  Parameters that would otherwise come from
the clock are fixed here so results are reproducible.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import schemas
from ..functions import (
    as_of_date, date_sequence, is_not_status_keep_null, is_status, is_status_exact, ntz_literal,
    seconds_between, whole_seconds_between)
from ..operators import joins, key_counts, key_map, keys, lifecycle, order_state, profile, quality, relational, sketches, totals
from ..config import scratch_path
from ..sinks.conform import as_text, conform
from ..sources.binding import bind_sources
from . import dims, facts, incremental

AS_OF = dt.date(2024, 1, 1)            # run date used by the validity columns
CUTOFF = dt.datetime(2000, 1, 1)       # high-water mark used by the increments
KEY_CUTOFF = dt.datetime(2023, 7, 1)   # customers updated before it get their keys first

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
OPERATORS: dict[str, Callable[[dict[str, DataFrame]], DataFrame]] = {}
#: Queries that also run as ``<name>_faulty`` over sources with planted faults.
FAULTY = ("check_not_null", "check_primary_key", "check_foreign_key", "check_varchar_length", "check_status_domain",
          "check_order_customer", "filter_not_in_progress", "customer_status_history", "item_status_history",
          "customer_first_events", "order_lifecycle", "orders_with_items", "order_item_totals",
          "fact_daily_orders", "fact_daily_orders_pipeline", "fact_daily_orders_sql", "f_order_details_pipeline",
          "f_order_details", "dim_address_pipeline", "dim_customer_pipeline", "refresh_fact", "order_state",
          "merge_order_state", "refresh_fact_by_state", "refresh_lines_by_state", "address_key_map", "sketch_profile",
          "check_primary_key_by_counts", "check_foreign_key_by_counts")


def query(name: str):
    def wrap(fn: Callable[[dict[str, DataFrame]], DataFrame]) -> Callable:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            src = bind_sources(spark, sf_dir)
            src["_spark"], src["_sf_dir"] = spark, sf_dir
            return fn(src)
        run.__name__ = name
        run.__doc__ = fn.__doc__
        REGISTRY[name], OPERATORS[name] = run, fn
        return fn
    return wrap


# --- sources ---------------------------------------------------------------
@query("scan_customer_master")
def _scan_cm(src): return src["customer_master"]


@query("scan_product_master")
def _scan_pm(src): return src["product_master"]


@query("scan_order_details")
def _scan_od(src): return src["order_details"]


@query("scan_order_items")
def _scan_oi(src): return src["order_items"]


# --- composite outputs -----------------------------------------------------
@query("fact_daily_orders")
def _fact(src): return facts.fact_daily_orders(src)


@query("fact_daily_orders_pipeline")
def _fact_pipe(src): return facts.fact_daily_orders_pipeline(src)


@query("fact_daily_orders_sql")
def _fact_sql(src): return facts.fact_daily_orders_sql(src, ordered=True)


@query("f_order_details")
def _fod(src): return facts.f_order_details(src)


@query("f_order_details_pipeline")
def _fod_pipe(src): return facts.f_order_details_pipeline(src)


@query("dim_order")
def _dim_order(src): return dims.dim_order(src)


@query("dim_product")
def _dim_product(src): return dims.dim_product(src, AS_OF)


@query("dim_product_pipeline")
def _dim_product_pipe(src): return dims.dim_product_pipeline(src, AS_OF)


@query("dim_address")
def _dim_address(src): return dims.dim_address(src)


@query("dim_address_pipeline")
def _dim_address_pipe(src): return dims.dim_address_pipeline(src)


@query("dim_customer")
def _dim_customer(src): return dims.dim_customer(src)


@query("dim_customer_pipeline")
def _dim_customer_pipe(src): return dims.dim_customer_pipeline(src)


# --- operator-level queries ------------------------------------------------
TS = lifecycle.TS


@query("scan_sources")
def _scan_sources(src):
    """Rows of each source and of its key column."""
    key = {"customer_master": "customerid", "product_master": "productid", "order_details": "orderid", "order_items": "orderid"}
    return relational.union_all(*[
        src[t].agg(F.count(F.lit(1)).alias("n_rows"), F.count(c).alias("n_keys"))
        .select(F.lit(t).alias("table_name"), "n_rows", "n_keys") for t, c in key.items()])


@query("scan_projected")
def _scan_projected(src):
    return src["order_details"].select("orderid", TS, "order_status")


@query("literal_table")
def _literal_table(src):
    """A literal lookup (status -> lifecycle step) joined to row counts."""
    spark = src["order_details"].sparkSession
    steps = spark.createDataFrame(
        [(s, i + 1) for i, s in enumerate(schemas.STATUS_DOMAIN)], "order_status string, step int")
    counts = src["order_details"].groupBy("order_status").agg(F.count(F.lit(1)).alias("n_rows"))
    return steps.join(counts, "order_status", "left").select(
        "order_status", "step", F.coalesce("n_rows", F.lit(0)).alias("n_rows"))


@query("conform_schema")
def _conform_schema(src):
    """Products staged as text (booleans as 'True'/'False') conformed back."""
    pm = src["product_master"].withColumn(
        "isactive", F.when(F.col("isactive"), F.lit("True")).when(~F.col("isactive"), F.lit("False")))
    return conform(as_text(pm), schemas.PRODUCT_MASTER)


@query("conform_timestamps")
def _conform_timestamps(src):
    """Status history staged as text conformed back (timestamps parsed)."""
    return conform(as_text(src["order_details"]), schemas.ORDER_DETAILS)


@query("rename_columns")
def _rename(src):
    return relational.rename_columns(src["order_details"], {
        "orderid": "order_id", "customerid": "customer_id",
        "order_status_update_timestamp": "order_status_update_timestamp"})


@query("drop_columns")
def _drop(src):
    return relational.drop_columns(src["product_master"], "sku", "productname", "productcode", "isactive")


@query("validity_columns")
def _validity(src):
    return src["customer_master"].select(
        "customerid",
        F.col("update_timestamp").cast("date").alias("start_date"),
        F.lit(None).cast("date").alias("end_date"),
        as_of_date(AS_OF).alias("loaded_on"))


@query("line_amount")
def _line_amount(src):
    return totals.line_amount(src["order_items"], src["product_master"])


@query("dense_surrogate_key")
def _dense_key(src):
    return keys.dense_surrogate_key(
        src["customer_master"].select("customerid", "address", "city", "state", "pincode"),
        ["customerid"], "address_id", start=schemas.ADDRESS_KEY_START)


@query("filter_delivered")
def _filter_delivered(src):
    return src["order_details"].filter(is_status_exact(schemas.STATUS_DELIVERED))


@query("filter_not_in_progress")
def _filter_nip(src):
    return src["order_details"].filter(is_not_status_keep_null(schemas.PIPELINE_IN_PROGRESS_LITERAL))


@query("incremental_status")
def _inc_status(src):
    return incremental.incremental_status(src["order_details"], CUTOFF)


@query("order_lifecycle")
def _order_lifecycle(src):
    return lifecycle.order_lifecycle(src["order_details"])


@query("customer_status_history")
def _cust_hist(src):
    return lifecycle.customer_status_history(src["customer_master"], src["order_details"])


@query("item_status_history")
def _item_hist(src):
    return joins.left_join_split(
        src["order_items"], src["order_details"].select("orderid", TS, "order_status"), "orderid")


@query("orders_with_items")
def _orders_with_items(src):
    """Order-grain lifecycle (customer carried) LEFT JOIN items LEFT JOIN
    product: the lifecycle leaves its aggregate partitioned on orderid, which
    is the join key, so it is shuffled once."""
    life = lifecycle.order_lifecycle(src["order_details"].filter(F.col("orderid").isNotNull()),
                                     keys=("orderid",), carry=("customerid",))
    return (joins.left_join_split(life, src["order_items"], "orderid")
            .join(src["product_master"].select("productid", "rate"), "productid", "left")
            .select("orderid", "customerid", "order_received_timestamp", "order_delivery_timestamp",
                    "productid", "quantity", "rate"))


@query("customer_first_events")
def _cust_first(src):
    return lifecycle.customer_first_events(src["customer_master"], src["order_details"])


@query("order_item_totals")
def _order_item_totals(src):
    return totals.order_item_totals(src["order_items"], src["product_master"])


@query("max_keys")
def _max_keys(src):
    return incremental.max_keys(src)


@query("profile_table")
def _profile(src):
    return profile.profile_table(src["customer_master"])


@query("unique_order_counts")
def _unique_counts(src):
    return (profile.unique_count(src["order_details"], "order_details", "orderid")
            .unionByName(profile.unique_count(src["order_items"], "order_items", "orderid")))


@query("distinct_rows")
def _distinct(src):
    return relational.distinct_rows(src["order_items"])


@query("sorted_orders")
def _sorted(src):
    return relational.sorted_by(src["order_details"], "orderid", TS, "order_status")


@query("preview_first_n")
def _preview(src):
    return relational.preview(src["order_details"], 10, "orderid", TS, "order_status")


@query("status_history_union")
def _union(src):
    from ..sources.binding import status_frames
    spark, sf_dir = src["_spark"], src["_sf_dir"]
    return relational.union_all(*status_frames(spark, sf_dir))


@query("delivery_seconds")
def _delivery_seconds(src):
    life = lifecycle.delivered_only(lifecycle.order_lifecycle(src["order_details"]))
    return life.select(
        "orderid",
        seconds_between("order_received_timestamp", "order_delivery_timestamp").alias("delivery_seconds"),
        whole_seconds_between("order_received_timestamp", "order_delivery_timestamp")
        .alias("delivery_seconds_int"))


@query("product_labels")
def _product_labels(src):
    return src["product_master"].select("productid", "productname", "productcode", "sku")


@query("date_spine")
def _date_spine(src):
    """Every day between the first and last Received date, with the number of
    orders received that day (0 on days without orders)."""
    received = (src["order_details"].filter(is_status(schemas.STATUS_RECEIVED))
                .select(F.to_date(TS).alias("day")))
    per_day = received.groupBy("day").agg(F.count(F.lit(1)).alias("n_orders"))
    spine = (per_day.agg(F.min("day").alias("lo"), F.max("day").alias("hi"))
             .select(F.explode(date_sequence("lo", "hi")).alias("day")))
    return (spine.join(per_day, "day", "left")
            .select("day", F.coalesce("n_orders", F.lit(0)).alias("n_orders")))


@query("check_not_null")
def _check_not_null(src):
    return (quality.check_not_null(src["customer_master"], "customer_master",
                                   ["customerid", "name", "address", "city", "state", "pincode"])
            .unionByName(quality.check_not_null(src["order_items"], "order_items", ["orderid"]))
            .unionByName(quality.check_not_null(src["order_details"], "order_details",
                                                ["orderid", TS, "order_status"])))


@query("check_primary_key")
def _check_pk(src):
    return (quality.check_primary_key(src["customer_master"], "customer_master", ["customerid"])
            .unionByName(quality.check_primary_key(src["product_master"], "product_master", ["productid"])))


@query("check_foreign_key")
def _check_fk(src):
    return (quality.check_foreign_key(src["order_details"], "order_details", "customerid",
                                      src["customer_master"], "customerid")
            .unionByName(quality.check_foreign_key(src["order_items"], "order_items", "productid",
                                                   src["product_master"], "productid")))


def _by_counts(first, second, key, verdicts):
    """Verdicts of a first batch, brought up to date by a second one."""
    spark = first.sparkSession
    paths = [scratch_path(spark, "key-segment") for _ in range(2)]
    earlier = verdicts(key_counts.write_segment(first, paths[0], key))
    changed = key_counts.write_segment(second, paths[1], key).select(key)
    return key_counts.standing(earlier, verdicts(key_counts.counts_of(spark, paths, key, changed)), changed, key)


@query("check_primary_key_by_counts")
def _check_pk_by_counts(src):
    """Both masters in two batches; the second is checked from stored counts."""
    parts = []
    for table, key in (("customer_master", "customerid"), ("product_master", "productid")):
        second = F.xxhash64(*src[table].columns) % 2 == 0
        parts.append(_by_counts(src[table].filter(~second), src[table].filter(second), key,
                                lambda counts, table=table, key=key: key_counts.primary_key_violations(counts, table, key)))
    return relational.union_all(*parts)


@query("check_foreign_key_by_counts")
def _check_fk_by_counts(src):
    """Both order-keyed sources in two batches, as above."""
    first, second = _two_batches(src)
    return relational.union_all(*[
        _by_counts(first[table], second[table], key, lambda counts, table=table, key=key, parent=parent:
                   key_counts.foreign_key_violations(counts, table, key, src[parent], key))
        for table, key, parent in (("order_details", "customerid", "customer_master"), ("order_items", "productid", "product_master"))])


@query("check_varchar_length")
def _check_len(src):
    parts = [quality.check_varchar_length(src[t], t, quality.source_varchar_limits(t))
             for t in ("customer_master", "product_master", "order_details")]
    return relational.union_all(*parts)


@query("check_status_domain")
def _check_domain(src):
    return quality.check_status_domain(src["order_details"])


@query("check_order_customer")
def _check_order_customer(src):
    return lifecycle.orders_with_several_customers(src["order_details"])


@query("incremental_items")
def _inc_items(src):
    inc = incremental.incremental_status(src["order_details"], CUTOFF)
    return incremental.incremental_items(src["order_items"], inc)


@query("continue_keys")
def _continue_keys(src):
    """Orders first received at/after the cutoff, renumbered above the
    largest order id seen before it."""
    od = src["order_details"]
    before = od.filter(F.col(TS) < ntz_literal(CUTOFF))
    batch = (incremental.incremental_status(od, CUTOFF)
             .filter(is_status_exact(schemas.STATUS_RECEIVED))
             .select("orderid", "customerid", TS))
    return keys.continue_keys(batch, before, "orderid", ["orderid"], "new_orderid")


@query("refresh_fact")
def _refresh_fact(src):
    """Fact built from the history before the cutoff, then refreshed with the
    increment; equals the full rebuild."""
    from .facts import fact_daily_orders
    od = src["order_details"]
    old = dict(src, order_details=od.filter(F.col(TS) < ntz_literal(CUTOFF)))
    previous = fact_daily_orders(old)
    inc = incremental.incremental_status(od, CUTOFF)
    return incremental.refresh_fact(previous, src, inc)


@query("incremental_items_clustered")
def _incremental_items_clustered(src):
    """The increment's item lines, read through the zone map of item lines
    that are clustered by order."""
    from ..sinks.clustered import read_keys, write_clustered
    spark, path = src["order_items"].sparkSession, scratch_path(src["order_items"].sparkSession, "clustered-items")
    write_clustered(src["order_items"], path, "orderid", int(spark.conf.get("spark.sql.shuffle.partitions")))
    inc = incremental.incremental_status(src["order_details"], CUTOFF)
    return read_keys(spark, path, "orderid", incremental.affected_orders(inc))


@query("refresh_fact_clustered")
def _refresh_fact_clustered(src):
    """Fact of the history before the cutoff, refreshed with the increment's
    orders as read through zone maps; equals the full rebuild."""
    from .clustered import cluster_sources, refresh_fact_clustered
    spark, od = src["order_details"].sparkSession, src["order_details"]
    previous = facts.fact_daily_orders(dict(src, order_details=od.filter(F.col(TS) < ntz_literal(CUTOFF))))
    inc = incremental.incremental_status(od, CUTOFF)
    return refresh_fact_clustered(spark, previous, src, cluster_sources(spark, src), inc)


# --- increments on state ---------------------------------------------------
def _two_batches(src):
    """All rows of the two large sources, dealt into two batches: status rows
    by the cutoff, item lines (which have no time) by a hash."""
    od, oi = src["order_details"], src["order_items"]
    late, second = F.col(TS) >= ntz_literal(CUTOFF), F.xxhash64("orderid", "productid") % 2 == 0
    return (dict(src, order_details=od.filter(~late), order_items=oi.filter(~second)),
            dict(src, order_details=od.filter(late), order_items=oi.filter(second)))


def _merged_state(src):
    return order_state.merge_states(*[
        order_state.order_state(b["order_details"], b["order_items"], b["product_master"]) for b in _two_batches(src)])


@query("order_state")
def _order_state(src):
    return order_state.order_state(src["order_details"], src["order_items"], src["product_master"])


@query("merge_order_state")
def _merge_order_state(src):
    """States of two batches merged; equals the state of all rows."""
    return _merged_state(src)


@query("refresh_fact_by_state")
def _refresh_fact_by_state(src):
    return order_state.fact_of_states(_merged_state(src), src["customer_master"])


@query("refresh_lines_by_state")
def _refresh_lines_by_state(src):
    """``f_order_details`` from the merged counts of two batches."""
    batches = _two_batches(src)
    n_events, n_lines = (order_state.count_partitions(src[t]) for t in ("order_details", "order_items"))
    events = order_state.merge_counts(*[order_state.event_counts(b["order_details"], n_events) for b in batches])
    lines = order_state.merge_counts(*[order_state.line_counts(b["order_items"], n_lines) for b in batches])
    return order_state.f_order_details_of(events, lines)


@query("apply_batches")
def _apply_batches(src):
    """The published fact after two batches and a replay of the second, in a
    database of its own under the checkpoint folder."""
    import uuid

    from ..config import scratch_path
    from ..sinks.ddl import create_database
    from .state import apply_batch, open_state
    spark, database = src["order_details"].sparkSession, f"batches_{uuid.uuid4().hex}"
    create_database(spark, database, scratch_path(spark, "batches"))
    for name, batch in zip(("one", "two", "two"), (*_two_batches(src), _two_batches(src)[1]), strict=True):
        apply_batch(spark, batch, database, name, AS_OF)
    return open_state(spark, database).snapshot().table("fact_daily_orders")


@query("address_key_map")
def _address_key_map(src):
    """Address keys of two runs: customers updated in the first half of the
    year, then all of them; the first run's keys stay."""
    from ..config import scratch_path
    spark, cm = src["customer_master"].sparkSession, src["customer_master"].select("customerid", "update_timestamp")
    store = key_map.open_key_map(spark, scratch_path(spark, "keys"), cm.select("customerid").schema, "address_id")
    for rows in (cm.filter(F.col("update_timestamp") < ntz_literal(KEY_CUTOFF)), cm):
        keyed = key_map.extend_key_map(store, rows, start=schemas.ADDRESS_KEY_START)
    return keyed


@query("fact_from_buckets")
def _fact_from_buckets(src):
    """The fact over sources staged in buckets of the order key."""
    from .bucketed import stage_by_order
    return facts.fact_daily_orders(stage_by_order(src["order_details"].sparkSession, src))


@query("sketch_profile")
def _sketch_profile(src):
    """Profiles of two parts of the status history merged, and whether each
    column's estimate is within the bound of its exact distinct count."""
    od = src["order_details"]
    late = F.col(TS) >= ntz_literal(CUTOFF)
    merged = sketches.merge_profiles(sketches.sketch_profile(od.filter(late)), sketches.sketch_profile(od.filter(~F.coalesce(late, F.lit(False)))))
    exact = profile.profile_table(od).select("column_name", F.col("n_distinct").alias("_exact"))
    off = F.abs(F.col("n_distinct") - F.col("_exact"))
    return sketches.estimates(merged).join(exact, "column_name").select(
        "column_name", "n_rows", "n_null", (off <= F.col("_exact") * sketches.ERROR_BOUND).alias("within_bound"))


# --- the same operators over sources with planted faults -------------------
def _over_faulty(name: str):
    def run(spark, sf_dir):
        from ..sources.binding import faulty_sources
        return OPERATORS[name](dict(faulty_sources(spark, sf_dir), _spark=spark, _sf_dir=sf_dir))
    return run


for _name in FAULTY:
    REGISTRY[f"{_name}_faulty"] = _over_faulty(_name)
