"""Physical-plan properties that matter at scale."""

import contextlib
import os
import tempfile

import pytest

import __spark_entry__ as E
from order_mart.plans.registry import REGISTRY
from order_mart import schemas
from order_mart.plans import facts, incremental
from order_mart.sources.binding import bind_sources
from order_mart.sources.tables import read_table

from conftest import SF0001

PY_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
            "FlatMapCoGroupsInPandas", "PythonUDF")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@contextlib.contextmanager
def conf(spark, **kv):
    old = {k: spark.conf.get(k) for k in kv}
    for k, v in kv.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_no_python_in_any_query(spark, name):
    p = plan(E.queries()[name](spark, SF0001))
    assert not any(n in p for n in PY_NODES), name


@pytest.mark.parametrize("name", ["fact_daily_orders", "fact_daily_orders_sql", "fact_daily_orders_pipeline",
                                  "f_order_details", "f_order_details_pipeline", "dim_order",
                                  "dim_customer", "dim_address", "dim_product", "refresh_fact",
                                  "order_item_totals", "check_foreign_key", "check_primary_key"])
def test_no_single_partition_exchange(spark, name):
    assert "SinglePartition" not in plan(E.queries()[name](spark, SF0001))


def test_product_join_is_broadcast_and_scans_are_pruned(spark):
    p = plan(facts.fact_daily_orders(bind_sources(spark, SF0001)))
    assert "BroadcastHashJoin [productid" in p
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double>" in p
    assert "ReadSchema: struct<p_partkey:bigint,p_retailprice:double>" in p


@pytest.mark.parametrize("fn", [facts.fact_daily_orders, facts.fact_daily_orders_sql])
def test_facts_aggregate_before_joining(spark, fn):
    """No aggregate sits above the joins: both sides reach order grain first,
    so the status rows never multiply the item rows."""
    with conf(spark, **{"spark.sql.adaptive.enabled": "false"}):
        p = fn(bind_sources(spark, SF0001))._jdf.queryExecution().executedPlan().toString()
    first_join = min(p.find(j) for j in ("SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin") if j in p)
    assert "HashAggregate" not in p[:first_join]


def test_canonical_fact_shares_order_partitioning(spark):
    """Without broadcasts: lifecycle and item totals are each shuffled once on
    orderid and joined without a further exchange; the customer join adds one
    exchange per side (the dimension lookups inside the test-data binding add
    their own, counted separately)."""
    with conf(spark, **{"spark.sql.adaptive.enabled": "false",
                        "spark.sql.autoBroadcastJoinThreshold": "-1"}):
        p = plan(facts.fact_daily_orders(bind_sources(spark, SF0001)))
    assert p.count("Exchange hashpartitioning(orderid") == 2
    assert p.count("Exchange hashpartitioning(customerid") == 2


def test_increment_filter_reaches_parquet(spark):
    base = tempfile.mkdtemp(prefix="pd-")
    path = os.path.join(base, "order_details")
    bind_sources(spark, SF0001)["order_details"].write.parquet(path)
    od = read_table(spark, path, schemas.ORDER_DETAILS)
    with conf(spark, **{"spark.sql.maxMetadataStringLength": "1000"}):
        p = plan(incremental.incremental_status(od, "2000-01-01 00:00:00").select("orderid"))
    assert "PushedFilters: [IsNotNull(order_status_update_timestamp), " \
           "GreaterThanOrEqual(order_status_update_timestamp,2000-01-01T00:00)]" in p
    assert "ReadSchema: struct<orderid:bigint,order_status_update_timestamp:timestamp_ntz>" in p


def test_dense_key_has_no_global_window_over_rows(spark):
    p = plan(E.queries()["dense_surrogate_key"](spark, SF0001))
    # the only single-partition step is the prefix sum over per-partition counts
    assert p.count("SinglePartition") <= 1
    assert "rangepartitioning" not in p  # rows were numbered in the checkpointed copy


def test_touched_partitions_are_pruned(spark):
    """Partition-scoped increments read only the touched partitions: the
    partition list becomes a static partition filter on the scan."""
    import uuid
    from pyspark.sql import functions as F
    from order_mart.plans.partitioned import refreshed_partitions, touched_partitions
    name = f"prev_{uuid.uuid4().hex[:8]}"
    spark.range(0, 1000).select(F.col("id").alias("orderid"), (F.col("id") % 50).cast("int").alias("d"),
                                F.lit("x").alias("v")).write.partitionBy("d").format("parquet").saveAsTable(name)
    prev = spark.table(name)
    rebuilt = spark.createDataFrame([(3, "y", 3)], "orderid long, v string, d int")
    affected = spark.createDataFrame([(3,)], "orderid long")
    out = refreshed_partitions(prev, rebuilt, affected, "d", touched_partitions(rebuilt, prev, affected, "d"))
    with conf(spark, **{"spark.sql.maxMetadataStringLength": "1000"}):
        p = plan(out)
    import re
    assert re.search(r"PartitionFilters: \[isnotnull\(d#\d+\), \(?d#\d+ (= 3|IN \(3\)|INSET 3)", p), p
    assert out.count() == 1000 // 50


def test_line_and_event_counts_are_dealt_by_their_number(spark, make_sources, monkeypatch):
    """The counts of both batches stay in as many tasks as their rows need: the
    shuffle that deals them is not coalesced, however small its bytes are."""
    from conftest import cust, lifecycle_rows, prod
    from order_mart.operators import order_state
    from order_mart.plans.registry import OPERATORS
    rows = [r for o in range(1, 41) for r in lifecycle_rows(o, 1, "1999-12-31 23:59:00" if o % 2 else "2023-05-01 00:00:00")]
    items = [(o, p, o) for o in range(1, 41) for p in (1, 2, 2)]
    src = make_sources([cust(1)], [prod(1), prod(2)], rows, items)
    monkeypatch.setattr(order_state, "TASK_ROWS", 10)
    out = OPERATORS["refresh_lines_by_state"](src)
    p = plan(out)
    assert p.count("REPARTITION_BY_NUM") >= 4
    assert "quantity" in p and ", 12), REPARTITION_BY_NUM" in p          # 120 rows or lines, 10 for each task
    found = sorted(tuple(r) for r in out.select("orderid", "productid", "quantity", "order_delivery_timestamp").collect())
    delivered = {r[0]: r[2] for r in rows if r[3] == "Delivered"}
    assert found == sorted((o, pr, q, delivered[o]) for o, pr, q in items)


def test_profile_counts_each_column_on_its_own(spark):
    """No aggregate holds the values of all columns (an Expand would), and
    nulls, copies and an empty table are counted as before."""
    from order_mart.operators.profile import profile_table
    schema = "k bigint, name string, x double"
    df = spark.createDataFrame([(1, "a", 0.0), (1, None, -0.0), (2, "a", float("nan")), (None, None, float("nan")), (2, "b", None)], schema)
    out = profile_table(df)
    assert "Expand" not in plan(out)
    assert [tuple(r) for r in out.collect()] == [("k", 2, 1), ("name", 2, 2), ("x", 2, 1)]
    assert [tuple(r) for r in profile_table(df.limit(0)).collect()] == [("k", 0, 0), ("name", 0, 0), ("x", 0, 0)]
    assert profile_table(df).schema.simpleString() == "struct<column_name:string,n_distinct:bigint,n_null:bigint>"
