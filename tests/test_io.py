"""Sources and sinks: CSV, staging, warehouse tables, DDL, JDBC (in-process Derby)."""

import os
import tempfile
import uuid

from pyspark.sql import functions as F

from order_mart import schemas
from order_mart.sinks import ddl
from order_mart.sinks.conform import as_text, conform
from order_mart.sinks.writers import publish_append, publish_overwrite, write_csv, write_jdbc, write_stage
from order_mart.sources.binding import bind_sources
from order_mart.sources.files import read_csv
from order_mart.sources.jdbc import read_jdbc
from order_mart.sources.tables import read_sources, read_stage

from conftest import SF0001


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_csv_round_trip_keeps_types(spark):
    src = bind_sources(spark, SF0001)
    path = tempfile.mkdtemp(prefix="csv-")
    for name in ("customer_master", "order_details", "product_master"):
        write_csv(src[name], os.path.join(path, name))
        back = read_csv(spark, os.path.join(path, name), schemas.SOURCES[name])
        assert back.schema.simpleString() == spark.createDataFrame([], schemas.SOURCES[name]).schema.simpleString()
        assert same(back, src[name].select(*[f.name for f in schemas.SOURCES[name].fields]))


def test_stage_round_trip(spark):
    src = bind_sources(spark, SF0001)
    base = tempfile.mkdtemp(prefix="stage-")
    write_stage(src, base)
    back = read_stage(spark, base, dict(schemas.SOURCES))
    for name in src:
        assert same(back[name], src[name])
    assert set(read_sources(spark, base)) == set(schemas.SOURCES)


def test_conform_text_back_to_schema(spark):
    src = bind_sources(spark, SF0001)
    od = src["order_details"]
    back = conform(as_text(od), schemas.ORDER_DETAILS)
    assert back.schema == spark.createDataFrame([], schemas.ORDER_DETAILS).schema
    assert same(back, od)
    bools = spark.createDataFrame([("True",), ("False",), ("junk",)], "isactive string")
    got = [r.isactive for r in conform(bools, schemas.PRODUCT_MASTER).collect()]
    assert got == [True, False, None]


def test_create_targets_and_publish(spark):
    db = f"db_{uuid.uuid4().hex[:8]}"
    names = ddl.create_targets(spark, db, location=tempfile.mkdtemp(prefix="wh-"))
    assert len(names) == 6
    cols = spark.table(f"{db}.fact_daily_orders").columns
    assert cols == [f.name for f in schemas.FACT_DAILY_ORDERS.fields]
    from order_mart.plans import facts
    fact = facts.fact_daily_orders(bind_sources(spark, SF0001))
    publish_overwrite(fact, f"{db}.fact_daily_orders")
    publish_append(fact, f"{db}.fact_daily_orders")
    assert spark.table(f"{db}.fact_daily_orders").count() == 2 * 493
    publish_overwrite(fact, f"{db}.fact_daily_orders")
    assert spark.table(f"{db}.fact_daily_orders").count() == 493
    ddl.create_table(spark, f"{db}.fact_daily_orders", schemas.FACT_DAILY_ORDERS, replace=True)
    assert spark.table(f"{db}.fact_daily_orders").count() == 0
    assert len(ddl.create_sources(spark, db)) == 4


def test_jdbc_partitioned_read_and_append(spark):
    """In-process Derby (embedded, in-memory; no network listener)."""
    url = f"jdbc:derby:memory:om{uuid.uuid4().hex[:8]};create=true"
    props = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    src = bind_sources(spark, SF0001)
    items = src["order_items"]
    write_jdbc(items, url, "order_items", mode="overwrite", properties=props, num_partitions=4)
    back = read_jdbc(spark, url, "order_items", partition_column="orderid", num_partitions=4,
                     properties=props)
    assert back.rdd.getNumPartitions() == 4
    assert same(back.select("orderid", "productid", "quantity"), items)
    write_jdbc(items.limit(10), url, "order_items", mode="append", properties=props)
    assert read_jdbc(spark, url, "order_items", properties=props).count() == 6010
    pushed = read_jdbc(spark, url, "order_items", properties=props).filter(F.col("orderid") < 10)
    plan = pushed._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(orderid,10)" in plan, plan


def test_pipeline_from_jdbc_sources(spark):
    """The four sources read from a relational database (in-process Derby),
    split into parallel range reads on their keys, then the full pipeline."""
    from order_mart.plans.pipeline import run_pipeline
    from order_mart.sources.jdbc import read_sources_jdbc
    url = f"jdbc:derby:memory:src{uuid.uuid4().hex[:8]};create=true"
    props = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    for name, df in bind_sources(spark, SF0001).items():
        write_jdbc(df, url, name, mode="overwrite", properties=props, num_partitions=2)
    src = read_sources_jdbc(spark, url, props, num_partitions=3)
    assert src["order_details"].rdd.getNumPartitions() == 3
    for name, df in bind_sources(spark, SF0001).items():
        assert src[name].schema.simpleString() == schemas.SOURCES[name].simpleString()
        assert same(src[name], df.select(*src[name].columns)), name
    db = f"jdbc_{uuid.uuid4().hex[:8]}"
    res = run_pipeline(spark, src, db, as_of="2024-01-01")
    assert not res.violations
    assert spark.table(f"{db}.fact_daily_orders").count() == 493
    assert spark.table(f"{db}.f_order_details").count() == 1995


def test_csv_sources_and_lost_values(spark):
    from order_mart.sources.files import check_csv, read_sources_csv
    base = tempfile.mkdtemp(prefix="csv-src-")
    src = bind_sources(spark, SF0001)
    for name, df in src.items():
        write_csv(df, os.path.join(base, name))
    back = read_sources_csv(spark, base)
    assert all(same(back[n], df.select(*back[n].columns)) for n, df in src.items())
    bad = os.path.join(base, "bad")
    spark.createDataFrame([("1", "2", "many"), ("1", "x", "3")], "orderid string, productid string, quantity string").write.option("header", True).csv(bad)
    lost = {r.column_name: r.n_lost for r in check_csv(spark, bad, "order_items", schemas.ORDER_ITEMS).collect()}
    assert lost == {"orderid": 0, "productid": 1, "quantity": 1}


def test_jdbc_ranges_follow_the_rows_not_the_keys(spark):
    """In-process Derby: nine tenths of the rows on few keys, a key with a
    third of all rows, and keys up to 10**9."""
    from order_mart.sources.jdbc import balanced_ranges, read_jdbc_balanced
    url = f"jdbc:derby:memory:bal{uuid.uuid4().hex[:8]};create=true"
    props = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    keys = [7] * 1000 + list(range(100, 1900)) + [10**9 - 3 * i for i in range(200)]
    rows = spark.createDataFrame([(k, i) for i, k in enumerate(keys)] + [(None, -1)], "k long, v long")
    write_jdbc(rows, url, "t", mode="overwrite", properties=props, num_partitions=2)
    ranges = balanced_ranges(spark, url, "t", "k", 6, props, bins=50)
    assert all(a <= b for a, b in ranges) and all(b < c for (_, b), (c, _) in zip(ranges, ranges[1:], strict=False))
    held = [sum(a <= k <= b for k in keys) for a, b in ranges]
    assert sum(held) == len(keys) and len(ranges) <= 12
    assert max(n for (a, _), n in zip(ranges, held, strict=True) if a > 7) <= 500       # a share, but for the hot key
    back = read_jdbc_balanced(spark, url, "t", "k", 6, props)
    assert back.rdd.getNumPartitions() == len(balanced_ranges(spark, url, "t", "k", 6, props)) + 1
    assert same(back, rows)
    write_jdbc(spark.createDataFrame([(3000, 5000)], "k long, v long"), url, "t", properties=props)     # arrives meanwhile
    bounded = read_jdbc_balanced(spark, url, "t", "k", 6, props, where='"v" < 3000')
    assert same(bounded, rows)
    write_jdbc(rows.limit(0), url, "nothing", mode="overwrite", properties=props)
    assert read_jdbc_balanced(spark, url, "nothing", "k", 4, props).count() == 0


def test_bucketed_sources_need_no_exchange_on_the_order_key(spark):
    from order_mart.plans.bucketed import stage_by_order
    from order_mart.plans.facts import fact_daily_orders, fact_daily_orders_sql
    src = bind_sources(spark, SF0001)
    staged = stage_by_order(spark, src)
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        def by_order(sources):
            plan = fact_daily_orders(sources)._jdf.queryExecution().executedPlan().toString()
            return sum("Exchange hashpartitioning(orderid" in line for line in plan.splitlines())
        assert by_order(src) == 2 and by_order(staged) == 1          # the lines come from the product join, not from a scan
        life = "Exchange hashpartitioning(orderid"
        plan = __import__("order_mart.operators.lifecycle", fromlist=["x"]).order_lifecycle(
            staged["order_details"], ("orderid",)).join(staged["order_items"], "orderid")._jdf.queryExecution().executedPlan().toString()
        assert life not in plan
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert same(fact_daily_orders(staged), fact_daily_orders(src))
    assert same(fact_daily_orders_sql(staged), fact_daily_orders_sql(src))


def test_sketches_merge_within_their_bound(spark):
    from order_mart.operators.sketches import ERROR_BOUND, estimates, merge_profiles, sketch_profile
    src = bind_sources(spark, "/root/testdata/sf0.01")
    items = src["order_items"]
    parts = [sketch_profile(items.filter(F.pmod("orderid", F.lit(3)) == n)) for n in range(3)]
    got = {r.column_name: r for r in estimates(merge_profiles(parts[2], merge_profiles(parts[0], parts[1]))).collect()}
    whole = {r.column_name: r for r in estimates(sketch_profile(items)).collect()}
    for c in items.columns:
        exact = items.select(c).distinct().count()
        assert abs(got[c].n_distinct - exact) <= ERROR_BOUND * exact and got[c].n_rows == items.count()
        assert abs(got[c].n_distinct - whole[c].n_distinct) <= ERROR_BOUND * exact
    empty = {r.column_name: tuple(r)[1:] for r in estimates(sketch_profile(items.limit(0))).collect()}
    assert set(empty.values()) == {(0, 0, 0)}
    none = spark.createDataFrame([(None, 1), (None, 1)], "a string, b int")
    assert {tuple(r) for r in estimates(sketch_profile(none)).collect()} == {("a", 2, 2, 0), ("b", 2, 0, 1)}
