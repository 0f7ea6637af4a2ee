"""Inline-row cases the shared test data does not contain."""

import datetime as dt
import tempfile

from pyspark.sql import functions as F

from order_mart import schemas
from order_mart.functions import ntz_literal
from order_mart.operators import lifecycle, quality
from order_mart.plans import dims, facts, incremental

from conftest import T, cust, lifecycle_rows, prod


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect()) if cols else sorted(map(tuple, df.collect()))


def test_customer_without_orders(make_sources):
    src = make_sources(customers=[cust(1), cust(3)], products=[prod(1)],
                       details=lifecycle_rows(10, 1), items=[(10, 1, 1)])
    dc = dims.dim_customer_pipeline(src)
    got = {r.customer_id: (r.start_date, r.end_date) for r in dc.collect()}
    assert got[3] == (None, None)
    assert got[1][0] is not None and got[1][1] is not None
    for f in (facts.fact_daily_orders, facts.fact_daily_orders_sql):
        assert f(src).filter("customerid = 3").count() == 0


def test_itemless_delivered_order(make_sources):
    src = make_sources(customers=[cust(1)], products=[prod(1)],
                       details=lifecycle_rows(10, 1, statuses=("Received", "Delivered")), items=[])
    assert rows(facts.fact_daily_orders(src), "orderid", "item_count", "order_amount") == [(10, 0, 0)]
    assert rows(facts.fact_daily_orders_pipeline(src), "order_id", "item_count", "order_amount") == [(10, 0, 0)]
    assert facts.fact_daily_orders_sql(src).count() == 0


def test_undelivered_order(make_sources):
    src = make_sources(customers=[cust(1)], products=[prod(1)],
                       details=lifecycle_rows(10, 1, statuses=("Received",)), items=[(10, 1, 1)])
    assert facts.fact_daily_orders(src).count() == 0
    assert facts.fact_daily_orders_pipeline(src).count() == 0
    r = facts.fact_daily_orders_sql(src).collect()
    assert len(r) == 1 and r[0].order_delivery_timestamp is None and r[0].order_delivery_time_seconds is None


def test_duplicate_item_line(make_sources):
    src = make_sources(customers=[cust(1)], products=[prod(1, rate=10)],
                       details=lifecycle_rows(1, 1), items=[(1, 1, 2), (1, 1, 2)])
    assert rows(facts.fact_daily_orders(src), "item_count", "order_amount") == [(4, 40)]
    assert rows(facts.fact_daily_orders_pipeline(src), "item_count", "order_amount") == [(2, 20)]
    assert rows(facts.fact_daily_orders_sql(src), "item_count", "order_amount") == [(12, 120)]
    assert facts.f_order_details(src).count() == 2
    assert facts.f_order_details_pipeline(src).count() == 1


def test_null_pincode(make_sources):
    src = make_sources(customers=[cust(1, pincode=None)], products=[prod(1)],
                       details=lifecycle_rows(1, 1), items=[(1, 1, 1)])
    assert facts.fact_daily_orders_pipeline(src).count() == 0
    canon = facts.fact_daily_orders(src)
    assert canon.count() == 1 and facts.fact_daily_orders_sql(src).count() == 1
    nn = quality.check_not_null(canon, "fact_daily_orders", ["pincode"]).first()
    assert nn.n_null == 1


def test_null_name(make_sources):
    src = make_sources(customers=[cust(1, name=None)], products=[prod(1)],
                       details=lifecycle_rows(1, 1), items=[(1, 1, 1)])
    r = dims.dim_customer_pipeline(src).collect()
    assert len(r) == 1 and r[0].start_date is None and r[0].end_date is None and r[0].addr_id == 100


def test_status_spelling_and_domain(make_sources):
    base = lifecycle_rows(1, 1)
    alias = [(o, c, t, "In_progress" if s == "InProgress" else s) for o, c, t, s in base]
    a = make_sources(customers=[cust(1)], products=[prod(1)], details=base, items=[(1, 1, 1)])
    b = make_sources(customers=[cust(1)], products=[prod(1)], details=alias, items=[(1, 1, 1)])
    for f in (facts.fact_daily_orders, facts.fact_daily_orders_pipeline, facts.fact_daily_orders_sql):
        assert rows(f(a)) == rows(f(b))
    dom = {r.order_status: (r.in_domain, r.normalized_status)
           for r in quality.check_status_domain(b["order_details"]).collect()}
    assert dom["In_progress"] == (False, "inprogress")
    assert dom["Received"] == (True, "received")


def test_null_status_kept_by_inequality(make_sources):
    from order_mart.functions import is_not_status_keep_null
    details = lifecycle_rows(1, 1) + [(1, 1, T("2023-05-02 00:00:00"), None)]
    src = make_sources(customers=[cust(1)], products=[prod(1)], details=details, items=[(1, 1, 1)])
    kept = src["order_details"].filter(is_not_status_keep_null("In_progress"))
    assert kept.filter(F.col("order_status").isNull()).count() == 1
    clean = make_sources(customers=[cust(1)], products=[prod(1)], details=lifecycle_rows(1, 1),
                         items=[(1, 1, 1)])
    assert rows(facts.fact_daily_orders(src)) == rows(facts.fact_daily_orders(clean))
    assert rows(facts.fact_daily_orders_pipeline(src)) == rows(facts.fact_daily_orders_pipeline(clean))


def test_equal_timestamps_zero_seconds(make_sources):
    src = make_sources(customers=[cust(1)], products=[prod(1)],
                       details=lifecycle_rows(1, 1, steps=(0, 0)), items=[(1, 1, 1)])
    assert rows(facts.fact_daily_orders(src), "order_delivery_time_seconds") == [(0,)]
    assert rows(facts.fact_daily_orders_pipeline(src), "order_delivery_time_sec") == [(0.0,)]


def test_fractional_seconds(make_sources):
    t0 = T("2023-05-01 00:00:00")
    details = [(1, 1, t0, "Received"), (1, 1, t0 + dt.timedelta(seconds=1.5), "Delivered")]
    src = make_sources(customers=[cust(1)], products=[prod(1)], details=details, items=[(1, 1, 1)])
    assert rows(facts.fact_daily_orders_pipeline(src), "order_delivery_time_sec") == [(1.5,)]
    assert rows(facts.fact_daily_orders(src), "order_delivery_time_seconds") == [(2,)]
    assert rows(facts.fact_daily_orders_sql(src), "order_delivery_time_seconds") == [(2,)]


def test_null_item_keys_rejected(spark):
    from pyspark.sql import types as Ty
    loose = Ty.StructType([Ty.StructField("orderid", Ty.LongType(), True),
                           Ty.StructField("productid", Ty.LongType(), True),
                           Ty.StructField("quantity", Ty.IntegerType(), True)])
    items = spark.createDataFrame([(None, None, 1), (1, 1, 1)], loose)
    r = quality.check_not_null(items, "order_items", ["orderid", "productid"]).collect()
    assert {x.column_name: x.n_null for x in r} == {"orderid": 1, "productid": 1}


def test_orphan_keys_reported(make_sources):
    src = make_sources(customers=[cust(1)], products=[prod(1)],
                       details=lifecycle_rows(1, 1) + lifecycle_rows(2, 99),
                       items=[(1, 1, 1), (1, 42, 1), (1, 42, 2), (2, None, 1)])
    od = quality.check_foreign_key(src["order_details"], "order_details", "customerid",
                                   src["customer_master"], "customerid").collect()
    oi = quality.check_foreign_key(src["order_items"], "order_items", "productid",
                                   src["product_master"], "productid").collect()
    assert [(r.key_value, r.n_rows) for r in od] == [(99, 3)]
    assert [(r.key_value, r.n_rows) for r in oi] == [(42, 2)]


def test_primary_key_duplicates(make_sources):
    src = make_sources(customers=[cust(1), cust(1), cust(2)])
    r = quality.check_primary_key(src["customer_master"], "customer_master", ["customerid"]).collect()
    assert [(x.key_value, x.n_rows) for x in r] == [("1", 2)]


def test_varchar_length(make_sources):
    src = make_sources(customers=[cust(1, name="x" * 51), cust(2)])
    r = {x.column_name: x.n_too_long for x in quality.check_varchar_length(
        src["customer_master"], "customer_master", {"name": 50, "city": 30}).collect()}
    assert r == {"name": 1, "city": 0}


def test_late_delivery_refresh_equals_rebuild(make_sources):
    cutoff = T("2023-06-01 00:00:00")
    details = (lifecycle_rows(1, 1, t0="2023-05-31 23:59:00", steps=(30, 120))   # delivered after cutoff
               + lifecycle_rows(2, 1, t0="2023-05-01 00:00:00")                  # all before
               + lifecycle_rows(3, 2, t0="2023-06-02 00:00:00"))                 # all after
    src = make_sources(customers=[cust(1), cust(2)], products=[prod(1), prod(2, rate=7)],
                       details=details, items=[(1, 1, 2), (2, 2, 1), (3, 1, 5), (3, 2, 1)])
    od = src["order_details"]
    previous = facts.fact_daily_orders(dict(src, order_details=od.filter(F.col(lifecycle.TS) < ntz_literal(cutoff))))
    assert previous.filter("orderid = 1").count() == 0          # not yet delivered before the cutoff
    inc = incremental.incremental_status(od, cutoff)
    refreshed = incremental.refresh_fact(previous, src, inc)
    assert rows(refreshed) == rows(facts.fact_daily_orders(src))


def test_customer_whose_only_rows_are_in_progress_alias(make_sources):
    """The pandas filter drops rows spelled 'In_progress' before grouping, so a
    customer whose only joined row has that spelling disappears."""
    src = make_sources(customers=[cust(1), cust(2)],
                       details=[(5, 2, T("2023-05-01 00:00:00"), "In_progress")])
    got = sorted(r.customer_id for r in dims.dim_customer_pipeline(src).collect())
    assert got == [1]


def test_dim_product_validity(make_sources):
    src = make_sources(products=[prod(1), prod(2, active=False)])
    r = dims.dim_product(src, "2024-02-03").collect()
    assert {x.start_date for x in r} == {dt.date(2024, 2, 3)} and {x.end_date for x in r} == {None}
    p = dims.dim_product_pipeline(src, dt.date(2024, 2, 3)).collect()
    assert {x.end_date for x in p} == {dt.date(2030, 12, 31)}
    assert dims.dim_product(src).first().start_date == dt.date.today()


def test_refresh_targets_equals_full_build(spark):
    from order_mart.plans.pipeline import build_targets
    from order_mart.sources.binding import bind_sources
    from conftest import SF0001
    src = bind_sources(spark, SF0001)
    od = src["order_details"]
    cutoff = "1997-06-01 00:00:00"
    old = dict(src, order_details=od.filter(F.col(lifecycle.TS) < ntz_literal(cutoff)))
    previous = build_targets(old, "2024-01-01")
    scoped, affected = incremental.stage_increment(spark, src, cutoff, tempfile.mkdtemp(prefix="inc-"))
    refreshed = incremental.refresh_targets(previous, src, scoped, affected, "2024-01-01")
    full = build_targets(src, "2024-01-01")
    for name, df in full.items():
        got = refreshed[name]
        assert got.columns == df.columns, name
        assert got.exceptAll(df).count() == 0 and df.exceptAll(got).count() == 0, name
    # replaying the same increment changes nothing
    again = incremental.refresh_targets(refreshed, src, scoped, affected, "2024-01-01")
    assert again["fact_daily_orders"].exceptAll(full["fact_daily_orders"]).count() == 0


def test_sql_fact_display_order_and_approx_profile(spark):
    from order_mart.operators import profile
    from order_mart.sources.binding import bind_sources
    from conftest import SF0001
    src = bind_sources(spark, SF0001)
    ids = [r.orderid for r in facts.fact_daily_orders_sql(src, ordered=True).select("orderid").collect()]
    assert ids == sorted(ids) and len(ids) == 1473
    exact = {r.column_name: r.n_distinct for r in profile.profile_table(src["customer_master"]).collect()}
    approx = {r.column_name: r.n_distinct
              for r in profile.profile_table(src["customer_master"], approx=True, rsd=0.02).collect()}
    assert exact["customerid"] == 150 and exact["state"] == 5
    for col, n in exact.items():
        assert abs(approx[col] - n) <= max(2, 0.1 * n), col


def test_gate_reads_each_large_table_once(spark):
    from order_mart.plans.pipeline import item_summary, status_history_summary
    from order_mart.sources.binding import bind_sources
    from conftest import SF0001
    from test_plans import conf, plan
    src = bind_sources(spark, SF0001)
    with conf(spark, **{"spark.sql.adaptive.enabled": "false"}):
        history = plan(status_history_summary(src["order_details"]))
        items = plan(item_summary(src["order_items"]))
    for p in (history, items):
        assert p.count("FileScan") == 1 and p.count("Exchange") == 1 and p.count("Expand") == 1


def test_conform_counts_lost_values(spark):
    from order_mart.sinks.conform import check_conform, conform
    rows = [("1", "x", "2023-01-01 00:00:00", "Received"), ("2", "3", "no time", "Received"), (None, "5", None, "Delivered")]
    text = spark.createDataFrame(rows, "orderid string, customerid string, order_status_update_timestamp string, order_status string")
    got = conform(text, schemas.ORDER_DETAILS).orderBy(F.col("orderid").asc_nulls_last()).collect()
    assert [(r[0], r[1], r[2] is None) for r in got] == [(1, None, False), (2, 3, True), (None, 5, True)]
    lost = {r.column_name: r.n_lost for r in check_conform(text, "order_details", schemas.ORDER_DETAILS).collect()}
    assert lost == {"orderid": 0, "customerid": 1, "order_status_update_timestamp": 1}


def test_check_summary_one_pass_counts(spark):
    from pyspark.sql import types as Ty
    from order_mart.plans.pipeline import check_summary
    t = T("2023-05-01 00:00:00")
    loose_items = Ty.StructType([Ty.StructField("orderid", Ty.LongType(), True),
                                 Ty.StructField("productid", Ty.LongType(), True),
                                 Ty.StructField("quantity", Ty.IntegerType(), True)])
    src = {
        "customer_master": spark.createDataFrame([cust(1), cust(1), cust(2)], schemas.CUSTOMER_MASTER),
        "product_master": spark.createDataFrame([prod(1)], schemas.PRODUCT_MASTER),
        "order_details": spark.createDataFrame([
            (1, 1, t, "Received"), (1, 2, t, "Delivered"),        # order 1: two customers
            (2, 9, t, "Received"), (2, 9, t, "bogus"),            # orphan customer 9 (2 rows), bad status
            (3, 1, t, "x" * 25), (4, None, t, "Received"), (4, 2, t, "Delivered"),
        ], schemas.ORDER_DETAILS),
        "order_items": spark.createDataFrame([(1, 1, 1), (None, 1, 1), (2, 5, 1), (2, 5, 2)], loose_items),
    }
    got = {(r.check, r.table_name): r.n_violations for r in check_summary(src, {}).collect()}
    assert got == {
        ("primary_key", "customer_master"): 2,
        ("foreign_key", "order_details"): 2,
        ("status_domain", "order_details"): 2,
        ("one_customer_per_order", "order_details"): 2,
        ("varchar_length", "order_details"): 1,
        ("foreign_key", "order_items"): 2,
        ("not_null", "order_items"): 1,
    }
