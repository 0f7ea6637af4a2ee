"""run_pipeline end to end, the quality gate, and the stream-fed refresh."""

import os
import tempfile
import uuid

import pytest
from pyspark.sql import functions as F

from order_mart import schemas
from order_mart.plans import facts
from order_mart.plans.pipeline import QualityError, run_pipeline
from order_mart.sources.binding import bind_sources
from order_mart.sources.tables import read_sources
from order_mart.sinks.writers import write_stage
from order_mart.streaming.refresh_stream import start_stream_refresh

from conftest import SF0001, cust, lifecycle_rows, prod


def test_run_pipeline_publishes_six_tables(spark):
    db = f"mart_{uuid.uuid4().hex[:8]}"
    res = run_pipeline(spark, bind_sources(spark, SF0001), db, as_of="2024-01-01")
    assert len(res.published) == 6 and not res.violations
    assert spark.table(f"{db}.fact_daily_orders").count() == 493
    assert spark.table(f"{db}.f_order_details").count() == 1995
    for t, schema in schemas.TARGETS.items():
        assert spark.table(f"{db}.{t}").columns == [f.name for f in schema.fields]


def test_run_pipeline_variant_pipeline(spark):
    db = f"mart_{uuid.uuid4().hex[:8]}"
    res = run_pipeline(spark, bind_sources(spark, SF0001), db, as_of="2024-01-01", variant="pipeline")
    assert {p.split(".")[1] for p in res.published} == {
        "dim_orders", "dim_product", "dim_address", "dim_cust", "fact_daily_orders", "f_order_details"}
    addr = spark.table(f"{db}.dim_address").agg(F.min("addr_id"), F.max("addr_id"), F.count("*")).first()
    assert tuple(addr) == (100, 249, 150)


def test_quality_gate_blocks_publish(spark, make_sources):
    src = make_sources(customers=[cust(1), cust(1, name="dup")], products=[prod(1)],
                       details=lifecycle_rows(1, 1) + lifecycle_rows(2, 77), items=[(1, 5, 1)])
    db = f"mart_{uuid.uuid4().hex[:8]}"
    with pytest.raises(QualityError) as err:
        run_pipeline(spark, src, db, as_of="2024-01-01")
    checks = {(v["check"], v["table_name"]) for v in err.value.violations}
    assert ("primary_key", "customer_master") in checks
    assert ("foreign_key", "order_details") in checks
    assert ("foreign_key", "order_items") in checks
    assert not spark.catalog.databaseExists(db)


@pytest.mark.parametrize("grain", [None, "month"])
def test_stream_refresh_equals_rebuild(spark, grain):
    """Status files arrive in two batches; after each, the fact equals a
    full rebuild over everything seen so far."""
    src = bind_sources(spark, SF0001)
    base = tempfile.mkdtemp(prefix="stream-")
    write_stage({k: v for k, v in src.items() if k != "order_details"}, base)
    history = os.path.join(base, "order_details")
    od = src["order_details"]
    cut = F.lit("1998-01-01 00:00:00").cast("timestamp_ntz")
    od.filter(F.col("order_status_update_timestamp") < cut).write.parquet(history)
    loader = lambda: read_sources(spark, base)
    fact = f"fact_{uuid.uuid4().hex[:8]}"
    ckpt = tempfile.mkdtemp(prefix="stream-ckpt-")
    q = start_stream_refresh(spark, history, loader, fact, ckpt, grain=grain)
    q.awaitTermination()
    first = facts.fact_daily_orders(loader())
    got = spark.table(fact).drop("received_date")
    assert got.exceptAll(first).count() == 0 and first.exceptAll(got).count() == 0
    od.filter(F.col("order_status_update_timestamp") >= cut).write.mode("append").parquet(history)
    q = start_stream_refresh(spark, history, loader, fact, ckpt, grain=grain)
    q.awaitTermination()
    full = facts.fact_daily_orders(src)
    got = spark.table(fact).drop("received_date")
    assert got.count() == 493
    assert got.exceptAll(full).count() == 0 and full.exceptAll(got).count() == 0


def test_run_pipeline_swap_publish(spark):
    db = f"mart_{uuid.uuid4().hex[:8]}"
    run1 = tempfile.mkdtemp(prefix="run1-")
    src = bind_sources(spark, SF0001)
    run_pipeline(spark, src, db, as_of="2024-01-01", stage_dir=run1, publish_by="swap")
    assert spark.table(f"{db}.fact_daily_orders").count() == 493
    run2 = tempfile.mkdtemp(prefix="run2-")
    run_pipeline(spark, src, db, as_of="2024-02-01", stage_dir=run2, publish_by="swap")
    got = {r.start_date.isoformat() for r in spark.table(f"{db}.dim_product").select("start_date").distinct().collect()}
    assert got == {"2024-02-01"}
    # the earlier version is untouched on disk
    assert spark.read.parquet(os.path.join(run1, "dim_product")).select("start_date").distinct().count() == 1


def test_run_incremental_matches_full_run(spark):
    from order_mart.plans.pipeline import run_incremental
    src = bind_sources(spark, SF0001)
    od = src["order_details"]
    cutoff = "1997-06-01 00:00:00"
    db = f"mart_{uuid.uuid4().hex[:8]}"
    from order_mart.functions import ntz_literal
    old = dict(src, order_details=od.filter(F.col("order_status_update_timestamp") < ntz_literal(cutoff)))
    run_pipeline(spark, old, db, as_of="2024-01-01")
    assert spark.table(f"{db}.fact_daily_orders").count() < 493
    run_incremental(spark, src, db, cutoff, as_of="2024-01-01")
    full = f"mart_{uuid.uuid4().hex[:8]}"
    run_pipeline(spark, src, full, as_of="2024-01-01")
    for t in schemas.TARGETS:
        a, b = spark.table(f"{db}.{t}"), spark.table(f"{full}.{t}")
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, t


def test_cli_run_and_check(spark, capsys):
    from order_mart.__main__ import main
    base = tempfile.mkdtemp(prefix="cli-")
    write_stage(bind_sources(spark, SF0001), base)
    db = f"cli_{uuid.uuid4().hex[:8]}"
    assert main(["check", "--sources", base], spark=spark) == 0
    assert main(["run", "--sources", base, "--database", db, "--as-of", "2024-01-01"], spark=spark) == 0
    assert spark.table(f"{db}.fact_daily_orders").count() == 493
    assert main(["incremental", "--sources", base, "--database", db, "--cutoff", "1998-01-01 00:00:00",
                 "--as-of", "2024-01-01"], spark=spark) == 0
    assert spark.table(f"{db}.fact_daily_orders").count() == 493


def test_partitioned_increment_rewrites_only_touched_partitions(spark):
    from order_mart.functions import ntz_literal
    from order_mart.plans.partitioned import run_incremental_partitioned, run_pipeline_partitioned
    src = bind_sources(spark, SF0001)
    od = src["order_details"]
    cutoff = "1998-06-01 00:00:00"
    db = f"part_{uuid.uuid4().hex[:8]}"
    old = dict(src, order_details=od.filter(F.col("order_status_update_timestamp") < ntz_literal(cutoff)))
    run_pipeline_partitioned(spark, old, db, as_of="2024-01-01", grain="month")
    loc = spark.sql(f"DESCRIBE TABLE EXTENDED {db}.fact_daily_orders").filter("col_name = 'Location'").first()[1]
    before = {d: sorted(os.listdir(os.path.join(loc.replace("file:", ""), d)))
              for d in os.listdir(loc.replace("file:", "")) if d.startswith("received_date=")}
    run_incremental_partitioned(spark, src, db, cutoff, as_of="2024-01-01", grain="month")
    after = {d: sorted(os.listdir(os.path.join(loc.replace("file:", ""), d)))
             for d in os.listdir(loc.replace("file:", "")) if d.startswith("received_date=")}
    untouched = [d for d in before if d in after and before[d] == after[d]]
    assert len(untouched) > len(before) // 2        # most partitions kept their files
    assert len(untouched) < len(before) or len(after) > len(before)
    full = f"full_{uuid.uuid4().hex[:8]}"
    run_pipeline(spark, src, full, as_of="2024-01-01")
    for t in schemas.TARGETS:
        a = spark.table(f"{db}.{t}").select(*spark.table(f"{full}.{t}").columns)
        b = spark.table(f"{full}.{t}")
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, t


def test_cli_partitioned(spark):
    from order_mart.__main__ import main
    base = tempfile.mkdtemp(prefix="cli-part-")
    write_stage(bind_sources(spark, SF0001), base)
    db = f"clip_{uuid.uuid4().hex[:8]}"
    args = ["--sources", base, "--database", db, "--as-of", "2024-01-01", "--partitioned", "--grain", "month"]
    assert main(["run", *args], spark=spark) == 0
    assert "received_date" in spark.table(f"{db}.fact_daily_orders").columns
    assert main(["incremental", *args, "--cutoff", "1998-06-01 00:00:00"], spark=spark) == 0
    assert spark.table(f"{db}.fact_daily_orders").count() == 493


def _partitioned_equals_full(spark, first, then, cutoff):
    """Publish ``first``, apply ``then`` from the cutoff, compare with a full
    build; returns the files of the fact's partitions before and after."""
    from order_mart.plans.partitioned import run_incremental_partitioned, run_pipeline_partitioned

    def files(db):
        loc = spark.sql(f"DESCRIBE TABLE EXTENDED {db}.fact_daily_orders").filter("col_name = 'Location'").first()[1].replace("file:", "")
        return {d: sorted(os.listdir(os.path.join(loc, d))) for d in os.listdir(loc) if d.startswith("received_date=")}

    db, full = f"pi_{uuid.uuid4().hex[:8]}", f"pf_{uuid.uuid4().hex[:8]}"
    run_pipeline_partitioned(spark, first, db, as_of="2024-01-01")
    before = files(db)
    run_incremental_partitioned(spark, then, db, cutoff, as_of="2024-01-01")
    run_pipeline(spark, then, full, as_of="2024-01-01")
    for t in schemas.TARGETS:
        b = spark.table(f"{full}.{t}")
        a = spark.table(f"{db}.{t}").select(*b.columns)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, t
    return before, files(db)


def test_partitioned_increments_that_rebuild_little(spark, make_sources):
    from conftest import cust, lifecycle_rows, prod
    masters = {"customers": [cust(1), cust(2)], "products": [prod(1), prod(2, rate=7)]}
    old = lifecycle_rows(1, 1, "2023-05-01 00:00:00") + lifecycle_rows(2, 2, "2023-05-02 00:00:00")
    items = [(1, 1, 2), (2, 1, 3), (1, 2, 1)]
    first = make_sources(**masters, details=old, items=items)
    received = make_sources(**masters, details=old + lifecycle_rows(3, 1, "2023-06-01 00:00:00")[:1], items=items + [(3, 1, 7)])
    before, after = _partitioned_equals_full(spark, first, received, "2023-06-01 00:00:00")
    assert before == after                                          # nothing delivered: no fact partition touched
    before, after = _partitioned_equals_full(spark, first, first, "2024-01-01 00:00:00")
    assert before == after                                          # empty increment
    gone = make_sources(**masters, details=old + lifecycle_rows(1, 1, "2023-06-02 00:00:00")[-1:], items=items[1:2])
    before, after = _partitioned_equals_full(spark, first, gone, "2023-06-01 00:00:00")
    assert before["received_date=2023-05-02"] == after["received_date=2023-05-02"]
    nothing = make_sources(**masters, details=lifecycle_rows(1, 1)[:1], items=items[:1])
    _partitioned_equals_full(spark, nothing, received, "2023-05-01 00:00:00")


def test_moved_delivery_empties_its_partition(spark, make_sources):
    """A later Delivered row alone keeps both item rows; a corrected history
    moves them, and the emptied partition goes."""
    from conftest import cust, lifecycle_rows, prod
    masters = {"customers": [cust(1)], "products": [prod(1)]}
    first = make_sources(**masters, details=lifecycle_rows(1, 1, "2023-05-01 00:00:00"), items=[(1, 1, 2)])
    moved = make_sources(**masters, details=lifecycle_rows(1, 1, "2023-06-01 00:00:00"), items=[(1, 1, 2)])
    before, after = _partitioned_equals_full(spark, first, moved, "2023-06-01 00:00:00")
    assert list(before) == ["received_date=2023-05-01"] and list(after) == ["received_date=2023-06-01"]


def test_swap_needs_a_folder_and_repoints(spark, make_sources):
    from conftest import cust, lifecycle_rows, prod
    src = make_sources(customers=[cust(1)], products=[prod(1)], details=lifecycle_rows(1, 1), items=[(1, 1, 2)])
    db = f"sw_{uuid.uuid4().hex[:8]}"
    with pytest.raises(ValueError):
        run_pipeline(spark, src, db, publish_by="swap")
    folders = [tempfile.mkdtemp(prefix="swap-") for _ in range(2)]
    for folder, items in zip(folders, ([(1, 1, 2)], [(1, 1, 5)]), strict=True):
        run_pipeline(spark, dict(src, order_items=spark.createDataFrame(items, schemas.ORDER_ITEMS)), db,
                     as_of="2024-01-01", publish_by="swap", stage_dir=folder)
    assert spark.table(f"{db}.fact_daily_orders").first().item_count == 5
    assert spark.read.parquet(os.path.join(folders[0], "fact_daily_orders")).first().item_count == 2


def test_sql_variant_appends(spark, make_sources):
    from conftest import cust, lifecycle_rows, prod
    src = make_sources(customers=[cust(1)], products=[prod(1)], details=lifecycle_rows(1, 1), items=[(1, 1, 2)])
    db = f"sq_{uuid.uuid4().hex[:8]}"
    for _ in range(2):
        run_pipeline(spark, src, db, as_of="2024-01-01", variant="sql", mode="append")
    assert [r.item_count for r in spark.table(f"{db}.fact_daily_orders").collect()] == [6, 6]


def test_files_added_later_are_read(spark):
    base = tempfile.mkdtemp(prefix="grow-")
    for t in ("customer", "nation", "region", "part", "orders", "lineitem"):
        spark.read.parquet(f"{SF0001}/{t}.parquet").write.parquet(f"{base}/{t}.parquet")
    n = bind_sources(spark, base)["order_items"].count()
    spark.read.parquet(f"{SF0001}/lineitem.parquet").limit(100).write.mode("append").parquet(f"{base}/lineitem.parquet")
    assert bind_sources(spark, base)["order_items"].count() == n + 100


@pytest.mark.parametrize("partitioned", [False, True])
def test_increment_gates_rows_without_affected_order(spark, make_sources, partitioned):
    """Null keys and new item lines of an untouched order reach the gate."""
    from order_mart.plans import partitioned as by_date
    from order_mart.plans.pipeline import run_incremental
    from conftest import T
    full, step = ((by_date.run_pipeline_partitioned, by_date.run_incremental_partitioned) if partitioned
                  else (run_pipeline, run_incremental))
    masters = {"customers": [cust(1)], "products": [prod(1)]}
    old, new = lifecycle_rows(1, 1, "2023-05-01 00:00:00"), lifecycle_rows(2, 1, "2023-06-01 00:00:00")
    items = [(1, 1, 2), (2, 1, 3)]
    db = f"ig_{uuid.uuid4().hex[:8]}"
    full(spark, make_sources(**masters, details=old, items=items[:1]), db, as_of="2024-01-01")
    strays = [(None, 77, T("2023-06-01 12:00:00"), "Bogus"), (None, 1, T("2023-06-01 12:00:00"), "S" * 300)]
    bad = make_sources(**masters)
    for name, rows in (("order_details", old + new + strays), ("order_items", items + [(None, None, 1), (None, 1, 1), (1, 99, 1)])):
        kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in bad[name].schema)    # nullable, as files are read
        bad[name] = spark.createDataFrame(rows, kinds)
    with pytest.raises(QualityError) as err:
        step(spark, bad, db, "2023-06-01 00:00:00", as_of="2024-01-01")
    assert {(v["check"], v["table_name"], v["column_name"]): v["n_violations"] for v in err.value.violations} == {
        ("not_null", "order_items", "orderid"): 2, ("foreign_key", "order_items", "productid"): 1,
        ("foreign_key", "order_details", "customerid"): 1, ("status_domain", "order_details", "order_status"): 2,
        ("varchar_length", "order_details", "order_status"): 1}
    assert spark.table(f"{db}.fact_daily_orders").count() == 1      # nothing published
    step(spark, make_sources(**masters, details=old + new, items=items), db, "2023-06-01 00:00:00", as_of="2024-01-01")
    assert spark.table(f"{db}.fact_daily_orders").count() == 2
