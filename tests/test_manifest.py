"""Versioned store, safe swaps, state increments, key map and state stream."""

import os
import tempfile
import uuid

import pytest
from pyspark.sql import functions as F

from order_mart import schemas
from order_mart.operators import key_map, order_state as ops
from order_mart.plans import facts
from order_mart.plans.partitioned import run_pipeline_partitioned
from order_mart.plans.pipeline import QualityError, build_targets, run_incremental, run_pipeline
from order_mart.plans.state import apply_batch, open_state
from order_mart.sinks.manifest import StoreError, VersionedStore, open_store
from order_mart.sources.binding import bind_sources

from conftest import SF0001, T, cust, lifecycle_rows, prod

TS = "order_status_update_timestamp"


def _name(prefix):
    return f"{prefix}_{uuid.uuid4().hex[:8]}"


def _same(a, b):
    a = a.select(*b.columns)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def _same_targets(spark, db, src, tables=schemas.TARGETS):
    for name, want in build_targets(src, "2024-01-01").items():
        if name in tables:
            _same(spark.table(f"{db}.{name}"), want)


# --- swap ---------------------------------------------------------------------
@pytest.fixture(scope="module")
def src(spark):
    return bind_sources(spark, SF0001)


def test_swap_onto_partitioned_tables_is_refused(spark, src):
    db = _name("sp")
    run_pipeline_partitioned(spark, src, db, as_of="2024-01-01", grain="month")
    half = dict(src, order_details=src["order_details"].filter("orderid % 2 = 0"))
    with pytest.raises(StoreError):
        run_pipeline(spark, half, db, as_of="2024-01-01", publish_by="swap", stage_dir=tempfile.mkdtemp(prefix="swap-"))
    assert spark.table(f"{db}.fact_daily_orders").count() == 493
    loc = tempfile.mkdtemp(prefix="swap-")
    spark.sql(f"CREATE TABLE {db}.p (v INT, d INT) USING parquet PARTITIONED BY (d) LOCATION '{loc}'")
    from order_mart.sinks.writers import check_repoint
    with pytest.raises(StoreError, match="partitioned"):
        check_repoint(spark, f"{db}.p", spark.table(f"{db}.p").schema)


def test_swap_of_another_variant_is_refused(spark, src):
    db = _name("sv")
    run_pipeline(spark, src, db, as_of="2024-01-01")
    with pytest.raises(StoreError):
        run_pipeline(spark, src, db, as_of="2024-01-01", variant="pipeline", publish_by="swap", stage_dir=tempfile.mkdtemp(prefix="swap-"))
    run_pipeline(spark, src, _name("sx"), as_of="2024-01-01", publish_by="swap", stage_dir=tempfile.mkdtemp(prefix="swap-"))
    assert spark.table(f"{db}.fact_daily_orders").filter("customerid IS NULL").count() == 0
    swapped = _name("sw")
    run_pipeline(spark, src, swapped, as_of="2024-01-01", publish_by="swap", stage_dir=tempfile.mkdtemp(prefix="swap-"))
    with pytest.raises(StoreError, match="columns"):
        run_pipeline(spark, src, swapped, as_of="2024-01-01", variant="pipeline", publish_by="swap", stage_dir=tempfile.mkdtemp(prefix="swap-"))
    _same_targets(spark, swapped, src)


# --- manifest -------------------------------------------------------------------
def test_manifest_publish_moves_all_tables_at_once(spark, src):
    db = _name("mf")
    half = dict(src, order_details=src["order_details"].filter("orderid % 2 = 0"))
    run_pipeline(spark, half, db, as_of="2024-01-01", publish_by="manifest")
    store = open_store(spark, db, schemas.TARGETS)
    old = store.snapshot()
    _same_targets(spark, db, half)
    run_pipeline(spark, src, db, as_of="2024-02-01", publish_by="manifest")
    _same(spark.table(f"{db}.fact_daily_orders"), facts.fact_daily_orders(src))
    _same(old.table("fact_daily_orders"), facts.fact_daily_orders(half))          # a reader's version stays
    _same(store.snapshot(1).table("dim_product"), build_targets(half, "2024-01-01")["dim_product"])
    with pytest.raises(StoreError):
        store.snapshot(9)
    declared = dict(spark.sql(f"SHOW TBLPROPERTIES {db}.dim_customer__segments").collect())
    assert declared["order_mart.not_null"] == "customerid,name,address_id"


def test_failed_run_leaves_the_old_version(spark, make_sources):
    db = _name("mq")
    good = make_sources(customers=[cust(1)], products=[prod(1)], details=lifecycle_rows(1, 1), items=[(1, 1, 2)])
    run_pipeline(spark, good, db, as_of="2024-01-01", publish_by="manifest")
    bad = dict(good, order_items=spark.createDataFrame([(1, 9, 2)], schemas.ORDER_ITEMS))
    with pytest.raises(QualityError):
        run_pipeline(spark, bad, db, as_of="2024-01-01", publish_by="manifest")
    _same_targets(spark, db, good)
    with pytest.raises(StoreError, match="columns"):
        run_pipeline(spark, good, db, as_of="2024-01-01", variant="pipeline", publish_by="manifest")
    _same_targets(spark, db, good)
    with pytest.raises(ValueError):
        run_pipeline(spark, good, db, mode="append", publish_by="manifest")
    copied = _name("mc")
    run_pipeline(spark, good, copied, as_of="2024-01-01")
    with pytest.raises(StoreError, match="is a table"):
        run_pipeline(spark, good, copied, as_of="2024-01-01", publish_by="manifest")


def test_incremental_by_manifest(spark, src):
    from order_mart.functions import ntz_literal
    db, cutoff = _name("mi"), "1997-06-01 00:00:00"
    old = dict(src, order_details=src["order_details"].filter(F.col(TS) < ntz_literal(cutoff)))
    run_pipeline(spark, old, db, as_of="2024-01-01", publish_by="manifest")
    run_incremental(spark, src, db, cutoff, as_of="2024-01-01", publish_by="manifest")
    _same_targets(spark, db, src)


def test_commit_rules(spark):
    schema = spark.createDataFrame([], "k long, v string").schema
    store = VersionedStore(spark, tempfile.mkdtemp(prefix="store-"), {"a": schema, "b": schema})
    rows = lambda *r: spark.createDataFrame(list(r), "k long, v string")
    empty = store.snapshot()
    assert empty.version == 0 and empty.table("a").count() == 0
    one = store.commit(empty, "one", {"a": store.stage("a", rows((1, "x"), (2, "y")).withColumn("p", F.col("k") % 2), "p"),
                                      "b": store.stage("b", rows((9, "z")))})
    assert sorted(one.parts("a")) == ["0", "1"] and one.version == 1
    two = store.commit(one, "two", {"a": store.stage("a", rows((4, "w")).withColumn("p", F.col("k") % 2), "p")}, {"a": ["0", "1"]})
    assert sorted(r.k for r in two.table("a").collect()) == [4] and two.table("b").count() == 1      # an emptied part goes
    assert one.table("a").count() == 2
    assert two.table("a", ["1"]).count() == 0 and len(two.table("a", ["0"]).inputFiles()) == 1
    assert store.commit(two, "one", {"b": {}}).version == 2                                          # a known batch
    with pytest.raises(StoreError, match="since"):
        store.commit(one, "three", {"b": {}})
    with pytest.raises(StoreError, match="columns"):
        store.stage("a", spark.createDataFrame([(1, 2)], "k long, v long"))
    assert store.snapshot().version == 2
    assert len(store.unreferenced(keep=1)) == 2 and store.unreferenced(keep=2) == []


# --- state increments -----------------------------------------------------------
def _batches(src):
    """The rows of the sources dealt into three batches; late rows in the last."""
    od, items = src["order_details"], src["order_items"]
    turn = F.pmod(F.xxhash64("orderid", "order_status"), F.lit(3))
    line = F.pmod(F.xxhash64("orderid", "productid"), F.lit(3))
    return [dict(src, order_details=od.filter(turn == n), order_items=items.filter(line == n)) for n in range(3)]


def test_batches_equal_a_full_build(spark, src):
    db = _name("st")
    parts = _batches(src)
    for n in (2, 0, 1):
        apply_batch(spark, parts[n], db, f"b{n}", "2024-01-01", width=1500)
    apply_batch(spark, parts[0], db, "b0", "2024-01-01", width=1500)                # replayed: no change
    _same_targets(spark, db, src)
    assert open_state(spark, db).snapshot().version == 3
    repeated = dict(src, order_details=parts[1]["order_details"], order_items=src["order_items"].limit(0))
    apply_batch(spark, repeated, db, "again", "2024-01-01", width=1500)             # rows repeated in another batch
    twice = dict(src, order_details=src["order_details"].unionByName(parts[1]["order_details"]))
    _same_targets(spark, db, twice)


def test_a_batch_reads_only_the_ranges_it_touches(spark, src):
    db = _name("sr")
    apply_batch(spark, src, db, "all", "2024-01-01", width=100)
    before = open_state(spark, db).snapshot()
    highest, buyer = src["order_details"].agg(F.max(F.struct("orderid", "customerid"))).first()[0]
    late = spark.createDataFrame([(highest, buyer, T("2024-01-01 00:00:00"), "Received"), (highest + 1, 1, T("2024-01-02 00:00:00"), "Received")],
                                 schemas.ORDER_DETAILS)
    batch = dict(src, order_details=late, order_items=src["order_items"].limit(0))
    apply_batch(spark, batch, db, "late", "2024-01-01", width=100)
    after = open_state(spark, db).snapshot()
    for name in ("order_state", "order_events", "order_lines", "dim_order", "fact_daily_orders", "f_order_details"):
        was, now = before.parts(name), after.parts(name)
        changed = {p for p in now if p not in was or was[p].path != now[p].path}
        assert changed <= {f"100x{k // 100}" for k in (highest, highest + 1)} and len(was) > 5, name
    touched = before.table("order_state", [f"100x{highest // 100}"])
    assert 0 < len(touched.inputFiles()) < len(before.table("order_state").inputFiles()) / 3
    one = after.table("fact_daily_orders", [f"100x{highest // 100}"]).filter(F.col("orderid") == highest)
    assert len(one.inputFiles()) <= 1                                                # a point lookup opens one segment
    _same_targets(spark, db, dict(src, order_details=src["order_details"].unionByName(late)))
    with pytest.raises(StoreError, match="wide"):
        apply_batch(spark, batch, db, "wider", "2024-01-01", width=1000)


def test_views_read_only_the_segments_of_their_version(spark, src):
    db = _name("vw")
    for n, part in enumerate(_batches(src)):
        apply_batch(spark, part, db, f"b{n}", "2024-01-01", width=1500)
    plan = spark.table(f"{db}.fact_daily_orders")._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan
    joined = spark.sql(f"SELECT count(*) FROM {db}.fact_daily_orders JOIN {db}.f_order_details USING (orderid)").first()[0]
    assert joined == facts.f_order_details(src).join(facts.fact_daily_orders(src), "orderid").count()


def test_state_gate(spark, make_sources):
    db = _name("sg")
    masters = {"customers": [cust(1), cust(2)], "products": [prod(1)]}
    apply_batch(spark, make_sources(**masters, details=lifecycle_rows(1, 1), items=[(1, 1, 2)]), db, "one", "2024-01-01")
    other = make_sources(**masters, details=lifecycle_rows(1, 2, "2023-06-01 00:00:00")[:1] + [(None, 1, T("2023-06-01 00:00:00"), "Received")])
    with pytest.raises(QualityError) as err:
        apply_batch(spark, other, db, "two", "2024-01-01")
    found = {(v["check"], v["table_name"], v["column_name"]): v["n_violations"] for v in err.value.violations}
    assert found == {("not_null", "order_details", "orderid"): 1, ("one_customer_per_order", "order_state", "customerid"): 1}
    assert open_state(spark, db).snapshot().version == 1
    nothing = make_sources(**masters)
    apply_batch(spark, nothing, db, "none", "2024-01-01")
    assert spark.table(f"{db}.fact_daily_orders").count() == 1


def test_states_merge_in_any_grouping(spark, src):
    od, items, pm = src["order_details"], src["order_items"], src["product_master"]
    whole = ops.order_state(od, items, pm)
    turn = lambda n: F.pmod(F.xxhash64("orderid", TS), F.lit(3)) == n
    singles = [ops.merge_states(ops.status_states(od.filter(turn(n)))) for n in range(3)]
    pairwise = ops.merge_states(singles[2], ops.merge_states(singles[0], ops.item_states(items, pm)), singles[1])
    _same(pairwise, whole)
    _same(ops.fact_of_states(pairwise, src["customer_master"]), facts.fact_daily_orders(src))


def test_cli_batch(spark, src, capsys):
    from order_mart.__main__ import main
    from order_mart.sinks.writers import write_stage
    base, db = tempfile.mkdtemp(prefix="cli-batch-"), _name("cb")
    write_stage(src, base)
    args = ["batch", "--sources", base, "--database", db, "--as-of", "2024-01-01", "--batch-id", "b1"]
    assert main(args, spark=spark) == 0 and main(args, spark=spark) == 0
    assert spark.table(f"{db}.fact_daily_orders").count() == 493


# --- lost values ----------------------------------------------------------------
def _csv(spark, src, spoil):
    from order_mart.sinks.writers import write_csv
    base = tempfile.mkdtemp(prefix="lost-")
    for name, df in src.items():
        write_csv(spoil(df) if name == "order_items" else df, os.path.join(base, name))
    return base


def test_csv_faults_stop_check_and_run(spark, src, capsys):
    from order_mart.__main__ import main
    own = {k: v for k, v in src.items() if not k.startswith("_")}
    clean = _csv(spark, own, lambda df: df)
    assert main(["check", "--sources", clean, "--format", "csv"], spark=spark) == 0
    spoilt = _csv(spark, own, lambda df: df.withColumn("quantity", F.when(F.col("orderid") % 10 == 7, "x9").otherwise(F.col("quantity").cast("string"))))
    n = src["order_items"].filter("orderid % 10 = 7").count()
    capsys.readouterr()
    assert main(["check", "--sources", spoilt, "--format", "csv"], spark=spark) == 1
    assert f'"column_name": "quantity", "n_violations": {n}' in capsys.readouterr().out
    for variant in ("canonical", "pipeline", "sql"):
        assert main(["run", "--sources", spoilt, "--format", "csv", "--database", _name("lv"), "--variant", variant], spark=spark) == 2


@pytest.mark.parametrize("variant", ["pipeline", "sql"])
def test_target_checks_of_variants(spark, make_sources, variant):
    from conftest import cust
    source = make_sources(customers=[cust(1, name=None)], products=[prod(1)], details=lifecycle_rows(1, 1) + lifecycle_rows(2, 1)[:1],
                          items=[(1, 1, 2), (2, 1, 1)])
    with pytest.raises(QualityError) as err:
        run_pipeline(spark, source, _name("tv"), as_of="2024-01-01", variant=variant)
    assert {(v["table_name"], v["column_name"]) for v in err.value.violations} == {
        ("dim_cust", "customer_name") if variant == "pipeline" else ("dim_customer", "name")}


# --- partitions without a date ---------------------------------------------------
def test_increment_keeps_rows_without_a_date(spark, make_sources):
    from order_mart.plans.partitioned import run_incremental_partitioned
    db = _name("nd")
    masters = {"customers": [cust(1)], "products": [prod(1)]}
    undated = [(7, 1, None, "Received"), (8, 1, None, "Received")]
    first = make_sources(**masters, details=lifecycle_rows(1, 1) + undated, items=[(1, 1, 2)])
    run_pipeline_partitioned(spark, first, db, as_of="2024-01-01", enforce=False)
    then = make_sources(**masters, details=lifecycle_rows(1, 1) + undated + [(7, 1, T("2023-09-01 00:00:00"), "Received")], items=[(1, 1, 2)])
    run_incremental_partitioned(spark, then, db, "2023-09-01 00:00:00", as_of="2024-01-01", enforce=False)
    want = build_targets(then, "2024-01-01")["dim_order"]
    _same(spark.table(f"{db}.dim_order").select(*want.columns), want)


# --- key map ----------------------------------------------------------------------
def test_key_map_keeps_keys_over_runs(spark):
    natural = spark.createDataFrame([], "a string, b int").schema
    store = key_map.open_key_map(spark, tempfile.mkdtemp(prefix="keys-"), natural, "sk")
    rows = lambda *r: spark.createDataFrame(list(r), "a string, b int, more int")
    first = key_map.extend_key_map(store, rows(("m", 1, 0), ("c", 2, 0), ("m", 1, 5), (None, 3, 0)), start=100)
    assert {(r.a, r.b): r.sk for r in first.collect()} == {(None, 3): 100, ("c", 2): 101, ("m", 1): 102}
    second = rows(("a", 1, 0), ("c", 2, 0), (None, 3, 0), (None, None, 0), ("z", 9, 1))
    then = key_map.extend_key_map(store, second, start=100)
    assert {(r.a, r.b): r.sk for r in then.collect()} == {(None, 3): 100, ("c", 2): 101, ("m", 1): 102, (None, None): 103, ("a", 1): 104, ("z", 9): 105}
    assert key_map.extend_key_map(store, second, start=100).count() == 6 and store.snapshot().version == 2
    placed = key_map.with_surrogate(second, then, ["a", "b"])
    assert placed.count() == 5 and placed.filter("sk IS NULL").count() == 0
    assert key_map.extend_key_map(store, rows().limit(0)).count() == 6


# --- state stream -----------------------------------------------------------------
class _Killed(RuntimeError):
    pass


@pytest.mark.parametrize("dies", ["after", "before"])
def test_stream_killed_around_the_commit(spark, src, monkeypatch, dies):
    from order_mart.streaming import state_stream as ss
    base, db, ckpt = tempfile.mkdtemp(prefix="ss-"), _name("ss"), tempfile.mkdtemp(prefix="ss-ckpt-")
    status, items = os.path.join(base, "status"), os.path.join(base, "items")
    parts = _batches(src)

    def arrive(part):
        part["order_details"].coalesce(1).write.mode("append").parquet(status)
        part["order_items"].coalesce(1).write.mode("append").parquet(items)

    def run(after=None):
        q = ss.start_state_stream(spark, status, items, lambda: src, db, ckpt, width=1500, after_publish=after)
        q.awaitTermination()

    arrive(parts[2])
    run()
    seen = {k: parts[2][k] for k in ("order_details", "order_items")}
    _same(spark.table(f"{db}.fact_daily_orders"), facts.fact_daily_orders(dict(src, **seen)))
    arrive(parts[0])
    version = ss.open_fact(spark, db).snapshot().version

    def kill(epoch):
        raise _Killed(str(epoch))

    if dies == "after":                                           # published, not checkpointed
        with pytest.raises(Exception, match="_Killed"):
            run(kill)
        assert ss.open_fact(spark, db).snapshot().version == version + 1
    else:                                                         # staged, not published
        with monkeypatch.context() as m:
            m.setattr(VersionedStore, "commit", lambda *a, **k: kill(0))
            with pytest.raises(Exception, match="_Killed"):
                run()
        assert ss.open_fact(spark, db).snapshot().version == version
    run()
    assert ss.open_fact(spark, db).snapshot().version == version + 1    # the epoch counts once
    arrive(parts[1])
    run()
    _same(spark.table(f"{db}.fact_daily_orders"), facts.fact_daily_orders(src))


def test_foreign_keys_of_all_batches_are_checked_from_counts(spark, make_sources):
    """A master that goes away orphans rows of an earlier batch; the check
    reads the counts, not those rows."""
    db = _name("fk")
    masters = {"customers": [cust(1), cust(2)], "products": [prod(1), prod(2)]}
    first = make_sources(**masters, details=lifecycle_rows(1, 1) + lifecycle_rows(2, 2), items=[(1, 1, 2), (1, 2, 1), (2, 2, 1)])
    apply_batch(spark, first, db, "one", "2024-01-01")
    gone = make_sources(customers=[cust(1)], products=[prod(1)], details=lifecycle_rows(3, 1), items=[(3, 1, 1)])
    with pytest.raises(QualityError) as err:
        apply_batch(spark, gone, db, "two", "2024-01-01")
    found = {(v["check"], v["column_name"]): v["n_violations"] for v in err.value.violations}
    assert found == {("foreign_key_all_batches", "customerid"): 3, ("foreign_key_all_batches", "productid"): 2}
    whole = make_sources(customers=[cust(1)], products=[prod(1)], details=lifecycle_rows(1, 1) + lifecycle_rows(2, 2) + lifecycle_rows(3, 1),
                         items=[(1, 1, 2), (1, 2, 1), (2, 2, 1), (3, 1, 1)])
    from order_mart.plans.pipeline import check_summary
    full = {(v.check, v.column_name): v.n_violations for v in check_summary(whole, {}).collect()}
    assert full == {("foreign_key", "customerid"): 3, ("foreign_key", "productid"): 2}
    state = open_state(spark, db).snapshot()
    assert {tuple(r) for r in state.table("customer_rows").collect()} == {(1, 3), (2, 3)} and state.version == 1


def test_a_first_batch_is_not_merged_and_parts_stay_sorted(spark, tmp_path):
    """States of ranges that hold nothing yet are the batch's own, with no
    further aggregate; a touched range is merged.  Part files are sorted by the
    order key although no rows are sorted by the name of their part."""
    from order_mart.operators import order_state as ops
    from order_mart.plans import state
    from order_mart.sinks import manifest
    store = manifest.VersionedStore(spark, str(tmp_path / "store"), {"order_lines": ops.ORDER_LINES})
    items = spark.createDataFrame([(o, 1, 1) for o in range(40, 0, -1)] + [(7, 1, 1), (None, 1, 1)], "orderid bigint, productid bigint, quantity int")
    details = spark.createDataFrame([(95, 1), (None, 1)], "orderid bigint, customerid bigint")
    src = {"order_items": items, "order_details": details}
    ranges = state.touched_ranges(state.batch_ranges(src, 10), store.snapshot(), "order_lines")
    assert sorted(ranges) == ["10x0", "10x1", "10x2", "10x3", "10x4", "10x9"]
    own = {"order_lines": ops.line_counts(items).withColumn("_range", state.order_range(10))}
    assert state.merged(store.snapshot(), own, ranges, 10)["order_lines"] is own["order_lines"]
    before = spark.conf.get(manifest.OPEN_PARTS)
    with manifest.open_parts(spark):
        staged = store.stage("order_lines", own["order_lines"], "_range", ("orderid",))
    assert spark.conf.get(manifest.OPEN_PARTS) == before
    base = store.commit(store.snapshot(), "one", {"order_lines": staged}, {"order_lines": ranges})
    for part, path in staged.items():
        found = [r.orderid for r in spark.read.parquet(path).coalesce(1).collect()]
        assert found == sorted(found) and {f"10x{o // 10}" for o in found} == {part}
    again = state.merged(base, own, ranges, 10)["order_lines"]
    assert again is not own["order_lines"]
    assert {r.orderid: r.n for r in again.collect()} == {o: 4 if o == 7 else 2 for o in range(1, 41)}
