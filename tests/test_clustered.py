"""Range-clustered tables: files opened by keyed reads, and whole results."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF0001, T, lifecycle_rows, prod, cust
from order_mart.plans import clustered, facts, incremental
from order_mart.sinks.clustered import read_keys, touched_files, write_clustered, zones
from order_mart.sources.binding import bind_sources


def frame(spark, rows, schema="k long, v string"):
    return spark.createDataFrame(rows, schema)


def both(got, want):
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_point_lookup_reads_one_file(spark, tmp_path):
    rows = spark.range(100_000).select((F.col("id") * 3 - 150_000).alias("k"), F.col("id").cast("string").alias("v"))
    path = str(tmp_path / "t")
    written = write_clustered(rows, path, "k", 20)
    assert zones(spark, path).count() == 20 == len(written.inputFiles())
    for wanted in (-150_000, 0, 3, 149_997):
        got = read_keys(spark, path, "k", frame(spark, [(wanted,)], "k long"))
        assert len(got.inputFiles()) == 1 and [r.k for r in got.collect()] == [wanted]
    assert read_keys(spark, path, "k", frame(spark, [(1,), (10**18,), (None,)], "k long")).count() == 0


def test_scan_pushes_few_keys(spark, tmp_path):
    path = str(tmp_path / "t")
    write_clustered(spark.range(1000).withColumnRenamed("id", "k"), path, "k", 4)
    plan = read_keys(spark, path, "k", frame(spark, [(5,), (7,)], "k long"))._jdf.queryExecution().executedPlan().toString()
    assert "In(k, [5,7])" in plan


def test_hot_null_and_negative_keys(spark, tmp_path):
    rows = frame(spark, [(7, str(i)) for i in range(600)] + [(i * 10**15, "x") for i in range(-300, 300)] + [(None, "n")] * 50 + [(7, "1")] * 3)
    path = str(tmp_path / "t")
    both(write_clustered(rows, path, "k", 12), rows)
    assert zones(spark, path).filter("low <= 7 AND high >= 7").count() >= 3          # a hot key spans files
    keys = frame(spark, [(7,), (-10**15,), (-10**15,), (None,)], "k long")
    both(read_keys(spark, path, "k", keys), rows.filter("k IN (7, -1000000000000000)"))


def test_many_keys_join_and_wide_reads(spark, tmp_path, monkeypatch):
    rows = spark.range(20_000).select(F.col("id").alias("k"), (F.col("id") % 7).cast("string").alias("v"))
    path, keys = str(tmp_path / "t"), spark.range(4000, 9000).withColumnRenamed("id", "k")
    write_clustered(rows, path, "k", 20)
    got = read_keys(spark, path, "k", keys)
    assert len(got.inputFiles()) < 10
    both(got, rows.filter("k >= 4000 AND k < 9000"))
    monkeypatch.setattr("order_mart.sinks.clustered.MAX_FILES", 3)                      # more files than listed by name
    wide = read_keys(spark, path, "k", keys)
    assert len(wide.inputFiles()) == 20
    both(wide, got)


@pytest.mark.parametrize("rows", [[], [(None, "a"), (None, None)]])
def test_empty_tables_and_null_keys_only(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    both(write_clustered(frame(spark, rows), path, "k", 4), frame(spark, rows))
    keys = frame(spark, [(1,), (None,)], "k long")
    assert touched_files(spark, path, "k", keys).count() == 0
    got = read_keys(spark, path, "k", keys)
    assert got.columns == ["k", "v"] and got.count() == 0


def test_key_must_be_an_integer(spark, tmp_path):
    with pytest.raises(ValueError):
        write_clustered(frame(spark, [(1, "a")]), str(tmp_path / "t"), "v", 2)


def test_refresh_reads_the_increments_files(spark, make_sources, tmp_path):
    details = [r for oid in range(1, 401) for r in lifecycle_rows(oid, 1, statuses=("Received", "InProgress"), steps=(60,))]
    late = [(oid, 1, T("2023-06-01 00:00:00"), "Delivered") for oid in (399, 400)]
    src = make_sources([cust(1)], [prod(1)], details + late, [(oid, 1, oid % 5 + 1) for oid in range(1, 401)])
    location = clustered.cluster_sources(spark, src, str(tmp_path / "c"), 10)
    increment = incremental.incremental_status(src["order_details"], T("2023-05-31 00:00:00"))
    scoped = clustered.clustered_scope(spark, src, location, incremental.affected_orders(increment))
    assert all(len(scoped[name].inputFiles()) == 1 for name in clustered.KEYED)
    previous = facts.fact_daily_orders(make_sources([cust(1)], [prod(1)], details, [(oid, 1, oid % 5 + 1) for oid in range(1, 401)]))
    got = clustered.refresh_fact_clustered(spark, previous, src, location, increment)
    both(got, facts.fact_daily_orders(src))
    assert got.filter("order_delivery_timestamp IS NOT NULL").count() == 2


def test_given_tables(spark, tmp_path):
    src = bind_sources(spark, SF0001)
    path = os.path.join(str(tmp_path), "items")
    both(write_clustered(src["order_items"], path, "orderid", 6), src["order_items"])
