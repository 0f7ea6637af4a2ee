"""Key checks from stored counts against full checks."""

import pytest

from order_mart.operators import key_counts, quality

BATCHES = [[1, 2, 2, None], [2, 3, 9, 9], [], [1, None, 50]]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def frame(spark, keys):
    return spark.createDataFrame([(k, "x") for k in keys], "k int, v string")


def test_verdicts_follow_batches(spark, tmp_path):
    parent, paths, seen, pk, fk = frame(spark, [1, 2, 3]), [], [], None, None
    for i, batch in enumerate(BATCHES):
        new = frame(spark, batch)
        paths.append(str(tmp_path / f"s{i}"))
        for _ in range(2):                                  # a replay counts once
            key_counts.write_segment(new, paths[-1], "k", 3)
        seen += batch
        counts = key_counts.counts_of(spark, paths, "k", new)
        now = key_counts.primary_key_violations(counts, "t", "k")
        pk = now if pk is None else key_counts.standing(pk, now, new, "k")
        orphans = key_counts.foreign_key_violations(counts, "t", "k", parent, "k")
        fk = orphans if fk is None else key_counts.standing(fk, orphans, new, "k")
        assert rows(pk) == rows(quality.check_primary_key(frame(spark, seen), "t", ["k"]))
        assert rows(fk) == rows(quality.check_foreign_key(frame(spark, seen), "t", "k", parent, "k"))


def test_gate_reads_the_batchs_ranges(spark, tmp_path):
    path = str(tmp_path / "s")
    key_counts.write_segment(spark.range(50_000).withColumnRenamed("id", "k"), path, "k", 20)
    counts = key_counts.counts_of(spark, [path], "k", spark.createDataFrame([(49_998,), (49_999,)], "k long"))
    assert len(counts.inputFiles()) == 1 and rows(counts) == [(49_998, 1), (49_999, 1)]


def test_no_segment(spark):
    with pytest.raises(ValueError):
        key_counts.counts_of(spark, [], "k", frame(spark, [1]))
