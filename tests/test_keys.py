"""Dense surrogate keys: contiguous, ordered, deterministic across partitions."""

from pyspark.sql import functions as F

from order_mart.operators.keys import continue_keys, dense_surrogate_key


def test_dense_key_contiguous_in_order(spark):
    df = spark.range(0, 5000, 1, 13).select((F.col("id") * 7919 % 5003).alias("k"),
                                            (F.col("id") % 3).alias("v"))
    out = dense_surrogate_key(df, ["k"], "sk", start=100, num_partitions=7)
    got = [(r.k, r.sk) for r in out.orderBy("k", "v").collect()]
    assert [sk for _, sk in got] == list(range(100, 100 + 5000))
    assert [k for k, _ in got] == sorted(k for k, _ in got)


def test_dense_key_ties_and_empty(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (0, "z")], "k int, s string")
    out = dense_surrogate_key(df, ["k"], "sk", start=1, num_partitions=4)
    assert [(r.k, r.s, r.sk) for r in out.orderBy("sk").collect()] == [(0, "z", 1), (1, "a", 2), (1, "b", 3)]
    empty = df.filter("k > 5")
    assert dense_surrogate_key(empty, ["k"], "sk").count() == 0


def test_continue_keys(spark):
    existing = spark.createDataFrame([(5,), (9,)], "id long")
    batch = spark.createDataFrame([("x",), ("a",)], "name string")
    out = continue_keys(batch, existing, "id", ["name"], "new_id")
    assert [(r.name, r.new_id) for r in out.orderBy("new_id").collect()] == [("a", 10), ("x", 11)]
    none = existing.filter("id < 0")
    out2 = continue_keys(batch, none, "id", ["name"], "new_id")
    assert sorted(r.new_id for r in out2.collect()) == [1, 2]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_sizing_scales_with_input():
    from order_mart.config import sizing
    small = sizing(10 * 1024 ** 2, 8)
    assert small["spark.sql.shuffle.partitions"] == "16"
    big = sizing(100 * 1024 ** 4, 4000)
    assert int(big["spark.sql.shuffle.partitions"]) == 100 * 1024 ** 4 // 4 // (256 * 1024 ** 2)


def test_dense_key_counts_copies(spark):
    """A third of the rows are exact copies: they are numbered as one row and
    expanded, and keys stay contiguous and in order."""
    copies = spark.range(0, 3000).select(F.lit(107).alias("k"), F.lit("same").alias("s"))
    others = spark.range(0, 6000).select((F.col("id") % 3000 + 100).alias("k"), (F.col("id") % 4000).cast("string").alias("s"))
    df = copies.unionByName(others).unionByName(others.limit(5))
    out = dense_surrogate_key(df, ["k"], "sk", start=1, num_partitions=8)
    got = sorted((r.sk, r.k, r.s) for r in out.collect())
    assert [sk for sk, _, _ in got] == list(range(1, 9006))
    assert [k for _, k, _ in got] == sorted(k for _, k, _ in got)
    assert sum(s == "same" for _, _, s in got) == 3000


def test_dense_key_is_the_same_from_other_partitions(spark):
    df = spark.range(0, 500).select((F.col("id") % 50).alias("k"), (F.col("id") % 125).alias("v"))
    rows = [sorted(map(tuple, dense_surrogate_key(d, ["k"], "sk", num_partitions=p).collect()))
            for d, p in ((df, 3), (df.repartition(7), 3), (df.coalesce(1), 8))]
    assert rows[0] == rows[1] == rows[2]


def test_dense_key_collects_no_group(spark):
    """Most rows have a copy: a running sum places them, no array per range."""
    df = spark.range(0, 4000).select(F.floor(F.col("id") / 2).alias("k"))
    out = dense_surrogate_key(df, ["k"], "sk", start=1, num_partitions=3)
    assert "collect_list" not in out._jdf.queryExecution().executedPlan().toString()
    assert [(r.k, r.sk) for r in out.orderBy("sk").collect()] == [(i // 2, i + 1) for i in range(4000)]
