"""left_join_split equals LEFT OUTER JOIN, NULL keys and hot keys included."""

from pyspark.sql import functions as F

from order_mart.operators.joins import left_join_split


def test_left_join_split_matches_outer_join(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (4, "d"), (4, "d")], "k long, l string")
    hot = spark.range(0, 3000).select(F.lit(1).cast("long").alias("k"), F.col("id").alias("r"))
    other = spark.createDataFrame([(2, 7), (None, 9), (5, 1)], "k long, r long")
    right = hot.unionByName(other)
    want = left.join(right, "k", "left")
    got = left_join_split(left, right, "k")
    assert got.columns == want.columns
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert got.count() == 3000 + 1 + 1 + 2


def test_left_join_split_plan_has_no_outer_join(spark):
    left = spark.range(0, 100).withColumnRenamed("id", "k")
    right = spark.range(0, 100).select((F.col("id") % 7).alias("k"), F.col("id").alias("r"))
    p = left_join_split(left, right, "k")._jdf.queryExecution().executedPlan().toString()
    assert "LeftOuter" not in p and "RightOuter" not in p
