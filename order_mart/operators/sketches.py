"""Mergeable column profiles: stored HLL sketches in place of distinct counts.

A part of a table (a batch, a range, a day) is profiled once: rows, nulls and
a HyperLogLog sketch of the distinct values of every column, a few kilobytes
each.  Profiles of parts merge into that of their union, so an increment is
profiled alone and no earlier row is read again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

#: Registers of a sketch: 2**LG_K.  The error of an estimate is about 1.04 / sqrt(2**LG_K).
LG_K = 14
#: Three standard errors: what an estimate stays within in all but a few of a thousand cases.
ERROR_BOUND = 3 * 1.04 / 2 ** (LG_K / 2)

_PROFILE = ["column_name", "n_rows", "n_null", "sketch"]


def sketch_profile(df: DataFrame, lg_k: int = LG_K) -> DataFrame:
    """(column_name, n_rows, n_null, sketch) of every column, in one scan with
    a map-side partial step.  Values are sketched by their text; nulls are
    counted and not sketched.  An empty part has empty sketches."""
    cells = [F.struct(F.lit(c).alias("column_name"), F.count(F.lit(1)).alias("n_rows"),
                      F.count_if(F.col(f"`{c}`").isNull()).alias("n_null"),
                      F.hll_sketch_agg(F.col(f"`{c}`").cast("string"), lg_k).alias("sketch")) for c in df.columns]
    return df.agg(F.array(*cells).alias("_cells")).select(F.inline("_cells"))


def merge_profiles(*profiles: DataFrame) -> DataFrame:
    """Profile of the union of the parts; in any order and grouping."""
    rows = reduce(DataFrame.unionByName, [p.select(*_PROFILE) for p in profiles])
    return rows.groupBy("column_name").agg(F.sum("n_rows").alias("n_rows"), F.sum("n_null").alias("n_null"),
                                           F.hll_union_agg("sketch").alias("sketch"))


def estimates(profile: DataFrame) -> DataFrame:
    """(column_name, n_rows, n_null, n_distinct): estimates within
    ``ERROR_BOUND`` of the exact counts; small counts are nearly exact."""
    return profile.select("column_name", "n_rows", "n_null", F.hll_sketch_estimate("sketch").alias("n_distinct"))
