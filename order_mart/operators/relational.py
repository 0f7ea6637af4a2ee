"""Small relational building blocks: rename, drop, distinct, union, sort, head."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F


def rename_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k != v})


def drop_columns(df: DataFrame, *cols: str) -> DataFrame:
    return df.drop(*cols)


def distinct_rows(df: DataFrame) -> DataFrame:
    """Whole-row distinct; NULLs compare equal (partial dedup map-side)."""
    return df.distinct()


def union_all(*frames: DataFrame) -> DataFrame:
    """Bag concatenation by column name (UNION ALL)."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def sorted_by(df: DataFrame, *cols: str, spread_ties: bool = True) -> DataFrame:
    """Total sort (range-partitioned); use for display or ordered files only.

    With ``spread_ties`` rows with equal sort keys are ordered by a hash of
    the row, so a large group of equal keys is cut into several ranges instead
    of landing in one task (ties have no defined order anyway; the hash gives
    the same one when a task is computed again)."""
    if not spread_ties:
        return df.orderBy(*cols)
    return df.withColumn("_tie", F.xxhash64(*df.columns)).orderBy(*cols, "_tie").drop("_tie")


def preview(df: DataFrame, n: int, *order_cols: str) -> DataFrame:
    """First n rows under an explicit order (TakeOrderedAndProject: each task
    keeps its own top n, so no full sort is shuffled)."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in order_cols]).limit(n)
