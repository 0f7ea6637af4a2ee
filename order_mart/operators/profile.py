"""Column profiles: distinct and null counts per column, unique key counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .quality import _unpivot
from .relational import union_all


def profile_table(df: DataFrame, columns: list[str] | None = None, approx: bool = False,
                  rsd: float = 0.01) -> DataFrame:
    """(column_name, n_distinct, n_null) for every column.

    Exact distinct counts group each column on its own, deduplicated map-side
    before the shuffle: a task holds the values of one column, where one
    aggregate of all counts would hold a row for every value of every column,
    as wide as all columns together.  Each column is read in a scan of its own.
    ``approx=True`` swaps in HyperLogLog++ sketches, one aggregate pass (no
    shuffle of values at all) for very wide or very large tables.
    """
    cols = columns or df.columns
    if approx:
        return _unpivot(df, [(c, {"n_distinct": F.approx_count_distinct(F.col(c), rsd),
                                  "n_null": F.count_if(F.col(c).isNull())}) for c in cols])
    return union_all(*[_distinct_and_null(df, c) for c in cols])


def _distinct_and_null(df: DataFrame, column: str) -> DataFrame:
    values = df.select(F.col(column).alias("_value")).groupBy("_value").agg(F.count(F.lit(1)).alias("_rows"))
    return values.agg(F.count("_value").alias("n_distinct"),
                      F.coalesce(F.sum(F.when(F.col("_value").isNull(), F.col("_rows"))), F.lit(0)).alias("n_null")
                      ).select(F.lit(column).alias("column_name"), "n_distinct", "n_null")


def unique_count(df: DataFrame, table: str, column: str) -> DataFrame:
    """Number of unique values, NULL counted as one value when present."""
    return df.agg(
        (F.count_distinct(column) + F.max(F.col(column).isNull().cast("int"))).alias("n_unique")
    ).select(F.lit(table).alias("table_name"), F.lit(column).alias("column_name"),
             F.coalesce("n_unique", F.lit(0)).alias("n_unique"))
