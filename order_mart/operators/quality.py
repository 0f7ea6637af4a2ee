"""Constraint and data-quality checks as table jobs.

Spark Parquet tables accept NOT NULL / key declarations but do not enforce
them on write, so each declared constraint becomes a query whose rows are
the violations (or per-column counts).  ``run_pipeline`` publishes only when
every check is clean.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import schemas
from ..functions import normalized_status


def _unpivot(df: DataFrame, rows: list[tuple[str, dict[str, F.Column]]]) -> DataFrame:
    """One aggregate pass producing one output row per named entry."""
    structs = [F.struct(F.lit(name).alias("column_name"), *[c.alias(k) for k, c in cols.items()])
               for name, cols in rows]
    return df.agg(F.array(*structs).alias("_rows")).select(F.inline("_rows"))


def check_not_null(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """(table_name, column_name, n_null) for each column, in one scan."""
    out = _unpivot(df, [(c, {"n_null": F.count_if(F.col(c).isNull())}) for c in columns])
    return out.select(F.lit(table).alias("table_name"), "column_name", "n_null")


def check_primary_key(df: DataFrame, table: str, keys: list[str]) -> DataFrame:
    """Key values that occur more than once (NULL keys count as violations)."""
    key = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in keys])
    dup = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
           .filter((F.col("n_rows") > 1) | F.greatest(*[F.col(k).isNull() for k in keys], F.lit(False))))
    return dup.select(F.lit(table).alias("table_name"), key.alias("key_value"), "n_rows")


def check_foreign_key(child: DataFrame, child_table: str, child_col: str,
                      parent: DataFrame, parent_col: str) -> DataFrame:
    """Child key values without a parent row (NULL keys are not checked).

    The child is reduced to its distinct keys with counts before the anti
    join, so a hot key costs one row, not a third of the table.
    """
    keys = (child.filter(F.col(child_col).isNotNull())
            .groupBy(child_col).agg(F.count(F.lit(1)).alias("n_rows")))
    parents = parent.select(F.col(parent_col).alias(child_col))
    return (keys.join(parents, child_col, "left_anti")
            .select(F.lit(child_table).alias("table_name"), F.lit(child_col).alias("column_name"),
                    F.col(child_col).alias("key_value"), "n_rows"))


def check_varchar_length(df: DataFrame, table: str, limits: dict[str, int]) -> DataFrame:
    """(table_name, column_name, max_length, n_too_long, longest) per column."""
    rows = [(c, {"max_length": F.lit(n),
                 "n_too_long": F.count_if(F.char_length(c) > n),
                 "longest": F.coalesce(F.max(F.char_length(c)), F.lit(0))})
            for c, n in limits.items()]
    return _unpivot(df, rows).select(F.lit(table).alias("table_name"), "column_name",
                                     "max_length", "n_too_long", "longest")


def check_status_domain(order_details: DataFrame) -> DataFrame:
    """Each distinct status spelling with its count, whether it is in the
    domain verbatim, and the normalised spelling it maps to."""
    return (order_details.groupBy("order_status").agg(F.count(F.lit(1)).alias("n_rows"))
            .select("order_status", "n_rows",
                    F.coalesce(F.col("order_status").isin(*schemas.STATUS_DOMAIN), F.lit(False))
                    .alias("in_domain"),
                    normalized_status("order_status").alias("normalized_status")))


def source_varchar_limits(table: str) -> dict[str, int]:
    return {c: n for (t, c), n in schemas.VARCHAR_LIMITS.items() if t == table}
