"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def left_join_split(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """``left LEFT JOIN right USING (on)``, written so a hot key on the right
    side cannot pin one task.

    In an outer join Spark (and AQE's skew handling) can only split the
    preserved side; the other side's hot key would land in one task.  Here the
    matches come from an inner join (both sides splittable, or a broadcast of
    whichever side is small), and the left rows without a match come from an
    anti join against the right side's *distinct* keys (pre-aggregated, so a
    hot key is one row).  Left rows with a NULL key never match and come out
    of the anti join, exactly as in the outer join.
    """
    keyed = left.filter(F.col(on).isNotNull())
    matched = keyed.join(right, on, "inner")
    right_keys = right.select(on).filter(F.col(on).isNotNull()).distinct()
    extra = [c for c in right.columns if c != on]
    rtypes = dict(right.dtypes)
    nulls = [F.lit(None).cast(rtypes[c]).alias(c) for c in extra]
    # `keyed` feeds both joins through the same exchange (reused, so the
    # left side is shuffled once); NULL-key rows never match and skip it.
    unmatched = keyed.join(right_keys, on, "left_anti").select(*left.columns, *nulls)
    null_key = left.filter(F.col(on).isNull()).select(*left.columns, *nulls)
    cols = matched.columns
    return matched.unionByName(unmatched.select(*cols)).unionByName(null_key.select(*cols))
