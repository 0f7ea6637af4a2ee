"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage


def _figures(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def _toward_least(pairs: DataFrame, keep: str) -> DataFrame:
    """Link the neighbours ``v`` of ``u`` that ``keep`` selects to the least
    of u and its neighbours; a hub's row count shrinks before the shuffle."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (pairs.filter(keep).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct())


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): every node of ``edges`` with the least node that it
    reaches.  Null ends and loops are ignored."""
    now = stage(edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v").distinct(), "components")
    figures = _figures(now)
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _toward_least(both, "v > u")
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        now = stage(_toward_least(down, "v <= u"), "components")
        before, figures = figures, _figures(now)
        if before == figures:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
