"""String builders used for labels and codes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def join_words(*cols: Column | str, sep: str = " ") -> Column:
    """Concatenate with a separator; NULL parts are skipped."""
    return F.concat_ws(sep, *[F.col(c) if isinstance(c, str) else c for c in cols])


def with_unit(value: Column | str, unit: str) -> Column:
    """Render a number followed by a unit, e.g. 3 -> '3KG'."""
    v = F.col(value) if isinstance(value, str) else value
    return F.concat(v.cast("string"), F.lit(unit))
