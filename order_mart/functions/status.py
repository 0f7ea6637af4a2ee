"""Status predicates.  Canonical outputs compare a normalised spelling;
the *_pipeline/*_sql variants compare the raw text exactly as written."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def normalized_status(col: Column | str = "order_status") -> Column:
    """'InProgress', 'In_progress' and 'inprogress' all become 'inprogress'."""
    c = F.col(col) if isinstance(col, str) else col
    return F.lower(F.regexp_replace(c, "_", ""))


def is_status(status: str, col: Column | str = "order_status") -> Column:
    """Spelling-tolerant equality used by the canonical outputs."""
    return normalized_status(col) == F.lit(status.replace("_", "").lower())


def is_status_exact(status: str, col: Column | str = "order_status") -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return c == F.lit(status)


def is_not_status_keep_null(status: str, col: Column | str = "order_status") -> Column:
    """Inequality that keeps NULL rows (NULL IS DISTINCT FROM 'x' is true)."""
    c = F.col(col) if isinstance(col, str) else col
    return ~c.eqNullSafe(F.lit(status))
