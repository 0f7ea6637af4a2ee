"""Time arithmetic on TIMESTAMP_NTZ values (time-zone free)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def ntz_literal(value: dt.datetime | str) -> Column:
    """A TIMESTAMP_NTZ literal parsed from text.  (A Python datetime literal
    becomes a session-zone TIMESTAMP via the driver's local zone; comparing it
    with an NTZ column would shift the value when the two zones differ.)"""
    if isinstance(value, dt.datetime):
        value = value.isoformat(sep=" ")
    return F.lit(value).cast("timestamp_ntz")


def plus_seconds(ts: Column | str, seconds: Column | str) -> Column:
    """ts + n seconds as a day-time interval (no zone conversion)."""
    return _c(ts) + F.make_dt_interval(secs=_c(seconds).cast("decimal(18,6)"))


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """end - start in (fractional) seconds as DOUBLE; NULL if either is NULL."""
    return F.timestamp_diff("MICROSECOND", _c(start), _c(end)) / F.lit(1_000_000.0)


def whole_seconds_between(start: Column | str, end: Column | str) -> Column:
    """Rounded to whole seconds, half away from zero (epoch difference cast to
    an integer rounds rather than truncates)."""
    return F.round(seconds_between(start, end)).cast("bigint")


def as_of_date(as_of: dt.date | str | None) -> Column:
    """The run date: a fixed date for reproducible runs, else current_date()."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, str):
        as_of = dt.date.fromisoformat(as_of)
    return F.lit(as_of)


def date_sequence(start: Column | str, end: Column | str) -> Column:
    """Array of every day from start to end inclusive."""
    return F.sequence(_c(start).cast("date"), _c(end).cast("date"),
                      F.expr("INTERVAL 1 DAY"))
