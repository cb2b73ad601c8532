"""Time predicates and buckets."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from .common import date_lit, ts_lit


def window_start(as_of: datetime, days: int | None = None, hours: int | None = None) -> datetime:
    """Lower bound of a trailing window; hours win over days.

    ``days`` of 0 or None falls back to 7, while ``hours=0`` is honoured.
    """
    if hours is not None:
        return as_of - timedelta(hours=int(hours))
    return as_of - timedelta(days=int(days or 7))


def trailing_window(col: str | Column, as_of: datetime, days: int | None = None,
                    hours: int | None = None) -> Column:
    """``col >= as_of - interval`` (inclusive lower bound only, pushable)."""
    c = F.col(col) if isinstance(col, str) else col
    return c >= ts_lit(window_start(as_of, days, hours))


def on_day(col: str | Column, day: date) -> Column:
    """``col::date = day`` written as a range so parquet pushdown applies."""
    c = F.col(col) if isinstance(col, str) else col
    start = datetime(day.year, day.month, day.day)
    return (c >= ts_lit(start)) & (c < ts_lit(start + timedelta(days=1)))


def bucket_unit(hours: int | None) -> str:
    return "hour" if hours is not None else "day"


def truncate(col: str | Column, unit: str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.date_trunc(unit, c).cast("timestamp_ntz")


def utc_stamp(col: str | Column) -> Column:
    """``YYYYMMDDTHHMMSSZ`` of a UTC timestamp."""
    c = F.col(col) if isinstance(col, str) else col
    return F.date_format(c, "yyyyMMdd'T'HHmmss'Z'")


def duration_seconds(start: str | Column, end: str | Column) -> Column:
    """``max(0, round(end - start))`` in whole seconds (rounded, not truncated)."""
    s = F.col(start) if isinstance(start, str) else start
    e = F.col(end) if isinstance(end, str) else end
    micros = F.unix_micros(e.cast("timestamp")) - F.unix_micros(s.cast("timestamp"))
    return F.greatest(F.lit(0), F.round(micros / F.lit(1e6)).cast("bigint"))


__all__ = ["window_start", "trailing_window", "on_day", "bucket_unit", "truncate",
           "utc_stamp", "duration_seconds", "date_lit", "ts_lit"]
