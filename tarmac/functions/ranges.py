"""Time-range and prefix predicates with typed UTC literals (pushed down to Parquet).

The literals are built from UTC text on the driver and handed to Spark as timestamp
values, so filters do not depend on the session time zone and constant-fold into
``PushedFilters`` on the scan.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def utc_instant(text: str | datetime | date) -> Column:
    """Typed timestamp literal for a UTC wall clock (``2012-01-25`` or ``2012-01-25 23:59:59``)."""
    if isinstance(text, datetime):
        value = text if text.tzinfo else text.replace(tzinfo=timezone.utc)
    elif isinstance(text, date):
        value = datetime(text.year, text.month, text.day, tzinfo=timezone.utc)
    else:
        value = datetime.fromisoformat(text.strip().replace("+0000", "+00:00"))
        if value.tzinfo is None:
            value = value.replace(tzinfo=timezone.utc)
    return F.lit(value.astimezone(timezone.utc))


def _day(day: str | date) -> datetime:
    d = date.fromisoformat(day) if isinstance(day, str) else day
    return datetime(d.year, d.month, d.day, tzinfo=timezone.utc)


def half_open(col, lo, hi) -> Column:
    """P-09: ``lo <= col < hi``."""
    return (_c(col) >= utc_instant(lo)) & (_c(col) < utc_instant(hi))


def closed(col, lo, hi) -> Column:
    """P-10 / P-12: ``lo <= col <= hi`` (SQL BETWEEN)."""
    return _c(col).between(utc_instant(lo), utc_instant(hi))


def open_range(col, lo, hi) -> Column:
    """P-11: ``lo < col < hi``."""
    return (_c(col) > utc_instant(lo)) & (_c(col) < utc_instant(hi))


def day_range(col, day, style: str = "half_open") -> Column:
    """One UTC calendar day.

    ``half_open``: [day 00:00, next day 00:00) — Q-01.
    ``closed``:    [day 00:00:00, day 23:59:59] — Q-03 (a departure in the last
                   second of the day is outside, as in the original question).
    ``open``:      (day 00:00:00, day 23:59:59) — the exploration's form.
    """
    start = _day(day)
    if style == "half_open":
        return half_open(col, start, start + timedelta(days=1))
    last = start + timedelta(days=1, seconds=-1)
    if style == "closed":
        return closed(col, start, last)
    if style == "open":
        return open_range(col, start, last)
    raise ValueError(f"unknown range style {style!r}")


def starts_with(col, prefix: str) -> Column:
    """P-13: prefix test (pushed down as ``StringStartsWith``)."""
    return _c(col).startswith(prefix)
