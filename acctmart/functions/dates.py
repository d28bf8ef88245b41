"""Calendar rules. The as-of date is always an argument, never the clock."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_date(as_of: dt.date | str | Column) -> Column:
    """An as-of argument as a date column; text must be ``yyyy-MM-dd``."""
    if isinstance(as_of, Column):
        return as_of.cast("date")
    if isinstance(as_of, dt.datetime):
        return F.lit(as_of.date())
    if isinstance(as_of, str):
        as_of = dt.date.fromisoformat(as_of)
    return F.lit(as_of)


def iso_date(c: Column | str) -> Column:
    """``yyyy-MM-dd`` text of the date part."""
    return _col(c).cast("date").cast("string")


def days_since(c: Column | str, as_of, null_value: int | None = 0) -> Column:
    """Midnights crossed from ``c`` to ``as_of``; ``null_value`` where ``c`` is NULL."""
    day = _col(c).cast("date")
    return F.when(day.isNull(), F.lit(null_value).cast("int")).otherwise(
        F.date_diff(as_date(as_of), day)
    )


def month_boundaries(start: Column | str, end: Column | str) -> Column:
    """Month ends crossed from ``start`` to ``end`` (31 Jan to 1 Feb is 1)."""
    a, b = _col(start).cast("date"), _col(end).cast("date")
    return (F.year(b) - F.year(a)) * 12 + (F.month(b) - F.month(a))


def month_start(as_of, n: int = 0) -> Column:
    """First day of the month ``n`` months after that of ``as_of``."""
    return F.add_months(F.trunc(as_date(as_of), "MM"), n)


def next_due_date(day: Column | str, as_of) -> Column:
    """Next date with this day of month, not before ``as_of``'s day number.

    The due month is the next one if ``as_of``'s day is past ``day``, else the
    current one. Days beyond the month's end fall on its last day. NULL stays NULL.
    """
    d = _col(day)
    now = as_date(as_of)
    month = F.when(F.dayofmonth(now) > d, month_start(now, 1)).otherwise(month_start(now))
    last = F.last_day(month)
    return F.when(d > F.dayofmonth(last), last).otherwise(F.date_add(month, d - 1))
