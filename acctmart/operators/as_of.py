"""The newest row per key at each of several dates, in one pass over a history."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from acctmart.operators.fused import _ordering

_SLOT, _BEST, _NEXT = "__slot", "__best", "__next"


def as_days(dates: Iterable[dt.date | str]) -> list[dt.date]:
    """Different dates in order."""
    return sorted({d if isinstance(d, dt.date) else dt.date.fromisoformat(d) for d in dates})


def newest_as_of(
    df: DataFrame,
    key: str,
    order_by: str,
    dates: Iterable[dt.date | str],
    *,
    tie_break: Sequence[str],
    values: Mapping[str, str],
    name: str = "as_of",
    where: Column | None = None,
) -> DataFrame:
    """(key, date, values): per known key and date the newest row of that day or before.

    A row counts from the first of the dates that is not before its day; rows after the last date are never read further.
    Each task keeps one row per key and date, so that a key with a very long history sends few. The rows of
    a key, as many as there are dates at most, are then carried forward in order. A row without a date is older than
    all others and counts at every date. A key is absent at the dates before its first row. ``values`` maps new names to
    columns; ties go by ``tie_break``, descending with a ``-`` in front.
    """
    days = as_days(dates)
    if not days:
        raise ValueError("dates are required")
    ordering = _ordering(df, [f"-{order_by}", *tie_break])
    if ordering is None:
        raise ValueError(f"no ascending form of the order by {order_by} and {list(tie_break)}")
    day = F.to_date(F.col(f"`{order_by}`"))
    grid = F.array(*[F.lit(d) for d in days])
    counted = F.col(f"`{key}`").isNotNull() & (day.isNull() | (day <= F.lit(days[-1])))
    rows = df.where(counted if where is None else counted & where)
    slot = F.size(F.filter(grid, lambda d: F.coalesce(d < day, F.lit(False))))
    best = F.struct(
        *[c.alias(f"o{i}") for i, c in enumerate(ordering)],
        *[F.col(f"`{c}`").alias(f"v{i}") for i, c in enumerate(values.values())],
    )
    found = rows.groupBy(F.col(f"`{key}`").alias(key), slot.alias(_SLOT)).agg(F.min(best).alias(_BEST))
    forward = Window.partitionBy(key).orderBy(_SLOT)
    carried = found.select(
        key,
        _SLOT,
        F.min(_BEST).over(forward.rowsBetween(Window.unboundedPreceding, 0)).alias(_BEST),
        F.coalesce(F.lead(_SLOT).over(forward), F.lit(len(days))).alias(_NEXT),
    )
    at = F.explode(F.sequence(F.col(_SLOT), F.col(_NEXT) - 1))
    return carried.select(key, _BEST, at.alias(_SLOT)).select(
        key,
        F.element_at(grid, F.col(_SLOT) + 1).alias(name),
        *[F.col(f"{_BEST}.v{i}").alias(new) for i, new in enumerate(values)],
    )


def over_dates(keys: DataFrame, dates: Iterable[dt.date | str], name: str = "as_of") -> DataFrame:
    """Every row once for each of the dates."""
    return keys.withColumn(name, F.explode(F.array(*[F.lit(d) for d in as_days(dates)])))
