"""One row per key.

``row_number() = 1`` is planned with a group limit on both sides of the
shuffle: every task sends at most one row per key, however many rows the key
has. ``max_by`` is not the same: it gives NULL where all order values are NULL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

_RN = "__rn"


def as_list(x) -> list:
    return [x] if isinstance(x, (str, Column)) else list(x)


def latest_per_key(
    df: DataFrame,
    keys: str | Sequence[str],
    order_by: str | Column | Sequence[str | Column],
    *,
    tie_break: str | Column | Sequence[str | Column],
) -> DataFrame:
    """Newest row per key: ``order_by`` descending (NULL last), then ``tie_break``.

    Names in ``tie_break`` sort ascending, or descending with a ``-`` in front. Together
    with ``order_by`` they should order all columns that are used later, or the
    pick among equal rows is not repeatable.
    """
    newest = [F.desc(c) if isinstance(c, str) else c for c in as_list(order_by)]
    return _first_row(df, as_list(keys), newest + _directed(tie_break))


def any_per_key(
    df: DataFrame,
    keys: str | Sequence[str],
    *,
    tie_break: str | Column | Sequence[str | Column],
) -> DataFrame:
    """One declared row per key: the first by ``tie_break``."""
    return _first_row(df, as_list(keys), _directed(tie_break))


def _directed(tie_break) -> list[Column]:
    return [
        c if isinstance(c, Column) else F.desc(c[1:]) if c.startswith("-") else F.asc(c)
        for c in as_list(tie_break)
    ]


def _first_row(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    if not keys or not order:
        raise ValueError("keys and a row order are required")
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RN, F.row_number().over(window)).where(F.col(_RN) == 1).drop(_RN)
