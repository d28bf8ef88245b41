"""Flags, defaults and checks on single values."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def flag_yn(predicate: Column, yes: str = "Y", no: str = "N") -> Column:
    """``yes`` where the predicate holds; ``no`` where it is false or NULL."""
    return F.when(predicate, yes).otherwise(no)


def clamp_min(c: Column | str, low: int = 0) -> Column:
    """Raise values below ``low`` to ``low``; NULL stays NULL (``greatest`` would not keep it)."""
    value = _col(c)
    return F.when(value < low, F.lit(low)).otherwise(value)


def or_default(c: Column | str, default) -> Column:
    """First value, else the default."""
    value = _col(c)
    return F.coalesce(value, default if isinstance(default, Column) else F.lit(default))


def raise_if(condition: Column, message: str | Column, value: Column) -> Column:
    """``value``, but an error in rows where ``condition`` holds."""
    text = message if isinstance(message, Column) else F.lit(message)
    # raise_error has no type of its own: as the first branch it takes that of value
    return F.when(condition, F.raise_error(text)).otherwise(value)
