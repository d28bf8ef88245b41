"""Aggregates per key, built so that tasks combine rows before the shuffle."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from acctmart.functions.dates import as_date, month_boundaries, month_start
from acctmart.functions.flags import raise_if
from acctmart.operators.joins import attach
from acctmart.operators.newest import as_list

def first_last_dates(
    df: DataFrame,
    key: str | Sequence[str],
    code: str,
    date: str,
    spec: Mapping[str, tuple[str, Iterable[int]]],
) -> DataFrame:
    """First or last date per code set, all in one pass.

    ``spec`` maps an output name to ``("min" | "max", codes)``.
    """
    return df.groupBy(*as_list(key)).agg(*date_aggregates(code, date, spec))


def date_aggregates(
    code: str, date: str, spec: Mapping[str, tuple[str, Iterable[int]]]
) -> list[Column]:
    """Aggregates: first or last date per code set, as in :func:`first_last_dates`."""
    pick = {"min": F.min, "max": F.max}
    return [
        pick[how](F.when(F.col(code).isin(*codes), F.col(date))).alias(name)
        for name, (how, codes) in spec.items()
    ]


def join_text(
    df: DataFrame,
    key: str | Sequence[str],
    value: Column | str,
    name: str,
    sep: str = ",",
    *,
    order_by: Column | str | None = None,
    max_bytes: int | None = None,
) -> DataFrame:
    """One text per key of all its values, NULL values left out.

    Values are ordered by ``order_by`` and then by the text itself. Keys
    with no value are absent, so that a left join gives them NULL. A text is one value, held in
    memory as a whole. Where ``max_bytes`` is given, the sizes are summed per key first, and a
    key above it is an error before its text is made.
    """
    keys = as_list(key)
    texts = join_texts(df, keys, {name: (value, sep)}, order_by=order_by)
    if max_bytes is None:
        return texts.where(F.col(name).isNotNull())
    text = (F.col(value) if isinstance(value, str) else value).cast("string")
    item_bytes = F.octet_length(text).cast("long") + len(sep.encode())
    message = F.concat(
        F.lit(f"{name} is longer than {max_bytes} bytes for "),
        F.to_json(F.struct(*[F.col(k) for k in keys])),
    )
    sizes = df.groupBy(*keys).agg(F.sum(item_bytes).alias("__bytes"))
    within = raise_if(F.col("__bytes") > max_bytes, message, F.lit(True))
    # a NULL key is a key here, as in a grouping
    checked = sizes.where(within).select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)])
    same = [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)]
    rows = df.join(checked, same).drop(*checked.columns)
    return join_texts(rows, keys, {name: (value, sep)}, order_by=order_by).where(
        F.col(name).isNotNull()
    )


def join_texts(
    df: DataFrame,
    key: str | Sequence[str],
    texts: Mapping[str, tuple[Column | str, str]],
    *,
    order_by: Column | str | None = None,
) -> DataFrame:
    """Several texts per key, ``{name: (value, separator)}``, in one pass and one shuffle.

    Each as in :func:`join_text`; a key without a value for one of them gets NULL there.
    """
    keys = as_list(key)
    rank = F.lit(None).cast("string") if order_by is None else order_by
    rank = F.col(rank) if isinstance(rank, str) else rank
    values = {
        name: (F.col(value) if isinstance(value, str) else value).cast("string")
        for name, (value, _) in texts.items()
    }
    rows = df.select(*keys, rank.alias("__rank"), *[v.alias(f"__{n}") for n, v in values.items()])

    made = [
        ordered_text(F.col(f"__{name}"), sep, F.col("__rank")).alias(name)
        for name, (_, sep) in texts.items()
    ]
    return rows.groupBy(*keys).agg(*made)


def ordered_text(value: Column, sep: str, order_by: Column | None = None) -> Column:
    """Aggregate: the known values as one text, by ``order_by`` and then by themselves; NULL if there are none."""
    rank = F.lit(None).cast("string") if order_by is None else order_by
    item = F.when(value.isNotNull(), F.struct(rank.alias("r"), value.cast("string").alias("v")))
    items = F.sort_array(F.collect_list(item))
    return F.when(F.size(items) > 0, F.array_join(items["v"], sep))


_PIECE, _TEXT, _TIMES, _N = "__piece", "__text", "__times", "__n"


def text_pieces(
    df: DataFrame, key: str, value: Column | str, sep: str, piece_values: int, order_by: Column | None = None
) -> DataFrame | None:
    """(key, piece number, piece, values in it) of the keys with more than ``piece_values`` values; None if there is none.

    Rows of such keys are dealt by ranges of their order, so that a key's values come to several tasks, each of which makes one
    piece of about ``piece_values``. Equal values travel as one.
    """
    text = (F.col(value) if isinstance(value, str) else value).cast("string")
    rank = F.lit(None).cast("string") if order_by is None else order_by
    rows = df.select(key, rank.alias("__rank"), text.alias(_TEXT)).where(F.col(_TEXT).isNotNull())
    large = rows.groupBy(key).agg(F.count(F.lit(1)).alias(_N)).where(F.col(_N) > piece_values)
    total = large.agg(F.sum(_N)).first()[0]
    if not total:
        return None
    of_large = large.withColumn("__same", F.col(key)).drop(key)
    wanted = rows.join(of_large.select("__same"), F.col(key).eqNullSafe(F.col("__same"))).drop("__same")
    equal = wanted.groupBy(key, "__rank", _TEXT).agg(F.count(F.lit(1)).alias(_TIMES))
    dealt = equal.repartitionByRange(-(-total // piece_values), key, "__rank", _TEXT)
    # a row's copies are one item, with the separator between them
    item = F.concat(F.col(_TEXT), F.expr(f"repeat(concat({_literal(sep)}, {_TEXT}), cast({_TIMES} - 1 AS int))"))
    in_order = F.sort_array(F.collect_list(F.struct(F.col("__rank"), F.col(_TEXT), item.alias("i"))))
    return dealt.groupBy(key, F.spark_partition_id().alias(_PIECE)).agg(
        F.array_join(in_order["i"], sep).alias(_TEXT), F.sum(_TIMES).alias(_N)
    )


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def join_long_text(
    df: DataFrame,
    key: str,
    value: Column | str,
    name: str,
    sep: str = ",",
    *,
    order_by: Column | None = None,
    piece_values: int = 100_000,
) -> DataFrame:
    """As :func:`join_text`, where one key may have millions of values: no task sorts or holds all of them.

    A first job counts the values per key. The texts of keys with at most ``piece_values`` are made as usual, those of
    others in pieces by ranges of the order, which are then joined; only that last step holds a whole text.
    """
    pieces = text_pieces(df, key, value, sep, piece_values, order_by)
    if pieces is None:
        return join_text(df, key, value, name, sep, order_by=order_by)
    in_order = F.sort_array(F.collect_list(F.struct(_PIECE, _TEXT)))
    long = pieces.groupBy(key).agg(F.array_join(in_order[_TEXT], sep).alias(name))
    text = (F.col(value) if isinstance(value, str) else value).cast("string")
    counts = df.where(text.isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(_N))
    few = counts.where(F.col(_N) <= piece_values).select(F.col(key).alias("__same"))
    rest = df.join(few, F.col(key).eqNullSafe(F.col("__same")), "left_semi")
    return join_text(rest, key, value, name, sep, order_by=order_by).unionByName(long)


def count_related(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    name: str,
    where: Column | None = None,
) -> DataFrame:
    """Add the number of ``right`` rows per key that satisfy ``where``; 0 if none."""
    keys = as_list(on)
    rows = right if where is None else right.where(where)
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    return attach(left, counts, keys, hashed=True).withColumn(name, F.coalesce(F.col(name), F.lit(0)))


def has_related(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    name: str,
    where: Column | None = None,
) -> DataFrame:
    """Add whether any ``right`` row has the key and satisfies ``where``."""
    keys = as_list(on)
    rows = right if where is None else right.where(where)
    present = rows.groupBy(*keys).agg(F.lit(True).alias(name))
    return attach(left, present, keys, hashed=True).withColumn(name, F.coalesce(F.col(name), F.lit(False)))


def month_offset_pivot(
    df: DataFrame,
    key: str | Sequence[str],
    date: str,
    value: str,
    as_of,
    offsets: Iterable[int],
    prefix: str,
    *,
    on_duplicate: str = "error",
) -> DataFrame:
    """The value of the month ``k`` months before ``as_of``, one column per offset ``k``.

    One scan limited to the needed months and one aggregation. Two rows for a
    key and month are an error in the rows read from the result (``"error"``), or
    the larger value is kept (``"max"``); ``"mark"`` adds ``{prefix}ROWS``, the
    largest number of rows in any month, for a check after a join.
    """
    if on_duplicate not in ("error", "max", "mark"):
        raise ValueError("on_duplicate must be 'error', 'max' or 'mark'")
    offsets = sorted(set(offsets))
    now = as_date(as_of)
    # a plain range on the date itself, so that it reaches the files
    day = F.col(date)
    rows = df.where(
        (day >= month_start(now, -offsets[-1])) & (day < month_start(now, 1 - offsets[0]))
    ).select(
        *as_list(key), F.col(value).alias("__v"), month_boundaries(date, now).alias("__k")
    )
    at = {k: F.col("__k") == k for k in offsets}
    values = [F.max(F.when(at[k], F.col("__v"))).alias(f"{prefix}{k}") for k in offsets]
    if on_duplicate == "max":
        return rows.where(F.col("__k").isin(offsets)).groupBy(*as_list(key)).agg(*values)
    counts = [F.count(F.when(at[k], 1)).alias(f"__n{k}") for k in offsets]
    out = rows.where(F.col("__k").isin(offsets)).groupBy(*as_list(key)).agg(*values, *counts)
    if on_duplicate == "mark":
        most = F.greatest(*[F.col(f"__n{k}") for k in offsets], F.lit(0))
        return out.select(
            *as_list(key), *[f"{prefix}{k}" for k in offsets], most.alias(f"{prefix}ROWS")
        )
    return out.select(
        *as_list(key),
        *[
            raise_if(
                F.col(f"__n{k}") > 1,
                f"more than one row for a key, {k} months back",
                F.col(f"{prefix}{k}"),
            ).alias(f"{prefix}{k}")
            for k in offsets
        ],
    )
