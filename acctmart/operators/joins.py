"""Equi-joins by column name.

Which one to take:

* :func:`attach` -- both sides keyed alike (the case id). Inputs that are already
  hash-partitioned on the key join without a further shuffle.
* :func:`attach_dimension` -- a code table. Broadcast if a look at the table
  shows that it is small, else :func:`attach_spread`.
* :func:`attach_spread` -- a large lookup over a key that many left rows may share.
* :func:`attach_fan_out` -- a left join to a table in which one key may have very many rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    DataType,
    MapType,
    StringType,
    StructType,
    UserDefinedType,
    VariantType,
)

from acctmart.operators.newest import as_list

BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 16 * 1024 * 1024
_KEEPS_RIGHT = ("right", "right_outer", "rightouter", "full", "full_outer", "fullouter", "outer")
_SALT = "__salt"
_RN = "__rn"


def attach(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    how: str = "left",
    *,
    expect_unique: bool = False,
    hashed: bool = False,
) -> DataFrame:
    """Join ``right`` by name. Several matches give several rows, unless ``expect_unique``.

    ``hashed`` is for a right side with about one row per key: a task builds a hash table of its part of it
    and sorts neither side. In a chain of many such joins a sort per side would hold a page of memory each
    until the end of the task, which together can be more than a task has.
    """
    keys = as_list(on)
    if expect_unique:
        # right rows with a NULL key show up in right and full joins only
        right = assert_unique(right, keys, keep_unkeyed=how in _KEEPS_RIGHT)
    return left.join(right.hint("shuffle_hash") if hashed else right, keys, how)


def _all_known(keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def assert_unique(
    df: DataFrame, keys: str | Sequence[str], *, keep_unkeyed: bool = True
) -> DataFrame:
    """The same rows; running it fails if a key has more than one.

    Rows with a NULL key match nothing and so are no duplicates: all of them are
    passed on beside the check, or left out by ``keep_unkeyed=False`` (for a join that doesn't
    return them). Two rows per key are enough to know, so no key brings more than two
    from a task; without unkeyed rows, the shuffle is the one that a join on ``keys`` needs anyway.
    """
    keys = as_list(keys)
    window = Window.partitionBy(*keys).orderBy(*keys)
    message = F.concat(
        F.lit(f"more than one row for ({', '.join(keys)}) = "),
        F.to_json(F.struct(*[F.col(k) for k in keys])),
    )
    known = _all_known(keys)
    failed = F.when(F.col(_RN) == 2, F.raise_error(message).cast("boolean"))
    # the check fails at a second row, so leaving out third ones loses nothing
    single = (
        df.where(known)
        .withColumn(_RN, F.row_number().over(window))
        .where((F.col(_RN) <= 2) & failed.otherwise(True))
        .drop(_RN)
    )
    return single.unionByName(df.where(~known)) if keep_unkeyed else single


def _row_bytes(df: DataFrame) -> Column:
    """About the size of a row; nested values count as long as their text."""

    def size(field) -> Column:
        if isinstance(field.dataType, (StringType, BinaryType)):
            return F.coalesce(F.octet_length(F.col(f"`{field.name}`")), F.lit(0))
        if isinstance(field.dataType, (ArrayType, MapType, StructType)):
            text = F.to_json(F.struct(F.col(f"`{field.name}`")))
            return F.coalesce(F.octet_length(text), F.lit(0))
        return F.lit(0)

    sizes = [size(f).cast("long") for f in df.schema.fields]
    return reduce(lambda a, b: a + b, sizes, F.lit(16 * len(sizes)).cast("long"))


def _measurable(kind: DataType) -> bool:
    """Whether the size of such values can be told: of all types but those without a text form."""
    if isinstance(kind, ArrayType):
        return _measurable(kind.elementType)
    if isinstance(kind, MapType):
        return _measurable(kind.keyType) and _measurable(kind.valueType)
    if isinstance(kind, StructType):
        return all(_measurable(f.dataType) for f in kind.fields)
    return not isinstance(kind, (VariantType, UserDefinedType))


def fits_broadcast(
    *dfs: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> list[bool]:
    """Whether each frame is small enough to broadcast, measured in one job.

    A frame with a column whose size can't be told (a variant, a user type) is not.

    Tasks sum up their own rows, so that a frame that is not small costs one scan
    and no more; only the sums come to the driver.
    """
    probes = [
        df.select(_row_bytes(df).alias("b"))
        .agg(F.count("b").alias("n"), F.coalesce(F.sum("b"), F.lit(0)).alias("b"))
        .select(F.lit(i).alias("i"), "n", "b")
        for i, df in enumerate(dfs)
    ]
    found = {r.i: r for r in reduce(DataFrame.union, probes).collect()}
    told = [all(_measurable(f.dataType) for f in df.schema.fields) for df in dfs]
    return [
        told[i] and found[i].n <= max_rows and found[i].b <= max_bytes for i in range(len(dfs))
    ]


def attach_dimension(
    left: DataFrame,
    dim: DataFrame,
    on: str | Sequence[str],
    how: str = "left",
    *,
    fits: bool | None = None,
) -> DataFrame:
    """Join a code table: broadcast if it is small, else as a spread shuffle join.

    ``fits`` is the answer of :func:`fits_broadcast` where the caller has it already.
    """
    if fits is None:
        (fits,) = fits_broadcast(dim)
    if fits:
        return left.join(F.broadcast(dim), as_list(on), how)
    return attach_spread(left, dim, on, how)


def _holds_map(kind: DataType) -> bool:
    if isinstance(kind, ArrayType):
        return _holds_map(kind.elementType)
    if isinstance(kind, StructType):
        return any(_holds_map(f.dataType) for f in kind.fields)
    return isinstance(kind, (MapType, VariantType))


def _row_hash(df: DataFrame) -> Column:
    """A hash of a row's values, of those columns that can be hashed."""
    plain = [F.col(f"`{f.name}`") for f in df.schema.fields if not _holds_map(f.dataType)]
    return F.xxhash64(*plain) if plain else F.lit(0).cast("long")


def attach_spread(
    left: DataFrame, right: DataFrame, on: str | Sequence[str], how: str = "left"
) -> DataFrame:
    """Join where many left rows may share a key or have none.

    For ``left``, ``inner``, ``left_semi`` and ``left_anti``.

    Left rows with a NULL key match nothing, but would all hash to one task: a
    salt taken from the row spreads them. The salt, constant for real keys, is
    part of the join key on both sides, so that each side is shuffled for this join
    alone, also if it comes partitioned on the key; in that form adaptive execution
    can cut the partition of a key with too many left rows into several tasks.
    """
    keys = as_list(on)
    unknown = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    if how in ("inner", "left_semi"):
        spread = F.lit(1)  # rows without a key are dropped before the shuffle
    else:
        spread = F.shiftrightunsigned(_row_hash(left), 1) + 1
    salted = left.withColumn(_SALT, F.when(unknown, spread).otherwise(0).cast("long"))
    # no row has a NULL key and salt 0, so right rows with a NULL key match nothing
    plain = right.withColumn(_SALT, F.when(unknown, -1).otherwise(0).cast("long"))
    return salted.join(plain, keys + [_SALT], how).drop(_SALT)


def attach_fan_out(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    left_keys: DataFrame | None = None,
    keep_unkeyed: bool = True,
) -> DataFrame:
    """Left join where a key may have very many right rows, copies of one another included.

    Adaptive execution cannot split the right side of an outer join. So ``right`` first gets
    an empty row for every left key that it lacks; then an inner join does the same, and there
    either side can be split. ``left_keys`` is a frame with (at least) the left keys, if it can be
    had for less than ``left`` itself; ``keep_unkeyed=False`` says that no left key is NULL.
    """
    keys = as_list(on)
    known = _all_known(keys)
    wanted = (left if left_keys is None else left_keys).select(*keys).where(known).distinct()
    lacking = attach(wanted, right.select(*keys).distinct(), keys, "left_anti")
    padded = right.unionByName(lacking, allowMissingColumns=True)
    joined = attach_spread(left, padded, keys, "inner")
    if not keep_unkeyed:
        return joined
    return joined.unionByName(left.where(~known), allowMissingColumns=True)
