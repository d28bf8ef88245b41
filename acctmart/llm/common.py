"""What several operators share: reading tables, cutting lineage, and lambda-bound values."""

from __future__ import annotations

import ctypes
import gc
import hashlib
import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acctmart.operators.stored import stored

#: A word: a run of characters other than space and the five ASCII control blanks.
WORD = r"[^\x20\x09-\x0D]+"
#: The characters between words.
BLANKS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, by a path that Spark alone has to reach."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """The same rows, written to the checkpoint folder that the cluster names, without their lineage."""
    return stored(df)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once per row, however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def meet(left: DataFrame, right: DataFrame, *on: str, how: str = "inner") -> DataFrame:
    """Join on columns of the same names, null equal to null; the keys stay once."""
    named = right.select(*[F.col(f"`{c}`").alias(f"_right_{c}" if c in on else c) for c in right.columns])
    same = [F.col(c).eqNullSafe(F.col(f"_right_{c}")) for c in on]
    return left.join(named, same, how).drop(*[f"_right_{c}" for c in on])


def words(text: Column) -> Column:
    """The words of a text; none for null."""
    body = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(body == "", F.array().cast("array<string>")).otherwise(F.split(body, r"[\x20\x09-\x0D]+"))


_HELD: dict[str, tuple] = {}
_ASKED: set[str] = set()


def held(kind: str, key: str, make: Callable):
    """What ``make()`` gave for ``key`` last in this process; one value per kind is kept.

    ``key`` must tell the content that the value is made of, such as a digest of a file.
    """
    _ASKED.add(kind)
    if kind not in _HELD or _HELD[kind][0] != key:
        _HELD[kind] = key, make()
    return _HELD[kind][1]


def made(make: Callable):
    """``make()`` at the start of a task; what earlier tasks of this process held for other operators is let go."""
    _ASKED.clear()
    function = make()
    if others := _HELD.keys() - _ASKED:
        for kind in others:
            del _HELD[kind]
        gc.collect()
        give_back()
    return function


def give_back() -> None:
    """Freed memory goes back to the machine, as a worker that waits for its next task otherwise keeps it."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    # the C library's own call, where it has one
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def digest(*paths: str) -> str:
    """A digest of the content of files."""
    total = hashlib.sha256()
    for path in paths:
        with open(path, "rb") as f:
            total.update(hashlib.sha256(f.read()).digest())
    return total.hexdigest()


ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
def find_package(df: DataFrame) -> None:
    """Python workers on this machine find the package where the driver did; elsewhere it is installed or shipped."""
    df.sparkSession.sparkContext.environment.setdefault("PYTHONPATH", ROOT)


#: Rows that a Python task turns into Python values at once; texts may be long.
SLICE_ROWS = 256


def add_columns(
    df: DataFrame,
    inputs: list[str],
    added: str,
    make: Callable[[], Callable[..., list]],
    keep: list[str] | None = None,
    rows: int = SLICE_ROWS,
) -> DataFrame:
    """``df`` with columns computed in Arrow batches, a bounded slice of rows at a time.

    ``make()`` is called once per task and returns a function from lists of values (one per column
    of ``inputs``) to lists of values (one per column of the DDL string ``added``). ``keep`` names
    the columns to carry along, all by default; a column with the name of an added one gives way.
    """
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    new = StructType.fromDDL(added)
    carried = [c for c in (df.columns if keep is None else keep) if c not in new.names]
    schema = StructType([df.schema[c] for c in carried] + new.fields)
    arrow = to_arrow_schema(schema)
    width = len(carried)

    def run(batches):
        function = made(make)
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                part = batch.slice(start, rows)
                got = function(*(part.column(width + k).to_pylist() for k in range(len(inputs))))
                new_columns = [pa.array(v, type=arrow.field(width + k).type) for k, v in enumerate(got)]
                yield pa.RecordBatch.from_arrays([part.column(k) for k in range(width)] + new_columns, schema=arrow)
                got = new_columns = None
        function = None
        give_back()

    find_package(df)
    # the inputs go by place, so that no name can clash
    sent = [F.col(f"`{c}`").alias(f"_{k}") for k, c in enumerate([*carried, *inputs])]
    return df.select(*sent).mapInArrow(run, schema)
