"""Sorted runs of packed numbers, which tasks exchange in place of single rows (operators 11 and 12).

A partition of documents is read in chunks of a bounded number of bytes (one document at least). Numbers of a chunk are
packed into zstd-compressed runs, so that a shuffle moves a few long rows in place of one row per word.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acctmart.llm.common import find_package

#: Bytes of text after which a chunk is closed.
CHUNK_BYTES = 8 << 20
#: Bytes and rows after which made rows are handed over to the JVM.
_OUT_BYTES, _OUT_ROWS = 8 << 20, 10_000


def pack(*arrays) -> bytes:
    """Whole-number or float arrays as one compressed run, each whole-number array in its smallest type."""
    import numpy as np
    import zstandard

    parts = []
    for a in map(np.asarray, arrays):
        if a.dtype.kind in "ui":
            top = int(a.max()) if a.size else 0
            a = a.astype(next(t for t in ("u1", "u2", "u4", "u8") if top <= np.iinfo(t).max))
        parts.append(struct.pack("<2sq", a.dtype.str[1:].encode(), a.size))
        # bytes of equal weight side by side compress better
        parts.append(np.ascontiguousarray(a).view("u1").reshape(-1, a.itemsize).T.tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def unpack(run: bytes) -> list:
    import numpy as np
    import zstandard

    raw, at, arrays = zstandard.ZstdDecompressor().decompress(run), 0, []
    while at < len(raw):
        kind, n = struct.unpack_from("<2sq", raw, at)
        kind, at = np.dtype("<" + kind.decode()), at + struct.calcsize("<2sq")
        flat = np.frombuffer(raw, "u1", n * kind.itemsize, at)
        arrays.append(np.ascontiguousarray(flat.reshape(kind.itemsize, -1).T).view(kind).reshape(-1))
        at += n * kind.itemsize
    return arrays


def gaps(ascending):
    """Ascending unsigned numbers as first value and differences."""
    import numpy as np

    out = np.array(ascending, "u8")
    out[1:] -= ascending[:-1].astype("u8")
    return out


def ascending(differences):
    import numpy as np

    return np.cumsum(differences, dtype="u8")


def _batch(schema, columns):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema)


def chunked(
    docs: DataFrame,
    inputs: list[Column],
    keep: list[str],
    per_doc: str,
    per_run: str,
    make: Callable[[], Callable[[list[list]], tuple[list[list], list[tuple]]]],
    limit: int = CHUNK_BYTES,
) -> DataFrame:
    """Rows of two kinds, for documents and for the runs made of a chunk of them.

    A document's row holds its ``keep`` columns (named ``_0``, ``_1``, ...), ``chunk``, ``place`` (its number in the
    chunk) and the columns ``per_doc``; a run's row holds ``chunk`` and the columns ``per_run``, and a null place. ``make()`` is
    called once per task and returns a function from lists of the input values of a chunk to the lists of
    ``per_doc`` values and the tuples of ``per_run`` values. The first input is the text, whose length limits a chunk.
    """
    import pyarrow as pa
    from pyspark import TaskContext
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import IntegerType, LongType, StructField, StructType

    made, run_fields = StructType.fromDDL(per_doc).fields, StructType.fromDDL(per_run).fields
    kept = [StructField(f"_{k}", docs.schema[c].dataType) for k, c in enumerate(keep)]
    numbers = [StructField("chunk", LongType()), StructField("place", IntegerType())]
    schema = StructType(kept + numbers + made + run_fields)
    arrow, width, taken = to_arrow_schema(schema), len(keep), range(len(inputs))

    def run(batches):
        function, first, count = make(), TaskContext.get().partitionId() << 32, 0
        rows, values, size = [], [[] for _ in taken], 0

        def close():
            n, chunk = len(values[0]), first + count
            of_docs, of_runs = function(values)
            table = pa.Table.from_batches(rows)
            columns = [table.column(k).combine_chunks() for k in range(width)]
            columns = [c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in columns]
            columns += [[chunk] * n, range(n), *of_docs, *([None] * n for _ in run_fields)]
            yield _batch(arrow, columns)
            for start in range(0, len(of_runs), 64):
                some = of_runs[start : start + 64]
                nothing = [[None] * len(some)] * width
                yield _batch(arrow, [*nothing, [chunk] * len(some), [None] * len(some), *([None] * len(some) for _ in made), *zip(*some)])

        for batch in batches:
            got, start = [batch.column(width + k).to_pylist() for k in taken], 0
            for i in range(batch.num_rows):
                size += len(got[0][i] or "")
                for column, value in zip(values, got):
                    column.append(value[i])
                if size >= limit or i == batch.num_rows - 1:
                    rows.append(batch.slice(start, i + 1 - start))
                    start = i + 1
                if size >= limit:
                    yield from close()
                    rows, values, size, count = [], [[] for _ in taken], 0, count + 1
        if rows:
            yield from close()

    find_package(docs)
    sent = [c.alias(f"_{k}") for k, c in enumerate([*(F.col(f"`{c}`") for c in keep), *inputs])]
    return docs.select(*sent).mapInArrow(run, schema)


def streamed(
    df: DataFrame,
    function: Callable[[Iterator[tuple]], Iterable[tuple]],
    ddl: str,
    keys: list[str] | None = None,
    order: list[str] | None = None,
) -> DataFrame:
    """Rows that ``function`` makes of a task's rows, taken one by one as tuples.

    With ``keys``, all rows of equal keys are in one task, one after the other, by ``order``.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL(ddl)
    arrow = to_arrow_schema(schema)

    def run(batches):
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
        out, size = [], 0
        for row in function(rows):
            out.append(row)
            size += sum(len(v) for v in row if isinstance(v, (bytes, str)))
            if size >= _OUT_BYTES or len(out) >= _OUT_ROWS:
                yield _batch(arrow, list(zip(*out)))
                out, size = [], 0
        if out:
            yield _batch(arrow, list(zip(*out)))

    find_package(df)
    if keys:
        df = df.repartition(*keys).sortWithinPartitions(*keys, *(order or []))
    return df.mapInArrow(run, schema)
