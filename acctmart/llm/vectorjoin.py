"""Near duplicates among vectors by an epsilon grid order join (operator 6).

Unit vectors at a cosine of c lie sqrt(2 - 2c) apart, and no further in any orthonormal projection. So vectors are projected on
their leading principal directions, put into grid cells of that width, and sorted by cell within their label. The sorted
sequence is cut into intervals of at most ``INTERVAL`` vectors of one cell. Two intervals can only hold a link if their cells touch in
each grid dimension and their bounding boxes are near enough; such pairs meet in one task, which joins them recursively, halving
intervals and leaving out halves whose boxes are too far apart, down to small blocks multiplied in double precision.

Where the vectors differ little along the leading directions, boxes hardly tell intervals apart: over the given tables
about 98 % of a label's pairs reach a task, so that the work grows with the square of a label's vectors.

The directions are fitted on at most ``SAMPLE`` vectors; any directions give exact results, good ones skip more. Equal
vectors of a label collapse first, combined before the shuffle, and count as often as they occur. A task holds two intervals,
whatever the size of a cell, and returns per vector a count and one edge to the smallest vector it reaches within the
two: never the pairs. Cosines within ``CLOSE`` of the threshold are computed anew from the given components.

Defined results: rows with a null label, or a vector that is null, empty, zero or holds null or non-finite components, link with nothing. So do
vectors of different lengths. Rows that repeat an id are vectors of their own for the counts and one node for the components. A null
id counts as a vector and has no component; it is kept. An empty table gives an empty result; other columns don't matter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acctmart.llm.common import cut, find_package
from acctmart.llm.components import components

COSINE = 0.93
#: Vectors that the directions are fitted on, and how many directions make the grid and the boxes.
SAMPLE, GRID, BOXES = 20_000, 3, 12
#: Vectors in an interval, and in a block that is multiplied.
INTERVAL, BLOCK = 1024, 128
CLOSE = 1e-9


def directions(vectors: DataFrame, sample: int = SAMPLE) -> dict[int, np.ndarray]:
    """Leading principal directions by vector length, from the ``sample`` vectors with the smallest hash."""
    some = vectors.orderBy(F.xxhash64("rep"), "rep").limit(sample).select("v").toPandas()["v"]
    by_length: dict[int, list] = {}
    for v in some:
        by_length.setdefault(len(v), []).append(v)
    found = {}
    for length, rows in by_length.items():
        x = _unit(rows)
        _, axes = np.linalg.eigh(np.cov(x, rowvar=False).reshape(length, length) if len(x) > 1 else np.eye(length))
        found[length] = axes[:, ::-1][:, :BOXES].T
    return found


def projected(v: np.ndarray, axes: dict[int, np.ndarray]) -> np.ndarray:
    """Unit vectors of one length on the directions; where none were fitted for it, on the first coordinates."""
    some = axes.get(v.shape[1])
    return v[:, :BOXES] if some is None else v @ some.T


def _scaled(row) -> np.ndarray:
    """The given components times a power of two, which changes no digit, so that no square overflows or vanishes."""
    v = np.asarray(row, float)
    return np.ldexp(v, -int(np.frexp(np.abs(v).max())[1]))


def _unit(rows) -> np.ndarray:
    x = np.asarray([np.asarray(r, float) for r in rows])
    # scaled first, so that no square overflows or vanishes
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def placed(vectors: DataFrame, axes: dict[int, np.ndarray], width: float) -> DataFrame:
    """``vectors`` with their grid ``cell`` and their length ``dim``."""
    kind = vectors.schema["v"].dataType.simpleString()
    schema = f"label int, key string, rep long, n long, v {kind}, dim int, cell array<int>"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for length, part in batch.groupby(batch["v"].map(len)):
                p = projected(_unit(part["v"]), axes)[:, :GRID]
                cells = np.floor(p / width).astype(np.int32)
                yield part.assign(dim=np.int32(length), cell=list(cells))[["label", "key", "rep", "n", "v", "dim", "cell"]]

    return vectors.mapInPandas(run, schema)


def intervals(sorted_rows: DataFrame, axes: dict[int, np.ndarray], size: int = INTERVAL) -> DataFrame:
    """Number the runs of at most ``size`` vectors of one cell in sorted partitions: column ``interval``."""
    columns = sorted_rows.columns
    box = T.ArrayType(T.DoubleType())
    added = [T.StructField("interval", T.StringType()), T.StructField("low", box), T.StructField("high", box)]
    schema = T.StructType(sorted_rows.schema.fields + added)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        task, number, held, key = TaskContext.get().partitionId(), 0, [], None

        def done():
            nonlocal number
            part = pd.DataFrame(held, columns=columns)
            p = projected(_unit(part["v"]), axes)
            number += 1
            low, high = p.min(axis=0).tolist(), p.max(axis=0).tolist()
            return part.assign(interval=f"{task}-{number}", low=[low] * len(part), high=[high] * len(part))

        for batch in batches:
            for row in batch.itertuples(index=False):
                here = (row.label, row.dim, tuple(row.cell))
                if held and (here != key or len(held) >= size):
                    yield done()
                    held = []
                key = here
                held.append(row)
        if held:
            yield done()

    return sorted_rows.mapInPandas(run, schema)


def join_intervals(
    x: np.ndarray, y: np.ndarray | None, p: np.ndarray, q: np.ndarray, raw_x, raw_y, cosine: float, reach: float
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of row numbers of linked unit vectors; ``y`` None joins ``x`` with itself, each pair once. No recursion deeper than the logarithm."""
    alone = y is None
    y, q, raw_y = (x, p, raw_x) if alone else (y, q, raw_y)
    todo = [(0, len(x), 0, len(y))]
    while todo:
        a, b, c, d = todo.pop()
        if a >= b or c >= d:
            continue
        gap = np.maximum(np.maximum(p[a:b].min(0) - q[c:d].max(0), q[c:d].min(0) - p[a:b].max(0)), 0)
        if math.sqrt(float(gap @ gap)) > reach:
            continue
        if b - a > BLOCK or d - c > BLOCK:
            m, n = ((a + b) // 2 if b - a > BLOCK else b), ((c + d) // 2 if d - c > BLOCK else d)
            for part in ((a, m, c, n), (m, b, c, n), (a, m, n, d), (m, b, n, d)):
                # of the mirrored halves of a self-join one is enough
                if not alone or part[3] > part[0]:
                    todo.append(part)
            continue
        dots = x[a:b] @ y[c:d].T
        for i, j in zip(*np.nonzero(np.abs(dots - cosine) <= CLOSE)):
            u, w = _scaled(raw_x[a + i]), _scaled(raw_y[c + j])
            dots[i, j] = float(u @ w) / (math.sqrt(float(u @ u)) * math.sqrt(float(w @ w)))
        i, j = np.nonzero(dots >= cosine)
        i, j = i + a, j + c
        if alone:
            i, j = i[j > i], j[j > i]
        if len(i):
            yield i, j


def _joined(axes: dict[int, np.ndarray], cosine: float, reach: float):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        first = rows["first"].to_numpy(bool)
        a, b = rows[first].sort_values("rep"), rows[~first].sort_values("rep")
        alone = b.empty
        # sorted as in the grid order, so that halves have tight boxes
        def ready(part):
            x = _unit(part["v"])
            p = projected(x, axes)
            order = np.lexsort(p.T[::-1])
            return part.iloc[order].reset_index(drop=True), x[order], p[order]

        a, x, p = ready(a)
        b, y, q = (a, None, p) if alone else ready(b)
        ids = np.concatenate([a["rep"], [] if alone else b["rep"]]).astype(np.int64)
        counts = np.concatenate([a["n"], [] if alone else b["n"]]).astype(np.int64)
        links = np.zeros(len(ids), np.int64)
        lead = np.arange(len(ids))
        shift = 0 if alone else len(a)

        def root(k):
            while lead[k] != k:
                lead[k] = lead[lead[k]]
                k = lead[k]
            return k

        for i, j in join_intervals(x, y, p, q, a["v"], b["v"], cosine, reach):
            j = j + shift
            np.add.at(links, i, counts[j])
            np.add.at(links, j, counts[i])
            for s, t in zip(i.tolist(), j.tolist()):
                s, t = root(s), root(t)
                if s != t:
                    low, high = (s, t) if ids[s] <= ids[t] else (t, s)
                    lead[high] = low
        some = links.nonzero()[0]
        keys = np.concatenate([a["key"], [] if alone else b["key"]])
        top = ids[[root(k) for k in some]]
        return pd.DataFrame(
            {"label": rows["label"].iloc[0], "key": keys[some], "rep": ids[some], "links": links[some], "lead": top}
        )

    return run


def linked_vectors(
    vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", cosine: float = COSINE
) -> DataFrame:
    """Per row of ``vectors``: vec_id, n_links, component_id and kept."""
    find_package(vectors)
    reach = math.sqrt(2 - 2 * cosine) + 1e-6
    given = vectors.schema[embedding].dataType
    # single precision stays as it is; all other components are doubles
    single = isinstance(given, T.ArrayType) and isinstance(given.elementType, T.FloatType)
    rows = vectors.select(
        F.col(f"`{vec_id}`").cast("long").alias("vec_id"),
        F.col(f"`{label}`").cast("int").alias("label"),
        F.col(f"`{embedding}`").cast("array<float>" if single else "array<double>").alias("v"),
    )
    finite = F.forall("v", lambda e: e.isNotNull() & (F.abs(e) < F.lit(float("inf"))) & ~F.isnan(e))
    usable = F.coalesce(
        F.col("label").isNotNull() & (F.size("v") > 0) & finite & F.exists("v", lambda e: e != 0), F.lit(False)
    )
    rows = rows.withColumn("key", F.when(usable, F.sha2(F.to_json("v"), 256)))
    # equal vectors of a label are one class; a class without any id has one of its own, below all ids
    classes = cut(
        rows.filter("key IS NOT NULL")
        .groupBy("label", "key")
        .agg(F.min("vec_id").alias("id"), F.count("*").alias("n"), F.first("v").alias("v"))
        .withColumn("rep", F.coalesce("id", -F.abs(F.xxhash64("key")) - 1))
    )
    axes = directions(classes)
    cells = placed(classes.select("label", "key", "rep", "n", "v"), axes, reach)
    # the sequence: sorted by label and cell; within a cell by the cell's own order of ids
    parts = cells.repartitionByRange("label", "dim", "cell", F.xxhash64("rep")).sortWithinPartitions("label", "dim", "cell", "rep")
    cutup = cut(intervals(parts, axes))
    boxes = cutup.select("label", "dim", "cell", "interval", "low", "high").groupBy("interval").agg(
        *[F.first(c).alias(c) for c in ("label", "dim", "cell", "low", "high")]
    )
    boxes = cut(boxes)
    # cells that touch in every grid dimension, each pair of intervals once
    steps = F.array(*[F.lit(k) for k in (-1, 0, 1)])
    near = F.array(F.array().cast("array<int>"))
    for _ in range(GRID):
        near = F.flatten(F.transform(near, lambda head: F.transform(steps, lambda s: F.concat(head, F.array(s)))))
    around = boxes.select(
        F.col("interval").alias("one"), "label", "dim", F.col("low").alias("low1"), F.col("high").alias("high1"),
        F.explode(F.transform(near, lambda s: F.zip_with("cell", F.slice(s, 1, F.size("cell")), lambda c, d: c + d))).alias("cell"),
    ).distinct()
    gaps = F.aggregate(
        F.zip_with(
            F.zip_with("low1", "high2", lambda l, h: l - h),
            F.zip_with("low2", "high1", lambda l, h: l - h),
            lambda u, w: F.pow(F.greatest(u, w, F.lit(0.0)), 2),
        ),
        F.lit(0.0),
        lambda t, g: t + g,
    )
    pairs = (
        around.join(
            boxes.select(F.col("interval").alias("two"), "label", "dim", "cell", F.col("low").alias("low2"), F.col("high").alias("high2")),
            ["label", "dim", "cell"],
        )
        .filter("one <= two")
        .filter(gaps <= reach * reach)
        .select("one", "two")
        .distinct()
    )
    sides = cut(pairs)
    members = cutup.select("interval", "label", "key", "rep", "n", "v")
    sent = (
        sides.select("one", "two", F.col("one").alias("interval"), F.lit(True).alias("first"))
        .union(sides.filter("one <> two").select("one", "two", F.col("two").alias("interval"), F.lit(False).alias("first")))
        .join(members, "interval")
        .select("one", "two", "first", "label", "key", "rep", "n", "v")
    )
    found = cut(
        sent.groupBy("one", "two").applyInPandas(_joined(axes, cosine, reach), "label int, key string, rep long, links long, lead long")
    )
    links = found.groupBy("label", "key").agg(F.sum("links").alias("links"))
    reached = components(found.filter("rep <> lead").select("rep", "lead"))
    named = (
        classes.select("label", "key", "rep", "id", "n")
        .join(links, ["label", "key"], "left")
        .join(reached.withColumnRenamed("id", "rep").withColumnRenamed("component", "top"), "rep", "left")
        .select("label", "key", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("top", "rep").alias("top"))
    )
    # the smallest id that a component has: classes without one have negative stand-ins
    smallest = named.join(classes.select("label", "key", "id"), ["label", "key"]).groupBy("top").agg(F.min("id").alias("component"))
    named = named.join(smallest, "top").select("label", "key", "n_links", "component")
    own = F.when(F.col("vec_id").isNotNull(), F.coalesce("component", "vec_id"))
    return (
        rows.select("vec_id", "label", "key")
        .join(named, ["label", "key"], "left")
        .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), own.alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
    )
