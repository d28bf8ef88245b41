"""Operators against plain Python on small inputs with ties, NULLs and misses."""

import datetime as dt
import random
from collections import Counter, defaultdict
from decimal import Decimal as D

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

import acctmart as am
from acctmart.operators import assert_unique, fits_broadcast


def day(n):
    return None if n is None else dt.date(2000, 1, 1) + dt.timedelta(days=n)


@pytest.fixture(scope="module")
def history():
    rnd = random.Random(5)
    rows = [
        (rnd.choice([None, *range(12)]), day(rnd.choice([None, *range(6)])), rnd.randrange(20), i)
        for i in range(400)
    ]
    return rows + [(99, None, 3, 400), (99, None, 2, 401)]


@pytest.fixture(scope="module")
def frame(spark, history):
    return spark.createDataFrame(history, "k int, d date, v int, id int").repartition(5)


def test_latest_per_key(frame, history):
    best = {}
    for k, d, v, i in history:
        rank = (d is not None, d or dt.date.min, v, -i)
        if k not in best or rank > best[k][0]:
            best[k] = (rank, i)
    got = am.latest_per_key(frame, "k", "d", tie_break=["-v", "id"]).collect()
    assert {r.k: r.id for r in got} == {k: b[1] for k, b in best.items()}
    assert len(got) == len(best) and 99 in best  # a key with no date keeps a row


def test_any_per_key(frame, history):
    best = {}
    for k, _, v, i in history:
        best[k] = min(best.get(k, (v, i)), (v, i))
    got = am.any_per_key(frame, ["k"], tie_break=["v", "id"]).collect()
    assert {r.k: (r.v, r.id) for r in got} == best


def test_row_order_is_required(frame):
    with pytest.raises(ValueError):
        am.any_per_key(frame, "k", tie_break=[])


def test_first_last_dates(frame, history):
    want = {}
    for k in {h[0] for h in history}:
        low = [d for kk, d, v, _ in history if kk == k and v in (1, 2, 3) and d]
        high = [d for kk, d, v, _ in history if kk == k and v in (3, 4) and d]
        want[k] = (min(low, default=None), max(high, default=None))
    spec = {"a": ("min", (1, 2, 3, 3)), "b": ("max", (3, 4))}
    got = am.first_last_dates(frame, "k", "v", "d", spec).collect()
    assert {r.k: (r.a, r.b) for r in got} == want


def test_join_text(spark):
    rows = [(1, "b", 2), (1, "a", 3), (1, "b", 1), (1, None, 0), (2, None, 1), (None, "x", 1)]
    df = spark.createDataFrame(rows, "k int, s string, o int").repartition(3)
    got = {r.k: r.t for r in am.join_text(df, "k", "s", "t", ", ").collect()}
    assert got == {1: "a, b, b", None: "x"}
    got = {r.k: r.t for r in am.join_text(df, "k", "s", "t", "|", order_by="o").collect()}
    assert got == {1: "b|b|a", None: "x"}


def test_join_text_limit(spark):
    df = spark.range(100).select(F.lit(1).alias("k"), F.lit("abcd").alias("s"))
    assert len(am.join_text(df, "k", "s", "t", max_bytes=500).first().t) == 499
    with pytest.raises(PySparkException, match="t is longer than 499 bytes"):
        am.join_text(df, "k", "s", "t", max_bytes=499).collect()


def test_counts_and_flags(spark, frame, history):
    keys = spark.createDataFrame([(i,) for i in [*range(14), None]], "k int")
    counts = Counter(k for k, _, v, _ in history if v > 15 and k is not None)
    got = am.count_related(keys, frame, "k", "n", F.col("v") > 15).collect()
    assert {r.k: r.n for r in got} == {k: counts.get(k, 0) for k in [*range(14), None]}
    got = am.has_related(keys, frame, "k", "found", F.col("v") > 18).collect()
    found = {k for k, _, v, _ in history if v > 18 and k is not None}
    assert {r.k: r.found for r in got} == {k: k in found for k in [*range(14), None]}


def test_attach_fans_out_unless_unique(spark):
    left = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    right = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "x"), (None, "y")], "k int, v string")
    got = sorted((r.k, r.v or "") for r in am.attach(left, right, "k").collect())
    assert got == [(1, "a"), (1, "b"), (2, "c"), (3, "")]
    with pytest.raises(PySparkException, match="more than one row for"):
        am.attach(left, right, "k", expect_unique=True).collect()
    single = right.where("v <> 'b'")
    assert am.attach(left, single, "k", expect_unique=True).count() == 3
    assert assert_unique(single, "k").where("v = 'c'").count() == 1


def test_fits_broadcast(spark):
    wide = spark.range(50).select(F.repeat(F.lit("x"), 1000).alias("s"))
    few, many = spark.range(100), spark.range(101)
    assert fits_broadcast(few, many, wide, max_rows=100, max_bytes=10_000) == [True, False, False]


@pytest.mark.parametrize("how", ["left", "inner", "left_semi"])
def test_attach_spread(spark, how):
    rnd = random.Random(3)
    left = [(i, rnd.choice([None, 7, 7, i % 40])) for i in range(3000)]
    right = [(k, f"v{k}") for k in [None, 7, *range(10, 30)]]
    a = spark.createDataFrame(left, "id int, k int").repartition(4)
    b = spark.createDataFrame(right, "k int, v string").repartition(3)
    names = dict(right)
    del names[None]
    want = Counter(
        (i, k) if how == "left_semi" else (i, k, names.get(k))
        for i, k in left
        if how == "left" or k in names
    )
    columns = ["id", "k"] if how == "left_semi" else ["id", "k", "v"]
    got = am.attach_spread(a, b, "k", how).select(*columns).collect()
    assert Counter(map(tuple, got)) == want


@pytest.mark.parametrize("with_keys", [False, True])
def test_attach_fan_out(spark, with_keys):
    rnd = random.Random(4)
    left = [(i % 60, i) for i in range(90)] + [(None, -1), (None, -2)]
    right = [(7, "copy")] * 300 + [(rnd.randrange(50), f"v{i % 9}") for i in range(200)]
    right += [(None, "x"), (99, "y")]
    a = spark.createDataFrame(left, "k int, id int").repartition(3)
    b = spark.createDataFrame(right, "k int, v string").repartition(4)
    rows = defaultdict(list)
    for k, v in right:
        rows[k].append(v)
    want = Counter(
        (k, i, v) for k, i in left for v in ((rows.get(k) or [None]) if k is not None else [None])
    )
    got = am.attach_fan_out(a, b, "k", left_keys=a.select("k") if with_keys else None)
    assert got.columns == ["k", "id", "v"]
    assert Counter(map(tuple, got.collect())) == want
    known = am.attach_fan_out(a.where("k IS NOT NULL"), b, "k", keep_unkeyed=False).collect()
    assert Counter(map(tuple, known)) == Counter({r: n for r, n in want.items() if r[0] is not None})


def test_dimension_beyond_the_limit_gives_the_same(spark):
    left = spark.range(500).select("id", (F.col("id") % 9).alias("k"))
    dim = spark.range(7).select(F.col("id").alias("k"), F.col("id").cast("string").alias("n"))
    small = am.attach_dimension(left, dim, "k")
    large = am.attach_dimension(left, dim, "k", fits=False)
    assert sorted(small.collect()) == sorted(large.collect())


def test_lookup_name(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "f int")
    names = spark.createDataFrame([(1, "x"), (3, "p"), (3, "q")], "Id int, Name string")
    args = dict(on="f", dim_id="Id", dim_name="Name", name="n")
    got = am.lookup_name(left, names, **args).collect()
    assert {r.f: r.n for r in got} == {1: "x", 2: None, None: None}
    hit = left.union(spark.createDataFrame([(3,)], "f int"))
    with pytest.raises(PySparkException, match="more than one Name for Id 3"):
        am.lookup_name(hit, names, **args).collect()


def test_top1_lookup(spark, frame, history):
    dim = spark.createDataFrame([(i, f"n{i % 3}") for i in range(15)], "v int, name string")
    got = am.top1_lookup(
        frame, dim=dim, on="v", where=F.col("name") != "n0", key="k", order_by="d",
        tie_break=["name", "-v", "id"], values=["d", F.col("name").alias("label"), "id"],
    ).collect()
    best = {}
    for k, d, v, i in history:
        if v < 15 and v % 3:
            rank = (d is None, -(d or dt.date.min).toordinal(), f"n{v % 3}", -v, i)
            best[k] = min(best.get(k, (rank, d)), (rank, d), key=lambda x: x[0])
    assert {r.k: (r.d, r.label, r.id) for r in got} == {
        k: (d, rank[2], rank[4]) for k, (rank, d) in best.items()
    }


def test_latest_status_count(spark):
    links = [(1, "s1"), (1, "s1"), (1, "s2"), (2, "s2"), (3, "s3"), (4, None), (5, "s4")]
    past = [
        ("s1", day(1), 6), ("s1", day(2), 1), ("s2", day(3), 6), ("s2", day(1), 1),
        ("s4", day(1), None), (None, day(1), 1),
    ]
    got = am.latest_status_count(
        spark.createDataFrame(links, "c int, s string"),
        spark.createDataFrame(past, "s string, d date, st int"),
        key="c", entity="s", order_by="d", tie_break="-st", where=F.col("st") != 6, name="n",
    ).collect()
    assert {r.c: r.n for r in got} == {1: 2}


def months(spark, rows):
    return spark.createDataFrame(rows, "k int, d date, v decimal(18,2)")


def test_month_offset_pivot(spark):
    rows = [
        (1, dt.date(1999, 10, 31), D(3)), (1, dt.date(1999, 1, 1), D(12)),
        (1, dt.date(1998, 12, 31), D(13)), (1, dt.date(1999, 11, 1), D(2)),
        (2, dt.date(1999, 9, 15), None), (3, dt.date(2000, 1, 5), D(0)),
    ]
    got = am.month_offset_pivot(months(spark, rows), "k", "d", "v", "2000-01-31", range(3, 13), "m")
    assert got.columns == ["k", *[f"m{k}" for k in range(3, 13)]]
    found = {r.k: {c: v for c, v in r.asDict().items() if c != "k" and v is not None} for r in got.collect()}
    assert found == {1: {"m3": D(3), "m12": D(12)}, 2: {}}


def test_month_offset_pivot_sums_and_gaps(spark, history):
    rows = sorted({(k, dt.date(1999, 1 + i % 12, 3)): (k, dt.date(1999, 1 + i % 12, 3), D(v))
                   for k, _, v, i in history if k is not None}.values())
    got = am.month_offset_pivot(months(spark, rows), "k", "d", "v", "2000-01-31", (9, 2, 5), "m").collect()
    want = defaultdict(D)
    for k, d, v in rows:
        if 12 + 1 - d.month in (2, 5, 9):
            want[k] += v
    assert {r.k: sum(x for x in (r.m2, r.m5, r.m9) if x is not None) for r in got} == want


def test_two_rows_in_a_month(spark):
    rows = [(1, dt.date(1999, 10, 1), D(3)), (1, dt.date(1999, 10, 31), None), (2, dt.date(1999, 9, 1), D(1))]
    df = months(spark, rows)
    args = ("k", "d", "v", "2000-01-31", (3, 4), "m")
    with pytest.raises(PySparkException, match="more than one row for a key, 3 months back"):
        am.month_offset_pivot(df, *args).collect()
    # other months are fine
    assert am.month_offset_pivot(df, *args).select("k", "m4").count() == 2
    got = {r.k: r.m3 for r in am.month_offset_pivot(df, *args, on_duplicate="max").collect()}
    assert got == {1: D(3), 2: None}
    got = {r.k: r.mROWS for r in am.month_offset_pivot(df, *args, on_duplicate="mark").collect()}
    assert got == {1: 2, 2: 1}
    with pytest.raises(ValueError):
        am.month_offset_pivot(df, *args, on_duplicate="first")


@pytest.mark.parametrize("how", ["left", "inner", "right", "full"])
def test_unique_check_keeps_rows_without_a_key(spark, how):
    left = spark.createDataFrame([(1, "l"), (5, "m"), (None, "n")], "k int, a string")
    rows = [(1, "a"), (2, "b"), *[(None, v) for v in "uvwxy"]]
    right = spark.createDataFrame(rows, "k int, b string").repartition(3)
    got = am.attach(left, right, "k", how, expect_unique=True)
    want = am.attach(left, right, "k", how)
    key = lambda df: sorted(tuple(map(str, r)) for r in df.select("k", "a", "b").collect())
    assert key(got) == key(want)
    assert assert_unique(right, "k").count() == len(rows)
    assert assert_unique(right, "k", keep_unkeyed=False).count() == 2


def test_join_texts(spark):
    rows = [(1, "b", 2), (1, "a", 3), (1, None, 1), (2, None, 1), (None, "x", 1)]
    df = spark.createDataFrame(rows, "k int, s string, o int").repartition(3)
    got = am.join_texts(df, "k", {"s": ("s", ","), "o": ("o", "+")}, order_by="o").collect()
    assert {r.k: (r.s, r.o) for r in got} == {1: ("b,a", "1+2+3"), 2: (None, "1"), None: ("x", "1")}


def test_nested_values_are_measured(spark):
    big = spark.range(20).select(F.array_repeat(F.lit("x" * 50), 100).alias("v"))
    pairs = spark.range(20).select(F.create_map(F.lit(1), F.repeat(F.lit("x"), 5000)).alias("m"))
    small = spark.range(20).select(F.array(F.lit(1)).alias("v"))
    variant = spark.range(1).select(F.parse_json(F.lit("1")).alias("v"))
    limits = {"max_rows": 100, "max_bytes": 50_000}
    assert fits_broadcast(big, pairs, small, variant, **limits) == [False, False, True, False]


def test_spread_join_with_map_columns(spark):
    left = spark.createDataFrame([(1, {"a": 1}), (None, {"b": 2}), (None, {})], "k int, m map<string,int>")
    right = spark.createDataFrame([(1, "x"), (None, "y")], "k int, v string")
    got = am.attach_spread(left, right, "k").collect()
    assert sorted((str(r.k), str(r.v), len(r.m)) for r in got) == [
        ("1", "x", 1), ("None", "None", 0), ("None", "None", 1),
    ]
