"""Fused picks against windows, and their plans."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from conftest import executed_plan
from pyspark.sql import functions as F

import acctmart as am
from acctmart.operators import FirstRow, fused, newest, ordered_text

SCHEMA = "k long, d date, t timestamp, n timestamp_ntz, m decimal(9,2), i int, b boolean, s string, w string"


def history(spark, rows=600):
    pick = random.Random(4)
    moment = dt.datetime(2000, 1, 1)
    maybe = lambda v: None if pick.random() < 0.2 else v
    made = []
    for _ in range(rows):
        at = moment + dt.timedelta(seconds=pick.randrange(200_000), microseconds=pick.randrange(3))
        made.append((  # k, d, t, n, m, i, b, s, w
            maybe(pick.randrange(40)), maybe(at.date() - dt.timedelta(days=pick.randrange(20_000))), maybe(at), maybe(at),
            maybe(Decimal(pick.randrange(-300, 300)) / 100), maybe(pick.randrange(-3, 4)),
            maybe(pick.random() < 0.5), maybe(pick.choice("abc")), str(pick.randrange(10**9)),
        ))
    return spark.createDataFrame(made, SCHEMA).repartition(4)


@pytest.mark.parametrize("column", ["d", "t", "n", "m", "i", "b", "s"])
def test_picks_equal_windows(spark, column):
    df = history(spark)
    where = F.col("i") > -2
    rows = [
        newest(column, ["i", "w"], {"x": column, "y": "w"}),
        newest(column, ["-i", "w"], {"f": "w"}, where=where),
        FirstRow([column, "w"], {"z": "w"}),
    ]
    got = fused(df, "k", rows, [ordered_text(F.col("s"), ",").alias("text"), F.max("d").alias("last")])
    known = df.where("k IS NOT NULL")
    want = am.latest_per_key(known, "k", column, tie_break=["i", "w"]).select("k", F.col(column).alias("x"), F.col("w").alias("y"))
    some = am.latest_per_key(known.where(where), "k", column, tie_break=["-i", "w"]).select("k", F.col("w").alias("f"))
    first = am.any_per_key(known, "k", tie_break=[column, "w"]).select("k", F.col("w").alias("z"))
    text = am.join_text(known, "k", "s", "text")
    last = known.groupBy("k").agg(F.max("d").alias("last"))
    want = want.join(some, "k", "left").join(first, "k").join(text, "k", "left").join(last, "k")
    assert got.columns == want.columns
    key = lambda r: r["k"]
    assert sorted(got.collect(), key=key) == sorted(want.collect(), key=key)
    plan = executed_plan(got).split("Initial Plan")[0]
    assert ("Window" in plan) == (column == "s")
    if column != "s":
        assert plan.count("Exchange hash") == 1


def test_nothing_and_one_row(spark):
    df = history(spark)
    assert fused(df.limit(0), "k", [newest("d", ["w"], {"x": "w"})]).count() == 0
    one = spark.createDataFrame([(1, None, None, None, None, None, None, None, "w")], SCHEMA)
    assert fused(one, "k", [newest("d", ["w"], {"x": "w"}, where=F.col("i") > 0)]).collect() == [(1, None)]


def test_a_hot_key_sends_a_row_a_task(spark, conf):
    hot = spark.range(100_000).select(F.lit(1).alias("k"), F.col("id").cast("int").alias("i"), F.col("id").cast("string").alias("w"))
    got = fused(hot.repartition(6), "k", [newest("i", ["w"], {"x": "w"})])
    assert got.collect() == [(1, "99999")]
    assert "partial_min" in executed_plan(got)


def test_extract_scans_each_history_once(spark, book, conf, tmp_path):
    conf(spark__sql__maxMetadataStringLength="2000")
    base = str(tmp_path / "book")
    for name in ("Applicant_TBL", "DirectDebitInstructions", "StatusSecondary"):
        book[name].write.parquet(f"{base}/{name}")
    tables = {**book, **{n: spark.read.parquet(f"{base}/{n}") for n in ("Applicant_TBL", "DirectDebitInstructions", "StatusSecondary")}}
    plan = executed_plan(am.build_extract(tables, "2000-01-31"))
    for name in ("Applicant_TBL", "DirectDebitInstructions", "StatusSecondary"):
        assert plan.count(f"{base}/{name}]") == 1
