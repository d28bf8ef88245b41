"""Newest rows at several dates, one type per kind of key, options per table, and texts of very many values."""

import datetime as dt
import random
from collections import Counter

import pytest
from conftest import executed_plan
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

import acctmart as am
from acctmart.operators import join_long_text, newest_as_of, over_dates
from acctmart.operators.aggregates import text_pieces
from acctmart.plans.extract import HISTORY_DAYS
from acctmart.sources.contract import agree_keys

DATES = [dt.date(2000, 1, 31), dt.date(1999, 6, 15), dt.date(2001, 2, 1), dt.date(1999, 6, 15)]


def test_newest_row_at_each_date(spark):
    pick = random.Random(9)
    day = lambda: None if pick.random() < 0.1 else dt.date(1999, 1, 1) + dt.timedelta(pick.randrange(1000))
    rows = [(pick.choice([None, *range(30)]), day(), pick.randrange(3), f"v{i}") for i in range(400)]
    df = spark.createDataFrame(rows, "k int, d date, i int, v string").repartition(4)
    got = newest_as_of(df, "k", "d", DATES, tie_break=["-i", "v"], values={"value": "v", "on": "d"})
    want = set()
    for date in set(DATES):
        for k in range(30):
            known = [r for r in rows if r[0] == k and (r[1] is None or r[1] <= date)]
            if known:
                best = min(known, key=lambda r: (r[1] is None, -(r[1] or date).toordinal(), -r[2], r[3]))
                want.add((k, date, best[3], best[1]))
    assert set(map(tuple, got.collect())) == want and got.count() == len(want)
    assert newest_as_of(df.limit(0), "k", "d", DATES, tie_break=["v"], values={"x": "v"}).count() == 0
    plan = executed_plan(got).split("Initial Plan")[0]
    assert "partial_min" in plan and plan.count("Exchange hash") == 2  # by key and date, then the few rows by key
    with pytest.raises(ValueError, match="dates are required"):
        newest_as_of(df, "k", "d", [], tie_break=["v"], values={"x": "v"})
    assert over_dates(spark.range(2), DATES).count() == 6


def test_times_of_the_last_day_count(spark):
    rows = [(1, dt.datetime(2000, 1, 31, 23, 59), "late"), (1, dt.datetime(2000, 2, 1), "next")]
    df = spark.createDataFrame(rows, "k int, t timestamp, v string")
    got = newest_as_of(df, "k", "t", ["2000-01-31"], tie_break=["v"], values={"v": "v"})
    assert [r["v"] for r in got.collect()] == ["late"]


def test_extract_at_a_point_in_time(spark, book):
    date = "1998-09-15"
    before = dict(book)
    for name, column in HISTORY_DAYS.items():
        day = F.to_date(F.col(f"`{column}`"))
        before[name] = book[name].where(day.isNull() | (day <= F.lit(date).cast("date")))
    want = Counter(am.build_extract(before, date, ordered=False).collect())
    assert Counter(am.build_extract(book, date, ordered=False, point_in_time=True).collect()) == want
    assert Counter(am.build_extract(book, date, ordered=False).collect()) != want


def test_unlike_key_types_give_the_same_extract(book):
    want = Counter(am.build_extract(book, "2000-01-31", ordered=False).collect())
    odd = dict(book)
    for name, column, kind in (
        ("CaseInformation", "CaseID", "string"), ("Rate_TBL", "CaseID", "decimal(18,0)"), ("Rate_TBL", "IndexID", "string"),
        ("Status_TBL", "StatusID", "bigint"), ("CaseSecurity", "SecurityID", "string"), ("PaymentFrequency", "Id", "smallint"),
    ):
        odd[name] = odd[name].withColumn(column, F.col(column).cast(kind))
    assert Counter(am.build_extract(odd, "2000-01-31", ordered=False).collect()) == want


def test_keys_that_cannot_be_compared(book):
    bad = {**book, "CreditGrade": book["CreditGrade"].withColumn("CaseID", F.col("CaseID").cast("double"))}
    with pytest.raises(TypeError, match="the keys of one case have types.*CreditGrade.CaseID is double"):
        am.build_extract(bad, "2000-01-31")
    text = {**book, "CreditGrade": book["CreditGrade"].withColumn("CaseID", F.concat(F.lit("x"), F.col("CaseID").cast("string")))}
    with pytest.raises(PySparkException, match="CreditGrade.CaseID holds no whole number: x"):
        am.build_extract(text, "2000-01-31").collect()


def test_agreed_types(spark):
    left = spark.createDataFrame([(1, None), (None, None)], "IndexID int, o void")
    right = spark.createDataFrame([("1",), (" 2 ",), (None,)], "IndexID string")
    got, wrong = agree_keys({"Rate_TBL": left, "Index_TBL": right})
    assert not wrong and [r[0] for r in got["Index_TBL"].select("IndexID").collect()] == [1, 2, None]
    assert got["Rate_TBL"].schema["IndexID"].dataType == got["Index_TBL"].schema["IndexID"].dataType


def test_format_and_options_per_table(spark, tmp_path):
    base = str(tmp_path)
    spark.range(3).write.parquet(f"{base}/a.parquet")
    spark.createDataFrame([("x;1",)], "c string").write.text(f"{base}/b.csv")
    spark.createDataFrame([("y|2",)], "c string").write.text(f"{base}/c.csv")
    t = am.load_tables(
        spark, base, ["a", "b", "c"], formats={"b": "csv", "c": "csv"}, options={"sep": ";"},
        table_options={"c": {"sep": "|"}}, schemas={"b": "n string, i int", "c": "n string, i int"},
    )
    assert t["a"].count() == 3 and t["b"].collect() == [("x", 1)] and t["c"].collect() == [("y", 2)]
    with pytest.raises(ValueError, match="tables that are not read: .'d'"):
        am.load_tables(spark, base, ["a"], formats={"d": "csv"})


@pytest.mark.parametrize("sep", [",", "' \\"])
def test_long_texts_in_pieces(spark, sep):
    hot = spark.range(60_000).select(
        F.when(F.col("id") % 3 > 0, 1).alias("k"), F.concat(F.lit("v"), F.pmod(F.xxhash64("id"), F.lit(30_000)).cast("string")).alias("v")
    )
    few = spark.createDataFrame([(2, "b"), (2, "a"), (3, None), (2, "a")], "k int, v string")
    df = hot.union(few).repartition(5)
    got = {r["k"]: r["t"] for r in join_long_text(df, "k", "v", "t", sep, piece_values=5_000).collect()}
    values = {}
    for r in df.collect():
        if r["v"] is not None:
            values.setdefault(r["k"], []).append(r["v"])
    assert got == {k: sep.join(sorted(v)) for k, v in values.items()}
    sizes = [r["__n"] for r in text_pieces(df, "k", "v", sep, 5_000).collect()]
    assert sum(sizes) == 60_000 and len(sizes) > 8 and max(sizes) < 2 * 5_000
    assert text_pieces(few, "k", "v", sep, 5_000) is None
    assert join_long_text(few, "k", "v", "t", sep).collect() == [(2, sep.join("aab"))]
