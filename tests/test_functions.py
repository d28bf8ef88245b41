import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from acctmart import functions as R


def values(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def one(spark, items, kind, column):
    return [r[0] for r in values(spark, [(i,) for i in items], f"x {kind}", column)]


def test_reference_parts(spark):
    texts = ["L7-X-02", "L7-", "-9", "NOREF", "", None]
    got = values(spark, [(t,) for t in texts], "x string", *R.split_reference("x"))
    assert got == [("L7", "02"), ("L7", ""), ("", "9"), (None, None), (None, None), (None, None)]


def test_strict_reference(spark):
    assert one(spark, ["a-b", None], "string", R.after_last("x", strict=True)) == ["b", None]
    with pytest.raises(PySparkException, match="no '-' in reference: NOREF"):
        one(spark, ["NOREF"], "string", R.before_first("x", strict=True))


def test_account_number(spark):
    rows = [
        ("77", "C1-1"), ("77", "C1-12"), ("77", "C1-123"), ("77", "C1-"), ("77", "C99"),
        ("77", None), (None, "C1-5"), (None, None), ("77", "C1-5-6"),
    ]
    got = values(spark, rows, "a string, r string", R.account_number("a", "r"))
    assert [g[0] for g in got] == [
        "0000007701", "0000007712", "0000007712", "0000007700", "00000077C9",
        "00000077", "00000005", "000000", "000000775-",
    ]


def test_recode_prefix(spark):
    codes = {"URI_%": "1", "UFA_%": "2"}
    texts = ["URI_12", "URIX12", "UFA_9 ", "URI", "77", "uri_5", None]
    got = one(spark, texts, "string", R.recode_prefix("x", codes))
    assert got == ["112", "112", "29", "URI", "77", "uri_5", None]
    got = one(spark, ["uri_5", "ufa_Q"], "string", R.recode_prefix("x", codes, ci=True))
    assert got == ["15", "2Q"]


def test_text_comparison(spark):
    rows = [("Abc ", "aBC"), ("abc", "abd"), (None, "a")]
    got = values(
        spark, rows, "a string, b string", R.same_text("a", "b"), R.same_text("a", "b", ci=True)
    )
    assert got == [(False, True), (False, False), (None, None)]
    assert one(spark, ["ab  ", " a", "", None], "string", R.text_length("x")) == [2, 2, 0, None]


def test_concat_blank(spark):
    got = values(spark, [("a", None, 3)], "a string, b string, c int", R.concat_blank("a", "b", "c"))
    assert got == [("a3",)]


def test_days_since_counts_midnights(spark):
    stamps = [dt.datetime(2000, 1, 30, 23, 0), dt.datetime(2000, 2, 2, 1, 0), None]
    assert one(spark, stamps, "timestamp", R.days_since("x", "2000-01-31")) == [1, -2, 0]
    got = one(spark, stamps, "timestamp", R.days_since("x", "2000-01-31", null_value=None))
    assert got[2] is None


def test_month_boundaries(spark):
    d = dt.date
    rows = [
        (d(2000, 1, 31), d(2000, 2, 1)), (d(2000, 1, 15), d(2000, 2, 14)),
        (d(2000, 2, 1), d(1999, 12, 31)), (d(2000, 1, 1), d(2000, 1, 31)), (None, d(2000, 1, 1)),
    ]
    got = values(spark, rows, "a date, b date", R.month_boundaries("a", "b"))
    assert [g[0] for g in got] == [1, 1, -2, 0, None]


@pytest.mark.parametrize(
    "as_of, expected",
    [
        (
            "2000-01-31",
            {1: "2000-02-01", 15: "2000-02-15", 16: "2000-02-16", 29: "2000-02-29",
             30: "2000-02-29", 31: "2000-01-31", None: None, 0: "2000-01-31"},
        ),
        (
            "2000-02-15",
            {1: "2000-03-01", 15: "2000-02-15", 16: "2000-02-16", 29: "2000-02-29",
             30: "2000-02-29", 31: "2000-02-29", None: None},
        ),
        ("2001-12-20", {19: "2002-01-19", 20: "2001-12-20", 31: "2001-12-31"}),
    ],
)
def test_next_due_date(spark, as_of, expected):
    got = one(spark, list(expected), "int", R.iso_date(R.next_due_date("x", as_of)))
    assert got == list(expected.values())


def test_as_of_forms(spark):
    forms = ["2000-01-31", dt.date(2000, 1, 31), dt.datetime(2000, 1, 31, 9), F.lit("2000-01-31")]
    row = spark.range(1).select(*[R.month_start(f, 1).alias(f"m{i}") for i, f in enumerate(forms)])
    assert set(row.first()) == {dt.date(2000, 2, 1)}


def test_fixed2(spark):
    numbers = [D("2.345"), D("1234567.125"), D("-0.001"), D("-2.345"), D("0"), None]
    got = one(spark, numbers, "decimal(18,6)", R.fixed2("x"))
    assert got == ["2.35", "1,234,567.13", "0.00", "-2.35", "0.00", None]
    got = one(spark, [D("0.023450"), D("0.000050"), D("12.345650")], "decimal(9,6)", R.percent_text("x"))
    assert got == ["2.35", "0.01", "1,234.57"]
    # rounded once, whatever the scale
    got = one(spark, [D("0.0234499999"), D("0.0234500000")], "decimal(18,10)", R.percent_text("x"))
    assert got == ["2.34", "2.35"]
    got = one(spark, [0.0234499999, 0.02345, 1.5e-7, None], "double", R.percent_text("x"))
    assert got == ["2.34", "2.35", "0.00", None]


def test_int_text(spark):
    got = one(spark, [D("2.50"), D("-2.50"), D("0.49"), None], "decimal(10,2)", R.int_text("x"))
    assert got == ["3", "-3", "0", None]


def test_flags_and_defaults(spark):
    assert one(spark, [-3, 0, 5, None], "int", R.clamp_min("x")) == [0, 0, 5, None]
    assert one(spark, [1, 0, None], "int", R.flag_yn(F.col("x") == 1)) == ["Y", "N", "N"]
    assert one(spark, ["a", None], "string", R.or_default("x", "z")) == ["a", "z"]


def test_raise_if(spark):
    check = R.raise_if(F.col("x") > 5, "too large", F.col("x"))
    assert one(spark, [1, None], "int", check) == [1, None]
    with pytest.raises(PySparkException, match="too large"):
        one(spark, [1, 6], "int", check)
