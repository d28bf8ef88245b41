"""What keeps the extract within memory, disk and time on large tables."""

import os
import re
import subprocess
import sys
import time
from collections import Counter

import pytest
from conftest import ROOT, executed_plan
from pyspark.sql import functions as F

import acctmart as am
from acctmart.operators.stored import stored_parts
from acctmart.plans.extract import HISTORY_DAYS

AS_OF = "2000-01-31"


@pytest.fixture(scope="module")
def tables(spark, book, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("scale"))
    for name, df in book.items():
        df.write.parquet(f"{base}/{name}.parquet")
    return am.load_tables(spark, base)


@pytest.fixture
def static(conf):
    conf(spark__sql__adaptive__enabled="false", spark__sql__autoBroadcastJoinThreshold="-1")


def shuffles(plan: str) -> int:
    return len(re.findall(r"Exchange (?:hash|range|shuffle)\w*", plan))


def test_the_chain_holds_few_sorts_at_once(tables, static):
    """A sorted side holds a page to the end of the task; twenty of them are more than a task may have."""
    plan = executed_plan(am.build_extract(tables, AS_OF))
    assert len(re.findall(r"ShuffledHashJoin \[CaseID", plan)) == 13
    assert len(re.findall(r"SortMergeJoin \[CaseID", plan)) == 4


def test_cases_without_very_many_rows_are_not_shuffled_again(tables, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    plain = shuffles(executed_plan(am.build_extract(tables, AS_OF)))
    told = shuffles(executed_plan(am.build_extract(tables, AS_OF, repeated_cases=True)))
    # the sides of two joins that bring the ranges to the cases, and none of a row that has grown
    assert told <= plain + 4


@pytest.mark.parametrize("ordered", [True, False])
def test_only_cases_with_very_many_rows_are_spread(tables, ordered):
    rates = tables["Rate_TBL"]
    case = rates.agg(F.min("CaseID")).first()[0]
    more = rates.where(F.col("CaseID") == case).withColumn("i", F.explode(F.sequence(F.lit(1), F.lit(90))))
    days = F.date_add(F.lit("2001-01-01"), (F.col("i") % 45).cast("int"))
    odd = {**tables, "Rate_TBL": rates.union(more.withColumn("Period 1 end", days).drop("i"))}
    plain = Counter(am.build_extract(odd, AS_OF, repeated_cases=False, ordered=False).collect())
    split = am.build_extract(odd, AS_OF, hot_case_rows=50, ordered=ordered)
    rows = split.collect()
    assert Counter(rows) == plain
    if ordered:
        assert [r.ACC_NO for r in rows] == sorted(r.ACC_NO for r in rows)
    one = am.build_extract(odd, AS_OF, hot_case_rows=10_000, repeated_cases=True, ordered=ordered).collect()
    assert Counter(one) == plain


@pytest.mark.parametrize("ordered", [True, False])
def test_cases_taken_in_passes_give_the_same_rows(tables, ordered):
    rates = tables["Rate_TBL"]
    case = rates.agg(F.min("CaseID")).first()[0]
    more = rates.where(F.col("CaseID") == case).withColumn("i", F.explode(F.sequence(F.lit(1), F.lit(90)))).drop("i")
    odd = {**tables, "Rate_TBL": rates.union(more)}
    # dates from before the calendar's reform, and far ones, come back from the files
    days = F.when(F.col("CaseID") % 3 == 0, F.lit("1450-02-03")).when(F.col("CaseID") % 3 == 1, F.lit("9999-12-31"))
    odd["CaseInformation"] = odd["CaseInformation"].withColumn("MaturityDate", days.cast("date"))
    odd["Loan_TBL"] = odd["Loan_TBL"].withColumn("Purpose", F.lit(None)).withColumn("Currency", F.lit(None))
    plain = am.build_extract(odd, AS_OF, repeated_cases=False, ordered=False)
    want = Counter(plain.collect())
    # two passes over nine histories and the applicants
    held = sum(odd[name].count() for name in (*HISTORY_DAYS, "Applicant_TBL")) // 2 + 1
    for told in ({"repeated_cases": False}, {"hot_case_rows": 50}) if ordered else ({"repeated_cases": None},):
        df = am.build_extract(odd, AS_OF, ordered=ordered, pass_rows=held, **told)
        assert "parts-" in " ".join(df.inputFiles()) and df.dtypes == plain.dtypes
        rows = df.collect()
        assert Counter(rows) == want
        if ordered:
            assert [r.ACC_NO for r in rows] == sorted(r.ACC_NO for r in rows)


@pytest.mark.parametrize("options", [{"ci": True}, {"as_of": "2000-02-15"}, {"as_of": "1998-09-15", "point_in_time": True}])
def test_options_hold_in_passes(tables, options):
    options = {"as_of": AS_OF, **options}
    whole = Counter(am.build_extract(tables, ordered=False, **options).collect())
    held = sum(tables[name].count() for name in (*HISTORY_DAYS, "Applicant_TBL")) // 3
    df = am.build_extract(tables, pass_rows=held, **options)
    assert "parts-" in " ".join(df.inputFiles()) and Counter(df.collect()) == whole


def test_a_failing_rule_fails_a_pass(tables):
    twice = {**tables, "CaseInformation": tables["CaseInformation"].union(tables["CaseInformation"])}
    with pytest.raises(Exception, match="more than one row for"):
        am.build_extract(twice, AS_OF, expect_unique=True, pass_rows=1_000)


def test_shuffles_of_a_part_are_given_back(spark):
    """Only those of the running part are held, however many parts there are."""
    statuses = spark._jsc.sc().env().mapOutputTracker().shuffleStatuses
    held = []

    def part(i):
        time.sleep(2)  # the cleaner runs beside the session
        held.append(statuses().size())
        return spark.range(1000).groupBy((F.col("id") % 7 + i).alias("k")).count().repartition(3, "count")

    rows = stored_parts(spark, part, 5)
    assert rows.count() == 35
    assert max(held[1:]) <= held[1] + 1, held


def test_files_of_parts_go_at_the_end_of_the_session(tmp_path):
    code = f"""
from pyspark.sql import SparkSession
from acctmart.operators.stored import stored_parts
conf = {{"spark.ui.enabled": "false", "spark.checkpoint.dir": "{tmp_path}", "spark.driver.host": "127.0.0.1"}}
spark = SparkSession.builder.master("local[1]").config(map=conf).getOrCreate()
print(stored_parts(spark, lambda i: spark.range(i + 1), 2).inputFiles(), flush=True)
"""
    env = {k: v for k, v in os.environ.items() if not k.startswith("PYSPARK_GATEWAY")} | {"PYTHONPATH": ROOT}
    ran = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=120)
    assert "parts-" in ran.stdout, ran.stderr[-2000:]
    for _ in range(60):  # the JVM ends after Python
        if not list(tmp_path.rglob("parts-*")):
            break
        time.sleep(0.5)
    assert not list(tmp_path.rglob("parts-*"))


def test_days_and_flags_are_not_shuffled_as_texts(tables, conf):
    conf(spark__sql__debug__maxToStringFields="200")
    plan = am.build_extract(tables, AS_OF)._jdf.queryExecution().optimizedPlan().toString()
    last = next(line for line in plan.split("\n") if "Project" in line)
    assert last.count("cast(") >= 16 and "THEN Y ELSE N" in last
