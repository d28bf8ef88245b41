"""What the planner makes of the operators."""

import re

import pytest
from conftest import executed_plan
from pyspark.sql import functions as F

import acctmart as am

UNWANTED = (
    "BroadcastNestedLoopJoin", "CartesianProduct", "PythonUDF", "BatchEvalPython",
    "ArrowEvalPython", "LeftSingle",
)


@pytest.fixture
def static(conf):
    """Plans as for large tables: no broadcast by size, nothing decided at run time."""
    conf(
        spark__sql__adaptive__enabled="false",
        spark__sql__autoBroadcastJoinThreshold="-1",
    )


@pytest.fixture(scope="module")
def stored(spark, book, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("plans"))
    for name, df in book.items():
        df.write.parquet(f"{base}/{name}.parquet")
    return base


def exchanges(plan: str) -> int:
    return len(re.findall(r"Exchange (?:hash|range|shuffle)\w*", plan))


def test_extract_plan(spark, stored, static):
    plan = executed_plan(am.build_extract(am.load_tables(spark, stored), "2000-01-31"))
    assert not [word for word in UNWANTED if word in plan]
    # newest-row windows drop rows before and after the shuffle
    assert plan.count("WindowGroupLimit") == 2 * plan.count("Window [row_number()")
    # one shuffle per input of the chain; no further one of the growing wide row
    wide = [
        line for line in plan.split("\n")
        if "Exchange hashpartitioning(CaseID" in line
    ]
    assert len(wide) == 19  # one per side: the picks, dates, texts and flags of a table share theirs
    assert "MissedOrLatePayments" not in plan


def test_extract_compiles(spark, stored, static):
    """Every generated method stays below the size that the JVM compiles."""
    df = am.build_extract(am.load_tables(spark, stored), "2000-01-31")
    debug = getattr(
        getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$"
    )
    parts = debug.codegenStringSeq(df._jdf.queryExecution().executedPlan())
    sizes = [parts.apply(i)._3().maxMethodCodeSize() for i in range(parts.size())]
    assert len(sizes) > 50 and 0 < max(sizes) < 8000


def test_scans_read_only_needed_columns(spark, stored, static):
    plan = executed_plan(am.build_extract(am.load_tables(spark, stored), "2000-01-31"))
    schemas = re.findall(r"ReadSchema: struct<(.*?)>", plan)
    assert "CaseID:bigint,FacilitatorTypeID:int" in schemas
    assert "CaseID:bigint,CMS Month:date,CMS:decimal(18,2)" in schemas
    paid = [line for line in plan.split("\n") if "Payments received" in line and "FileScan" in line]
    assert len(paid) == 1
    assert "PushedFilters: [IsNotNull(`Month end`), GreaterThanOrEqual(`Month end`,1999-01-01), LessThan(`Month end`,1999-11" in paid[0]
    mandates = [line for line in plan.split("\n") if "NextCollection" in line and "FileScan" in line]
    # one scan for the newest active mandate and the declared one, which may have any status
    assert len(mandates) == 1 and "EqualTo(DDStatusID,2)" not in mandates[0]


def test_naive_lookup_would_not_shuffle(spark, stored, static):
    """Why the month lookup is an aggregate: as a subquery per row it has no shuffled form."""
    t = am.load_tables(spark, stored)
    naive = spark.sql(
        """SELECT CaseID, (SELECT `Payments received` FROM {p} p WHERE p.CaseID = c.CaseID
           AND date_format(p.`Month end`, 'yyyy-M') = '1999-10') AS v FROM {c} c""",
        p=t["ReceivedDue_TBL"], c=t["Case_TBL"],
    )
    assert "LeftSingle" in executed_plan(naive)
    pivot = am.month_offset_pivot(
        t["ReceivedDue_TBL"], "CaseID", "Month end", "Payments received", "2000-01-31", [3], "v"
    )
    plan = executed_plan(am.attach(t["Case_TBL"], pivot, "CaseID"))
    assert "LeftSingle" not in plan and exchanges(plan) == 2


def test_chain_adds_one_shuffle_per_side(spark, stored, static):
    t = am.load_tables(spark, stored)
    df = t["Case_TBL"].select("CaseID")
    df = am.attach(df, am.latest_per_key(t["CMSHistory_TBL"], "CaseID", "CMS Month", tie_break="-CMS"), "CaseID")
    df = am.has_related(df, t["Facilitator"], "CaseID", "f")
    df = am.count_related(df, t["AraHistory"], "CaseID", "n")
    df = am.attach(df, am.join_text(t["Applicant_TBL"], "CaseID", "Surname", "names"), "CaseID")
    assert exchanges(executed_plan(df)) == 5


def test_existence_reads_keys_only(spark, stored, static):
    t = am.load_tables(spark, stored)
    df = am.has_related(t["Case_TBL"].select("CaseID"), t["Facilitator"], "CaseID", "f")
    plan = executed_plan(df)
    assert "ReadSchema: struct<CaseID:bigint>" in plan and exchanges(plan) == 2


def test_bucketed_tables_join_without_shuffle(spark, stored, static):
    t = am.load_tables(spark, stored)
    for name in ("Case_TBL", "CMSHistory_TBL"):
        am.save_bucketed(t[name], f"bucketed_{name}", "CaseID", 4)
    cases, history = spark.table("bucketed_Case_TBL"), spark.table("bucketed_CMSHistory_TBL")
    newest = am.latest_per_key(history, "CaseID", "CMS Month", tie_break="-CMS")
    df = am.attach(cases, newest, "CaseID")
    assert exchanges(executed_plan(df)) == 0
    plain = am.latest_per_key(t["CMSHistory_TBL"], "CaseID", "CMS Month", tie_break="-CMS")
    want = am.attach(t["Case_TBL"], plain, "CaseID").select(df.columns)
    assert df.exceptAll(want).isEmpty() and want.exceptAll(df).isEmpty()


def test_extract_over_bucketed_tables(spark, stored, conf):
    """Stored by key, the tables meet without a shuffle; joins on other keys keep theirs."""
    conf(spark__sql__adaptive__enabled="false", spark__sql__autoBroadcastJoinThreshold="-1")
    plain = am.load_tables(spark, stored)
    keyed = {}
    for name, df in plain.items():
        key = next((k for k in ("CaseID", "SecurityID") if k in df.columns), None)
        if key:
            am.save_bucketed(df, f"by_key_{name}", key, 8)
            keyed[name] = spark.table(f"by_key_{name}")
    df = am.build_extract({**plain, **keyed}, "2000-01-31")
    shuffles = exchanges(executed_plan(df))
    assert shuffles == 13 < exchanges(executed_plan(am.build_extract(plain, "2000-01-31")))


def test_dimension_is_broadcast_only_if_small(spark, stored, static):
    t = am.load_tables(spark, stored)
    small = executed_plan(am.attach_dimension(t["Rate_TBL"], t["Index_TBL"], "IndexID"))
    assert "BroadcastHashJoin" in small
    large = executed_plan(am.attach_dimension(t["Rate_TBL"], t["Index_TBL"], "IndexID", fits=False))
    assert "SortMergeJoin" in large and "Broadcast" not in large


def hot_frame(spark, n):
    """A third of the rows on one key, a third without a key."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, None).otherwise(F.col("id") % 997)
    return spark.range(0, n, 1, 8).select("id", key.alias("k"))


def test_hot_keys_are_split(spark, conf):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__shuffle__partitions="40",
        spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="50KB",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="50KB",
    )
    n = 300_000
    names = am.any_per_key(
        spark.range(0, 4000, 1, 4).select((F.col("id") % 1000).alias("k"), F.col("id").alias("v")),
        "k", tie_break="v",
    )
    joined = am.attach_spread(hot_frame(spark, n), names, "k").withColumn("p", F.spark_partition_id())
    by_task = joined.groupBy("p").agg(F.count("id"), F.max(F.xxhash64("id", "v")))
    sizes = [r[1] for r in by_task.collect()]
    assert sum(sizes) == n
    # neither the hot key nor the rows without key land in one task
    assert max(sizes) < n / 6
    plan = am.attach_spread(hot_frame(spark, n), names, "k")
    plan.collect()
    assert "skew=true" in executed_plan(plan)


def test_hot_right_key_is_split(spark, conf):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__shuffle__partitions="40",
        spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="50KB",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="50KB",
    )
    n = 300_000
    cases = spark.range(0, 2000, 1, 4).select(F.col("id").alias("k"))
    rows = hot_frame(spark, n).where("k IS NOT NULL")
    joined = am.attach_fan_out(cases, rows, "k").withColumn("p", F.spark_partition_id())
    by_task = joined.groupBy("p").agg(F.count(F.lit(1)), F.max(F.xxhash64("id", "k")))
    sizes = [r[1] for r in by_task.collect()]
    assert sum(sizes) == rows.count() + 2000 - rows.select("k").distinct().count()
    assert max(sizes) < n / 6


def test_hot_key_leaves_few_rows_to_shuffle(spark, static):
    """A key with a third of the rows brings one row per task into the final window."""
    df = hot_frame(spark, 30_000).withColumn("d", F.col("id") % 50)
    newest = am.latest_per_key(df, "k", "d", tie_break="id")
    plan = executed_plan(newest)
    assert plan.index("WindowGroupLimit") < plan.index("Exchange hashpartitioning(k")
    assert re.search(r"Exchange hashpartitioning\(k.*\n.*WindowGroupLimit.*Partial", plan)
    got = {r.k: (r.d, r.id) for r in newest.collect()}
    want = {}
    for r in df.collect():
        rank = (-r.d, r.id)
        want[r.k] = min(want.get(r.k, rank), rank)
    assert got == {k: (-d, i) for k, (d, i) in want.items()}
