"""Whole results on data where one key holds a third of the rows."""

import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from workload.compare import TABLES, connect, differences


@pytest.fixture(scope="module")
def hot_dir(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("hot"))
    pick = F.pmod(F.xxhash64("*"), F.lit(3))
    hot = {
        "orders": {"o_custkey": (0, 7)},
        "lineitem": {"l_orderkey": (0, 7), "l_partkey": (1, 5), "l_suppkey": (2, 4)},
        "events": {"user_id": (0, 3)},
    }
    for name in TABLES:
        df = spark.read.parquet(f"{SF_DIR}/{name}.parquet").withColumn("pick", pick)
        for column, (part, key) in hot.get(name, {}).items():
            value = F.when(F.col("pick") == part, F.lit(key).cast("long")).otherwise(F.col(column))
            df = df.withColumn(column, value)
        df.drop("pick").write.parquet(f"{base}/{name}.parquet")
    return base


@pytest.fixture(scope="module")
def database(hot_dir):
    return connect(hot_dir)


@pytest.mark.parametrize(
    "name",
    [
        "latest_order_per_customer",
        "customer_latest_order_wide",
        "order_line_inner",
        "recoded_key_join",
        "returnflags_text",
        "supplier_names_text",
        "related_count",
        "open_latest_line_flag",
        "last_payment_lookup",
        "month_offset_pivot_largest",
        "litigation_dates",
        "secured_flag",
        "account_extract",
    ],
)
def test_hot_keys_keep_results_whole(spark, database, hot_dir, name):
    df = entry_point.queries()[name](spark, hot_dir)
    assert differences(df, database, entry_point.oracle_sql()[name]) == []
