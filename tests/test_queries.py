"""Every registered query against its SQL check on the smallest test tables."""

import pytest

import __spark_entry__ as entry_point
from workload.oracles import ORACLES
from workload.queries import QUERIES
from conftest import SF_DIR
from workload.compare import connect, differences


@pytest.fixture(scope="module")
def database():
    return connect(SF_DIR)


def test_every_query_has_a_check():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_point.queries()) and set(ORACLES) <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, database, name):
    df = entry_point.queries()[name](spark, SF_DIR)
    assert differences(df, database, entry_point.oracle_sql()[name]) == []


def test_differences_are_seen(spark, database):
    df = spark.sql("SELECT 1 AS a, 2.0D AS b UNION ALL SELECT 1, NULL")
    assert differences(df, database, "SELECT 2.0 AS b, 1 AS a UNION ALL SELECT NULL, 1") == []
    assert differences(df, database, "SELECT 2.5 AS b, 1 AS a UNION ALL SELECT NULL, 1")
    assert differences(df, database, "SELECT 2.0 AS b, 1 AS a")
    assert differences(df, database, "SELECT 2.0 AS c, 1 AS a")
