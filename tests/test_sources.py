import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

import acctmart as am
from acctmart.sources import require_contract


def test_load_by_path_and_override(spark, tmp_path):
    base = am.load_tables(spark, SF_DIR, ["nation", "region"])
    assert base["nation"].count() == 25
    other = str(tmp_path / "elsewhere.parquet")
    base["region"].limit(2).write.parquet(other)
    got = am.load_tables(
        spark, SF_DIR, ["nation", "region"], overrides={"region": other, "nation": base["region"]}
    )
    assert got["region"].count() == 2 and got["nation"] is base["region"]


def test_load_from_catalogs(spark):
    nation = am.load_tables(spark, SF_DIR, ["nation"])["nation"]
    spark.sql("CREATE DATABASE IF NOT EXISTS other_db")
    nation.write.mode("overwrite").saveAsTable("other_db.details")
    nation.limit(3).createOrReplaceTempView("CreditGrade")
    got = am.load_tables(
        spark, names=["CreditGrade", "Customer Details"],
        overrides={"Customer Details": "other_db.details"},
    )
    assert got["CreditGrade"].count() == 3 and got["Customer Details"].count() == 25


@pytest.mark.parametrize("fmt, options", [("parquet", {}), ("csv", {"header": "true"}), ("json", {})])
def test_formats(spark, tmp_path, fmt, options):
    region = am.load_tables(spark, SF_DIR, ["region"])["region"]
    path = str(tmp_path / f"region.{fmt}")
    am.write_extract(region, path, fmt, **options)
    back = spark.read.format(fmt).options(**options).load(path)
    assert back.count() == 5 and set(back.columns) == set(region.columns)


def test_load_other_format(spark, tmp_path):
    region = am.load_tables(spark, SF_DIR, ["region"])["region"]
    am.write_extract(region, str(tmp_path / "region.orc"), "orc")
    assert am.load_tables(spark, str(tmp_path), ["region"], fmt="orc")["region"].count() == 5


def test_missing_columns(spark):
    nation = am.load_tables(spark, SF_DIR, ["nation"])["nation"]
    assert am.require_columns(nation, ["N_NAME"], "nation") is nation
    with pytest.raises(ValueError, match="'nation' lacks columns .'n_code'"):
        am.require_columns(nation, ["n_name", "n_code"], "nation")


def test_reader_options_and_schemas(spark, tmp_path):
    region = am.load_tables(spark, SF_DIR, ["region"])["region"]
    region.select("r_regionkey", "r_name").write.option("header", True).csv(str(tmp_path / "region.csv"))
    got = am.load_tables(
        spark, str(tmp_path), ["region"], fmt="csv", options={"header": True},
        schemas={"region": "r_regionkey int, r_name string"},
    )["region"]
    assert got.dtypes == [("r_regionkey", "int"), ("r_name", "string")] and got.count() == 5


def test_bucketed_table_is_not_overwritten_unasked(spark):
    region = am.load_tables(spark, SF_DIR, ["region"])["region"]
    am.save_bucketed(region, "kept_region", "r_regionkey", 2, mode="overwrite")
    with pytest.raises(Exception, match="already exists"):
        am.save_bucketed(region, "kept_region", "r_regionkey", 2)


def test_contract_names_wrong_types(spark, book):
    wrong = {
        **book,
        "CreditGrade": book["CreditGrade"].withColumn("DateOfChange", F.lit("x")),
        "CMSHistory_TBL": book["CMSHistory_TBL"].withColumn("CMS", F.lit("9")),
    }
    with pytest.raises(TypeError, match="CMS is string, wanted is a number.*DateOfChange is string, wanted is a date"):
        require_contract(wrong)
