"""Clustered laboratory results: pruned by the reader, spread over files, same datasets."""

import pytest

from cohortlake.params import FIXTURE_AS_OF
from cohortlake.plans import labs as plans
from cohortlake.sources.adapter import FixtureTables
from cohortlake.sources.clustering import CLUSTERED, clustered, write_base_table
from cohortlake.sources.tables import read_table
from tests.conftest import rows

SF = "/root/testdata/sf0.001"
BY = CLUSTERED["ct_patient_labs"]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("clustered"))
    fixtures = FixtureTables(spark, SF)
    write_base_table(fixtures.ct_patient_labs, base, "ct_patient_labs", 8)
    write_base_table(fixtures.ct_art_patients, base, "ct_art_patients", 2)
    return read_table(spark, base, "ct_patient_labs"), read_table(spark, base, "ct_art_patients")


def datasets(labs, art):
    return {
        "d11": plans.baseline_viral_load(labs, FIXTURE_AS_OF), "d12": plans.latest_viral_load(labs, FIXTURE_AS_OF),
        "d13": plans.ordered_viral_loads(labs, FIXTURE_AS_OF), "d14": plans.viral_load_intervals(labs, art, FIXTURE_AS_OF),
        "d15": plans.latest_diabetes_test(labs),
    }


def scanned(spark, df):
    """Rows that come out of the scan of the laboratory results."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df._jdf.collectToPython()
        leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
        scans = [leaves.apply(i) for i in range(leaves.size())]
        return sum(s.metrics().apply("numOutputRows").value() for s in scans if "test_name" in s.toString() or "test_key" in s.toString())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_same_datasets_with_and_without_the_key(tables):
    labs, art = tables
    for name, df in datasets(labs, art).items():
        assert rows(df) == rows(datasets(labs.drop(BY.key), art)[name]), name


@pytest.mark.parametrize("name", ["d11", "d12", "d13", "d14", "d15"])
def test_the_reader_gets_the_family_and_skips_the_rest(spark, tables, name):
    labs, art = tables
    df = datasets(labs, art)[name]
    pushed = [line for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if "PushedFilters" in line and BY.key in line]
    assert pushed and all(f"({BY.key}," in line.split("PushedFilters")[1] for line in pushed)
    share = scanned(spark, datasets(labs, art)[name]) / labs.count()
    assert scanned(spark, datasets(labs.drop(BY.key), art)[name]) >= labs.count()
    assert share < (0.5 if name == "d15" else 0.8)  # viral loads are over half of the rows


def test_a_common_family_is_spread_over_files(spark):
    hot = spark.range(9000).selectExpr("'viral load ' as test_name", "id % 7 as site_code", "id as patient_pk")
    rare = spark.range(1000).selectExpr("concat('Test', id % 50) as test_name", "1 as site_code", "id as patient_pk")
    sizes = [r["count"] for r in clustered(hot.unionByName(rare), BY, 10).selectExpr("spark_partition_id() as p").groupBy("p").count().collect()]
    assert len(sizes) == 10 and max(sizes) < 2500


def test_a_key_column_that_is_wrong_is_made_anew(spark):
    df = spark.createDataFrame([("Viral load  ", "x", 1, 2)], "test_name string, test_key string, site_code int, patient_pk long")
    assert clustered(df, BY, 1).first()["test_key"] == "VIRAL LOAD"
