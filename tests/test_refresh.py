"""Full refresh job: writes every dataset, and reading back equals computing directly."""

import os
import tempfile

from cohortlake.params import FIXTURE_AS_OF
from cohortlake.plans.graph import DatasetGraph
from cohortlake.plans.refresh import refresh
from cohortlake.sources.adapter import TABLES, FixtureTables
from cohortlake.sources.sink import overwrite_catalog_table, overwrite_table
from cohortlake.sources.tables import CatalogTables, TableSet, read_table
from tests.conftest import rows

SF = "/root/testdata/sf0.001"


def test_refresh_writes_all_and_matches_direct(spark):
    base = tempfile.mkdtemp(prefix="cohortlake-test-base-")
    out = tempfile.mkdtemp(prefix="cohortlake-test-out-")
    fixtures = FixtureTables(spark, SF)
    for name in TABLES:
        overwrite_table(getattr(fixtures, name), f"{base}/{name}.parquet")
    timings = refresh(spark, TableSet(spark, base), FIXTURE_AS_OF, out)
    assert len(timings) == 23
    assert len([f for f in os.listdir(out) if f.endswith(".parquet")]) == 23
    direct = DatasetGraph(fixtures, FIXTURE_AS_OF)
    for ds, name in [("d10", "d10_pbfw"), ("d07", "d07_art_outcomes")]:
        assert rows(read_table(spark, out, name)) == rows(direct.get(ds))
    # a second run swaps the tables in place
    refresh(spark, TableSet(spark, base), FIXTURE_AS_OF, out, only=["d03"])
    assert rows(read_table(spark, out, "d03_last_dispense")) == rows(direct.get("d03"))


def test_catalog_source_and_sink(spark):
    df = FixtureTables(spark, SF).ct_patient
    overwrite_catalog_table(df, "ct_patient")
    overwrite_catalog_table(df, "ct_patient")
    assert CatalogTables(spark).ct_patient.count() == df.count()


def test_bucketed_tables_need_no_exchange(spark):
    from cohortlake.plans import KEY
    from cohortlake.plans.pharmacy import last_dispense

    overwrite_catalog_table(FixtureTables(spark, SF).ct_patient_pharmacy, "ct_patient_pharmacy_b", KEY, 8)
    df = last_dispense(spark.table("ct_patient_pharmacy_b"), FIXTURE_AS_OF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert rows(df) == rows(last_dispense(FixtureTables(spark, SF).ct_patient_pharmacy, FIXTURE_AS_OF))


def test_refresh_into_bucketed_catalog(spark):
    base = tempfile.mkdtemp(prefix="cohortlake-test-base-")
    fixtures = FixtureTables(spark, SF)
    for name in TABLES:
        overwrite_table(getattr(fixtures, name), f"{base}/{name}.parquet")
    spark.sql("CREATE DATABASE IF NOT EXISTS refreshed")
    refresh(spark, TableSet(spark, base), FIXTURE_AS_OF, None, only=["d09"], database="refreshed", buckets=4)
    direct = DatasetGraph(fixtures, FIXTURE_AS_OF)
    assert rows(spark.table("refreshed.d09_latest_obs")) == rows(direct.get("d09"))


def test_refresh_resume_skips_completed_datasets(spark):
    base = tempfile.mkdtemp(prefix="cohortlake-test-base-")
    out = tempfile.mkdtemp(prefix="cohortlake-test-out-")
    fixtures = FixtureTables(spark, SF)
    for name in ["ct_patient_visits", "ct_patient_pharmacy"]:
        overwrite_table(getattr(fixtures, name), f"{base}/{name}.parquet")
    first = refresh(spark, TableSet(spark, base), FIXTURE_AS_OF, out, only=["d02", "d04"])
    assert set(first) == {"d02", "d04"} and all(v >= 0 for v in first.values())
    again = refresh(spark, TableSet(spark, base), FIXTURE_AS_OF, out, only=["d05"], resume=True)
    assert again["d02"] == -1.0 and again["d04"] == -1.0 and again["d05"] >= 0
    direct = DatasetGraph(fixtures, FIXTURE_AS_OF)
    assert rows(read_table(spark, out, "d05_last_encounter_as_at")) == rows(direct.get("d05"))
    other_day = refresh(spark, TableSet(spark, base), "2021-03-15", out, only=["d02"], resume=True)
    assert other_day["d02"] >= 0
