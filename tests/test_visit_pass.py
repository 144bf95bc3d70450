"""The fused pass over the visits: same datasets, one exchange of visits."""

import random

import pytest

from cohortlake.params import FIXTURE_AS_OF
from cohortlake.plans import pbfw, pregnancy, visit_pass, visits
from cohortlake.plans.graph import DatasetGraph
from cohortlake.sources.adapter import FixtureTables
from tests.conftest import rows

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def graphs(spark, tmp_path_factory):
    path = f"{tmp_path_factory.mktemp('pass')}/candidates"
    tables = FixtureTables(spark, SF)
    visit_pass.candidates(tables.ct_patient_visits, FIXTURE_AS_OF).write.parquet(path)
    found = spark.read.parquet(path)
    return DatasetGraph(tables, FIXTURE_AS_OF), DatasetGraph(tables, FIXTURE_AS_OF, visit_candidates=found)


@pytest.mark.parametrize("ds", sorted(visit_pass.USES))
def test_datasets_from_candidates_equal_those_from_all_visits(graphs, ds):
    plain, fused = graphs
    assert rows(fused.get(ds)) == rows(plain.get(ds))


def test_one_exchange_below_a_partial_limit(spark):
    plan = visit_pass.candidates(FixtureTables(spark, SF).ct_patient_visits, FIXTURE_AS_OF)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("hashpartitioning(site_code") == 1 and "Partial" in text.split("hashpartitioning(site_code")[1]


def test_null_dates_ids_ties_and_repeated_rows(spark):
    import datetime as dt
    rng = random.Random(11)
    day = lambda: rng.choice([None, dt.date(2020, 1, 1) + dt.timedelta(days=rng.randint(0, 9))])
    given = [(f"P{pk}", 1, pk, f"H{pk}", f"I{pk}", rng.choice([None, 1, 2, 3]), day(), rng.choice([None, "Yes", "yes ", "Y", "No"]), rng.choice([None, "Yes", "No"]),
              rng.choice([None, 50.0]), rng.choice([0, 0, 1])) for pk in range(60) for _ in range(rng.randint(1, 6))]
    df = spark.createDataFrame(given + given[:20], "patient_id string, site_code int, patient_pk bigint, patient_pk_hash string, patient_id_hash string, visit_id bigint, "
                               "visit_date date, pregnant string, breastfeeding string, weight double, voided int").selectExpr("*", "1.5D as height", "'x' as visit_by")
    found = visit_pass.candidates(df, "2020-02-01")
    art = spark.createDataFrame([(1, pk, dt.date(1990, 1, 1), dt.date(2020, 1, 1)) for pk in range(0, 60, 2)], "site_code int, patient_pk bigint, dob date, last_visit date")
    first = lambda d: pbfw.first_pregnant_or_breastfeeding_visit(d, art)
    assert rows(first(df)) == rows(first(visit_pass.of_kind(found, "first_pregnant", "first_pregnant_or_breastfeeding")))
    dated = lambda d: visits.latest_weight_height(d, "2020-02-01").select("patient_pk", "visit_date", "visit_id")
    assert rows(dated(df)) == rows(dated(visit_pass.of_kind(found, "newest_weighed")))
    woman = spark.createDataFrame([(1, pk, "Female") for pk in range(60)], "site_code int, patient_pk bigint, gender string").selectExpr(
        "*", "0 as voided", "'a' as patient_id", "'b' as patient_pk_hash", "'c' as patient_id_hash", "DATE'2020-01-01' as registration_at_ccc")
    tx = art.selectExpr("*", "0 as voided", "DATE'2020-01-02' as start_art_date")
    during = lambda d: pregnancy.pregnancy_during_art(d, woman, tx, "2020-02-01")
    assert rows(during(df)) == rows(during(visit_pass.of_kind(found, "first_pregnant_live")))
    assert {r[visit_pass.KIND] for r in found.collect()} == set(visit_pass.kinds("2020-02-01"))


def test_only_the_wanted_kinds(spark):
    found = visit_pass.candidates(FixtureTables(spark, SF).ct_patient_visits, FIXTURE_AS_OF, ["newest"])
    assert {r[0] for r in found.select(visit_pass.KIND).distinct().collect()} == {"newest"}
