"""Swaps that fail, table readers and timestamped inputs."""

import datetime as dt

import pytest

from cohortlake.functions import lenient_number
from cohortlake.operators import follow_up_in_window
from cohortlake.plans import KEY, pbfw
from cohortlake.plans.hts_prep import encounter_hts_tests, latest_prep_assessment, prep_refills
from cohortlake.plans.schema import RISK_TEXT_COLUMNS
from cohortlake.sources import sink
from cohortlake.sources.tables import JdbcTables, TableSet

AS_OF = "2021-02-15"
T = dt.datetime


def test_a_failing_rename_keeps_the_old_table(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/t.parquet"
    sink.overwrite_table(spark.range(3), path)
    real = sink._rename

    def fails_on_the_new_table(fs, source, target):
        if "_staging" in source.toString():
            raise OSError("no")
        real(fs, source, target)

    monkeypatch.setattr(sink, "_rename", fails_on_the_new_table)
    with pytest.raises(OSError):
        sink.overwrite_table(spark.range(9), path)
    assert spark.read.parquet(path).count() == 3
    monkeypatch.setattr(sink, "_rename", real)
    sink.overwrite_table(spark.range(9), path)
    assert spark.read.parquet(path).count() == 9


def test_a_swap_that_ended_halfway_is_taken_up_again(spark, tmp_path):
    path = f"{tmp_path}/t.parquet"
    spark.range(3).write.parquet(f"{path}._previous")  # the run died between its two renames
    sink.overwrite_table(spark.range(5), path)
    assert spark.read.parquet(path).count() == 5


def test_a_rename_that_returns_false_raises(spark, tmp_path):
    fs, p, jvm = sink._fs(spark, f"{tmp_path}/absent")
    with pytest.raises((OSError, Exception)):
        sink._rename(fs, p, jvm.org.apache.hadoop.fs.Path(f"{tmp_path}/other"))


def test_a_failing_catalog_rename_keeps_the_old_table(spark, monkeypatch):
    sink.overwrite_catalog_table(spark.range(3), "swapped")
    real = sink._alter

    def fails_on_the_new_table(s, source, target):
        if source.endswith("__staging"):
            raise RuntimeError("no")
        real(s, source, target)

    monkeypatch.setattr(sink, "_alter", fails_on_the_new_table)
    with pytest.raises(RuntimeError):
        sink.overwrite_catalog_table(spark.range(9), "swapped")
    assert spark.table("swapped").count() == 3


def test_a_view_is_switched_in_one_step(spark):
    sink.overwrite_catalog_table(spark.range(3), "switched", view=True)
    sink.overwrite_catalog_table(spark.range(4), "switched", view=True)
    assert spark.table("switched").count() == 4


def test_tables_are_listed_once_and_schemas_are_checked(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/t.parquet")
    tables = TableSet(spark, str(tmp_path))
    assert tables.t is tables.t
    strict = TableSet(spark, str(tmp_path), {"t": spark.createDataFrame([], "id string").schema})
    assert strict.t.schema["id"].dataType.simpleString() == "string"
    with pytest.raises(Exception):
        strict.t.collect()


def test_jdbc_tables_need_bounds(spark):
    tables = JdbcTables(spark, "jdbc:none", {}, bounds={"a": (1, 9)})
    with pytest.raises(ValueError, match="no bounds"):
        tables.b


def test_a_timestamped_event_is_found_and_kept(spark):
    events = spark.createDataFrame([(1, T(2020, 3, 3, 14, 30)), (1, T(2020, 3, 9, 0, 0))], "k int, at timestamp")
    anchors = spark.createDataFrame([(1, T(2020, 1, 1, 23, 59))], "k int, start timestamp")
    got = follow_up_in_window(events, anchors, ["k"], "at", "start", 60, 67).collect()
    assert [(r.at, r.start) for r in got] == [(T(2020, 3, 3, 14, 30), T(2020, 1, 1, 23, 59))]


@pytest.mark.parametrize("kind", ["date", "timestamp"])
def test_refills_and_tests_with_a_time_of_day(spark, kind):
    def at(y, m, d):
        return T(y, m, d, 14, 0) if kind == "timestamp" else dt.date(y, m, d)

    patients = spark.createDataFrame([("P", "h", 1, "x", at(2020, 1, 1), 5)], f"prep_number string, prep_number_hash string, patient_pk long, patient_pk_hash string, prep_enrollment_date {kind}, site_code int")
    refills = spark.createDataFrame([("P", 1, 5, 1, at(2020, 2, 2)), ("P", 1, 5, 2, at(2020, 4, 5))], f"prep_number string, patient_pk long, site_code int, dispense_id long, dispense_date {kind}")
    tests = spark.createDataFrame([(1, 5, at(2020, 4, 5), "Negative")], f"patient_pk long, site_code int, test_date {kind}, final_test_result string")
    r = prep_refills(patients, refills, tests, AS_OF).first()
    assert (r.refil1_diff_in_days, r.refil3_diff_in_days, r.test_results_month3) == (32, 95, "Negative")


def test_a_test_later_on_the_reporting_day_is_reported(spark):
    from cohortlake.plans.hts_prep import HTS_COLUMNS

    kinds = {"test_date": "timestamp", "encounter_id": "long", "patient_pk": "long", "site_code": "int"}
    row = {"test_date": T(2021, 2, 15, 18, 0), "encounter_id": 1, "patient_pk": 1, "site_code": 1, "final_test_result": "Negative"}
    df = spark.createDataFrame([tuple(row.get(c) for c in HTS_COLUMNS)], ", ".join(f"{c} {kinds.get(c, 'string')}" for c in HTS_COLUMNS))
    assert encounter_hts_tests(df, AS_OF).count() == 1


def test_long_partner_numbers_with_the_same_start_get_different_hashes(spark):
    columns = ["patient_pk long", "patient_pk_hash string", "site_code int", "visit_date date", "visit_id long", "hiv_partner_ccc_number string", "hiv_partner_art_start_date date", "client_risk string"]
    rows = [(i, "h", 1, dt.date(2020, 1, 1), 1, "CCC-" + "0" * 40 + str(i), None, "Risk", *[None] * len(RISK_TEXT_COLUMNS)) for i in range(5)]
    df = spark.createDataFrame(rows, ", ".join([*columns, *(f"{c} string" for c in RISK_TEXT_COLUMNS)]))
    assert latest_prep_assessment(df, AS_OF).select("hiv_partner_ccc_number_hash").distinct().count() == 5


def test_bad_gestation_texts_are_unknown_and_do_not_end_the_job(spark):
    day = dt.date(2020, 12, 1)
    texts = ["4000000000", "1e12", "1e400", "-1e300", "abc", None, "10"]
    obs = spark.createDataFrame([(i, 1, "h", "Yes", None, day, t) for i, t in enumerate(texts)],
                                "patient_pk long, site_code int, patient_pk_hash string, breastfeeding string, pregnant string, lmp date, gestation_age string")
    art = spark.createDataFrame([(i, 1, day, dt.date(1990, 1, 1), day) for i in range(7)], "patient_pk long, site_code int, start_art_date date, dob date, last_visit date")
    patients = spark.createDataFrame([(i, 1, "Female", dt.date(1990, 1, 1), None) for i in range(7)], "patient_pk long, site_code int, gender string, dob date, date_confirmed_hiv_positive date")
    last = spark.createDataFrame([(i, 1, day) for i in range(7)], "patient_pk long, site_code int, last_visit_date date")
    out = pbfw.pbfw_visits(obs, art, patients, last, AS_OF)
    assert [r.patient_pk for r in out.collect()] == [6] and set(KEY) <= set(out.columns)


def test_numbers_beyond_a_double_are_no_numbers(spark):
    r = spark.createDataFrame([("1e400",)], "x string").select(lenient_number("x").alias("x")).first()
    assert r.x is None
