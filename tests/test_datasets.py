"""Dataset semantics on hand-made rows (FIXTURES.md Part 3)."""

import datetime as dt

from pyspark.sql import functions as F

from cohortlake.functions import ladder
from cohortlake.params import AsOf
from cohortlake.plans import encounter, hts_prep, outcomes, pbfw
from tests.conftest import rows

D = dt.date
AS_OF = AsOf(D(2021, 2, 15))          # EOPM 2021-01-31, SOPM 2021-01-01
IDS = "patient_id string, site_code int, patient_pk bigint, patient_pk_hash string, patient_id_hash string"


def ids(pk):
    return (f"P{pk}", 1, pk, f"H{pk}", f"I{pk}")


def test_art_outcome_ladder_every_branch(spark):
    cols = ("case string, exit_reason string, exit_date date, next_appointment_date date, art_expected_return date, "
            "re_enrollment_date date, effective_discontinuation_date date, start_art_date date")
    old = D(2018, 1, 1)
    x = D(2020, 12, 1)
    cases = [
        ("dead", "Died", x, None, None, None, None, old, "D"),
        ("dead upper", "DEATH", x, D(2021, 3, 1), None, None, None, old, "D"),
        ("late 31 d", None, None, D(2020, 12, 31), None, None, None, old, "uL"),
        ("late via ART return", None, None, None, D(2020, 12, 1), None, None, old, "uL"),
        ("late 30 d", None, None, D(2021, 1, 1), None, None, None, old, "V"),
        ("re-enrolled in month", "LTFU", x, None, None, D(2021, 1, 15), None, old, "V"),
        ("discontinued at EOPM", "Transfer out", x, None, None, None, D(2021, 1, 31), old, "V"),
        ("new this month", None, None, D(2021, 3, 1), None, None, None, D(2021, 2, 1), "NP"),
        ("started EOPM", None, None, D(2021, 3, 1), None, None, None, D(2021, 1, 31), "V"),
        ("discontinued in month", "Transfer out", x, D(2020, 10, 1), None, None, D(2021, 1, 10), old, "T"),
        ("exited, booked later", "LTFU", x, D(2021, 2, 10), None, None, None, old, "V"),
        ("booked within 30 d", None, None, D(2021, 1, 20), None, None, None, old, "V"),
        ("discontinued earlier", "Stopped", x, D(2020, 10, 1), None, None, D(2020, 11, 1), old, "S"),
        ("no appointment", "LTFU", x, None, None, None, None, old, "NV"),
        ("else", "LTFU", x, D(2020, 10, 1), None, None, None, old, "L"),
    ]
    df = spark.createDataFrame([c[:-1] for c in cases], cols)
    got = dict(rows(df.select("case", ladder(outcomes.outcome_rules(AS_OF)).alias("code"))))
    assert got == {c[0]: c[-1] for c in cases}


def test_last_encounter_as_at_merge(spark):
    v_schema = f"{IDS}, visit_date_as_at date, appointment_date_as_at date"
    d_schema = f"{IDS}, last_dispense_date date, expected_return date"
    a, b = D(2021, 1, 10), D(2021, 1, 20)
    visits = spark.createDataFrame([
        ids(1) + (a, b),            # visit only
        ids(3) + (a, b),            # equal dates
        ids(4) + (b, D(2021, 3, 1)),  # visit later
        ids(5) + (a, b),            # dispense later
    ], v_schema)
    disp = spark.createDataFrame([
        ids(2) + (a, b),            # dispense only
        ids(3) + (a, D(2021, 2, 1)),
        ids(4) + (a, D(2021, 2, 1)),
        ids(5) + (b, D(2021, 1, 25)),
    ], d_schema)
    out = encounter.last_encounter_as_at(visits, disp, AS_OF)
    assert rows(out, "patient_pk", "encounter_date_as_at", "appointment_date_as_at") == [
        (1, None, b), (2, None, b), (3, None, D(2021, 2, 1)), (4, b, D(2021, 3, 1)), (5, None, D(2021, 1, 25))]


def test_last_encounter_repairs_and_two_art_rows(spark):
    ph_schema = f"{IDS}, dispense_id bigint, dispense_date date, expected_return date, voided int"
    art_schema = f"{IDS}, start_art_date date, last_visit date, expected_return date, dob date, voided int"
    v_schema = f"{IDS}, visit_id bigint, visit_date date, next_appointment_date date, voided int"
    d = D(2021, 1, 10)
    pharmacy = spark.createDataFrame([
        ids(1) + (1, d, d + dt.timedelta(days=364), 0),   # kept
        ids(2) + (1, d, d + dt.timedelta(days=365), 0),   # too far -> +30
        ids(3) + (1, d, D(1900, 1, 1), 0),                # sentinel -> +30
        ids(4) + (1, d, None, 0),                         # null -> +30
        ids(5) + (1, d, D(2021, 1, 20), 0),
        ids(5) + (2, D(2021, 2, 3), D(2021, 3, 1), 0),    # after EOPM: cut before ranking
    ], ph_schema)
    art = spark.createDataFrame([
        ids(k) + (D(2019, 1, 1), D(2020, 1, 1), None, D(1980, 1, 1), 0) for k in (1, 2, 3, 4)
    ] + [
        ids(5) + (D(2019, 1, 1), D(2020, 6, 1), None, D(1980, 1, 1), 0),
        ids(5) + (D(2019, 1, 1), D(2021, 1, 15), None, D(1980, 1, 1), 0),   # second treatment row: later visit wins
    ], art_schema)
    visits = spark.createDataFrame([ids(9) + (1, d, None, 0)], v_schema)
    out = encounter.last_encounter(pharmacy, art, visits, AS_OF)
    plus30 = d + dt.timedelta(days=30)
    got = rows(out, "patient_pk", "last_encounter_date", "next_appointment_date")
    assert got == [
        (1, d, D(2021, 1, 10) + dt.timedelta(days=364)),
        (2, d, plus30), (3, d, plus30), (4, d, plus30),
        # two treatment rows are paired with each other by the two joins on the
        # key: the combination of the earlier row with itself keeps the dispense
        # date, the others take the later treatment visit; both survive DISTINCT
        (5, d, D(2021, 1, 20)),
        (5, D(2021, 1, 15), D(2021, 1, 20)),
    ]


def test_pbfw_precedence_and_classes(spark):
    obs = spark.createDataFrame([
        (1, 1, "H1", None, "Yes", None, None),                 # pregnant, any age
        (1, 2, "H2", "Yes", "No", D(2020, 2, 1), "0"),          # breastfeeding, gestation start 365 d back
        (1, 3, "H3", "Yes", "No", D(2019, 10, 29), "0"),        # 460 d: out
        (1, 4, "H4", "Yes", None, D(2020, 11, 1), "0"),         # too young
        (1, 9, "H9", None, "Yes", None, None),                 # confirmed after the last visit
    ], "site_code int, patient_pk bigint, patient_pk_hash string, breastfeeding string, pregnant string, "
       "lmp date, gestation_age string")
    art = spark.createDataFrame([
        (1, 1, D(2019, 1, 1), D(2015, 1, 1), D(2020, 1, 1)),
        (1, 2, D(2019, 1, 1), D(1990, 1, 1), D(2020, 1, 1)),
        (1, 3, D(2019, 1, 1), D(1990, 1, 1), D(2020, 1, 1)),
        (1, 4, D(2019, 1, 1), D(2015, 1, 1), D(2020, 1, 1)),
    ], "site_code int, patient_pk bigint, start_art_date date, dob date, last_visit date")
    patients = spark.createDataFrame([
        (1, k, "Female", D(1990, 1, 1), conf) for k, conf in
        [(1, D(2020, 1, 1)), (2, D(2021, 1, 5)), (3, None), (4, None), (7, None), (9, D(2021, 2, 1))]
    ], "site_code int, patient_pk bigint, gender string, dob date, date_confirmed_hiv_positive date")
    last_visit = spark.createDataFrame([(1, 1, D(2021, 1, 5)), (1, 2, D(2021, 1, 5)), (1, 9, D(2021, 1, 5))],
                                       "site_code int, patient_pk bigint, last_visit_date date")
    visits = spark.createDataFrame([(1, 1, 1, D(2020, 3, 1), "Yes", "No")],
                                   "site_code int, patient_pk bigint, visit_id bigint, visit_date date, "
                                   "pregnant string, breastfeeding string")
    anc = spark.createDataFrame([
        (1, 5, "H5", 1, D(2021, 1, 1), None, "Positive"),       # ANC only, status null -> Missing
        (1, 6, "H6", 1, D(2021, 1, 1), "KP", "Negative"),       # KP -> Known Positive
        (1, 8, "H8", 1, D(2021, 1, 1), "Negative", "Positive"), # ANC source, not KP -> New Positive
    ], "site_code int, patient_pk bigint, patient_pk_hash string, visit_id bigint, visit_date date, "
       "hiv_status_before_anc string, hiv_test_final_result string")
    pnc = spark.createDataFrame([(1, 7, "H7", 1, D(2021, 1, 2), "Positive", "Negative", "Formula")],
                                "site_code int, patient_pk bigint, patient_pk_hash string, visit_id bigint, "
                                "visit_date date, prior_hiv_status string, hiv_test_final_result string, "
                                "baby_feeding string")
    mat = spark.createDataFrame([], "site_code int, patient_pk bigint, patient_pk_hash string, visit_id bigint, "
                                    "visit_date date, hiv_test_final_result string, on_art_anc string, "
                                    "initiated_bf string")
    mnch_arts = spark.createDataFrame([], "site_code int, patient_pk bigint, art_id bigint, start_art_date date")
    enrol = spark.createDataFrame([], "site_code int, patient_pk bigint, enrolment_id bigint, "
                                      "hiv_status_before_anc string, enrollment_date_at_mnch date")
    out = pbfw.pbfw(obs, art, patients, last_visit, visits, anc, pnc, mat, mnch_arts, enrol, AS_OF)
    got = rows(out, "patient_pk", "pbfw_category", "is_anc_source", "green_card_anc_date1")
    assert got == [
        (1, "Known Positive", 0, D(2020, 3, 1)),
        (2, "New Positive", 0, None),          # confirmed on the last visit date
        (5, "Missing", 1, None),
        (6, "Known Positive", 1, None),
        (7, "Missing", None, None),
        (8, "New Positive", 1, None),
        (9, "Missing", 0, None),
    ]


def test_encounter_hts_tests_date_window_and_dedup(spark):
    schema = ("site_code int, patient_pk bigint, patient_pk_hash string, encounter_id bigint, test_date date, "
              "test_type string, final_test_result string")
    df = spark.createDataFrame([
        (1, 1, "H", 1, D(2014, 12, 31), "Initial", "Negative"),
        (1, 1, "H", 2, D(2015, 1, 1), "Initial", "Negative"),
        (1, 1, "H", 3, D(2021, 2, 15), "Initial", "Negative"),
        (1, 1, "H", 4, D(2021, 2, 16), "Initial", "Negative"),
        (1, 1, "H", 5, D(2015, 1, 1), "Repeat", "Positive"),
        (1, 1, "H", 6, D(2015, 1, 1), "Repeat", "Negative"),
        (1, 1, "H", None, D(2016, 1, 1), "Initial", "Negative"),
        (1, 1, "H", 7, D(2016, 1, 1), "Initial", None),
    ], schema)
    for c in hts_prep.HTS_COLUMNS:
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("string"))
    out = hts_prep.encounter_hts_tests(df, AS_OF)
    assert rows(out, "encounter_id", "num") == [(2, 1), (3, 1), (6, 1)]


def test_prep_refills_windows(spark):
    enrol_date = D(2021, 1, 1)

    def day(n):
        return enrol_date + dt.timedelta(days=n)

    patients = spark.createDataFrame([(f"P{k}", f"PH{k}", k, f"H{k}", enrol_date, 1) for k in range(1, 6)],
                                     "prep_number string, prep_number_hash string, patient_pk bigint, "
                                     "patient_pk_hash string, prep_enrollment_date date, site_code int")
    refills = [(1, 29), (2, 30), (3, 37), (4, 38), (5, 20), (5, 33)]   # 5: second refill in window, first not
    refills += [(2, 30 + 59), (2, 30 + 60), (3, 37 + 67), (3, 37 + 68)]
    pharmacy = spark.createDataFrame([(f"P{k}", k, 1, i, day(n)) for i, (k, n) in enumerate(refills)],
                                     "prep_number string, patient_pk bigint, site_code int, dispense_id bigint, "
                                     "dispense_date date")
    hts = spark.createDataFrame([(2, 1, day(30), "Negative"), (2, 1, day(30), "Positive")],
                                "patient_pk bigint, site_code int, test_date date, final_test_result string")
    out = hts_prep.prep_refills(patients, pharmacy, hts, AS_OF)
    got = rows(out, "patient_pk", "refil1_diff_in_days", "test_results_month1", "refil3_diff_in_days")
    assert got == sorted([
        (1, None, None, None),
        (2, 30, "Negative", 90), (2, 30, "Positive", 90),
        (3, 37, None, 104),
        (4, None, None, None),
        (5, None, None, None),
    ], key=repr)
