"""More dataset edge rows (FIXTURES.md Part 3): labs, pregnancy, assessments, BP."""

import datetime as dt

from cohortlake.params import AsOf
from cohortlake.plans import hts_prep, labs, pregnancy, visits
from cohortlake.plans.schema import RISK_TEXT_COLUMNS
from tests.conftest import rows

D = dt.date
AS_OF = AsOf(D(2021, 2, 15))
LAB_SCHEMA = ("patient_id string, site_code int, patient_pk bigint, patient_pk_hash string, patient_id_hash string, "
              "visit_id bigint, lab_id bigint, ordered_by_date date, reported_by_date date, test_name string, "
              "test_result string, emr string, project string, reason string, voided int")


def lab(pk, lab_id, day, result, name="Viral Load", voided=0):
    return (f"P{pk}", 1, pk, f"H{pk}", f"I{pk}", lab_id, lab_id, day, day, name, result, "E", "J", None, voided)


def test_viral_load_first_latest_and_null_dates(spark):
    df = spark.createDataFrame([
        lab(1, 1, D(2020, 1, 1), "150"), lab(1, 2, None, "LDL"), lab(1, 3, D(2021, 1, 1), "300"),
        lab(1, 4, D(2021, 2, 1), "400", voided=1),
        lab(1, 5, D(2019, 1, 1), None),                       # no result: ignored
        lab(1, 6, D(2018, 1, 1), "9", name="HBA1C"),          # other test
    ], LAB_SCHEMA)
    assert rows(labs.baseline_viral_load(df, AS_OF), "patient_pk", "visit_id") == [(1, 2)]   # null date first
    assert rows(labs.latest_viral_load(df, AS_OF), "visit_id") == [(4,)]        # soft-deleted rows count here
    assert rows(labs.ordered_viral_loads(df, AS_OF), "rank", "visit_id") == [(1, 3), (2, 1), (3, 2)]


def test_viral_load_intervals_suppression_and_months(spark):
    art = spark.createDataFrame([("P1", 1, 1, "H1", "I1", D(2021, 1, 31), 0)],
                                "patient_id string, site_code int, patient_pk bigint, patient_pk_hash string, "
                                "patient_id_hash string, start_art_date date, voided int")
    results = ["199.99", "200", "1,200", "LDL", "ldl", "> 1000", "$5"]
    rows_in = [lab(1, i + 10, D(2022, 1, 5) if i else D(2021, 7, 1), r) for i, r in enumerate(results)]
    rows_in.append(lab(1, 99, D(2021, 7, 20), "5000"))          # same month as the first, later
    df = spark.createDataFrame(rows_in, LAB_SCHEMA)
    out = labs.viral_load_intervals(df, art, AS_OF)
    r = out.collect()[0]
    assert (r.vl_6_month, r.vl_6_month_date, r.vl_6_month_sup) == ("199.99", D(2021, 7, 1), 1)   # 31 Jan -> 1 Jul
    assert r.vl_12_month == "200" and r.vl_12_month_sup == 0                 # first by lab id on the same date
    assert r.vl_18_month is None and r.vl_24_month is None
    sup = labs.below_or_in("test_result", 200.0, labs.SUPPRESSED_WORDS)
    got = dict(rows(df.select("test_result", sup.alias("s"))))
    assert got == {"199.99": 1, "200": 0, "1,200": 0, "LDL": 1, "ldl": 1, "> 1000": 0, "$5": 0, "5000": 0}


def test_pregnancy_flags(spark):
    v = spark.createDataFrame([
        (1, 1, 1, D(2019, 3, 1), "Yes", 0),      # pregnant in the start year, on the start date
        (1, 1, 2, D(2020, 3, 1), "Y", 0),
        (1, 2, 3, D(2019, 3, 1), "YES", 0),      # null start
        (1, 3, 4, D(2019, 3, 1), "Yes", 0),      # male
        (1, 4, 5, D(2019, 3, 1), "No", 0),       # not pregnant
    ], "site_code int, patient_pk bigint, visit_id bigint, visit_date date, pregnant string, voided int")
    p = spark.createDataFrame([
        (1, k, f"P{k}", f"H{k}", f"I{k}", g, D(2019, 1, 1), 0)
        for k, g in [(1, "Female"), (2, "female"), (3, "Male"), (4, "Female")]
    ], "site_code int, patient_pk bigint, patient_id string, patient_pk_hash string, patient_id_hash string, "
       "gender string, registration_at_ccc date, voided int")
    a = spark.createDataFrame([(1, 1, D(2019, 3, 1), 0), (1, 2, None, 0), (1, 3, D(2019, 1, 1), 0),
                               (1, 4, D(2019, 1, 1), 0)], "site_code int, patient_pk bigint, start_art_date date, voided int")
    init = rows(pregnancy.pregnancy_at_initiation(v, p, a, AS_OF), "patient_pk", "pregnant_art_start", "pregnant_at_enrol")
    during = rows(pregnancy.pregnancy_during_art(v, p, a, AS_OF), "patient_pk", "pregnant_during_art")
    assert init == [(1, 1, 1), (2, 0, 1)]
    assert during == [(1, 0), (2, 0)]


def test_latest_prep_assessment_hash_and_nulls(spark):
    cols = ["patient_pk", "patient_pk_hash", "site_code", "visit_date", "visit_id", *RISK_TEXT_COLUMNS,
            "hiv_partner_ccc_number", "hiv_partner_art_start_date", "client_risk"]
    schema = ", ".join(f"{c} {'date' if c in ('visit_date', 'hiv_partner_art_start_date') else 'bigint' if c in ('patient_pk', 'visit_id') else 'int' if c == 'site_code' else 'string'}" for c in cols)
    blank = [None] * len(RISK_TEXT_COLUMNS)
    s30, s31 = "C" * 30, "C" * 30 + "X"
    df = spark.createDataFrame([
        (1, "H1", 1, D(2020, 1, 1), 1, *blank, s30, None, "Risk"),
        (2, "H2", 1, D(2020, 1, 1), 2, *blank, s31, None, "risk "),
        (3, "H3", 1, None, 3, *blank, None, None, "No Risk"),
        (3, "H3", 1, D(2019, 1, 1), 4, *blank, "Z", None, "No Risk"),   # dated row beats the null date
        (4, "H4", 1, None, 5, *blank, None, None, None),
    ], schema)
    out = {r.patient_pk: r for r in hts_prep.latest_prep_assessment(df, AS_OF).collect()}
    assert None not in (out[1].hiv_partner_ccc_number_hash, out[2].hiv_partner_ccc_number_hash)
    assert out[1].hiv_partner_ccc_number_hash != out[2].hiv_partner_ccc_number_hash   # the whole text is hashed
    assert (out[1].eligible_prep, out[2].eligible_prep, out[3].eligible_prep) == (1, 1, 0)
    assert out[3].visit_id == 4 and out[3].screened_prep == 1
    assert out[4].screened_prep == 0 and out[4].hiv_partner_ccc_number_hash is None


def test_last_visit_bp_flags(spark):
    bps = ["139.9/89.9", "140/89", "120/90", "120", "/80", "120/", "1e2/80", "NaN/80", None]
    v = spark.createDataFrame([
        (f"P{i}", 1, i, f"H{i}", f"I{i}", i, D(2021, 1, 1), None, bp, 0) for i, bp in enumerate(bps)
    ] + [("PX", None, 99, "HX", "IX", 99, D(2021, 1, 1), None, "100/60", 0)],      # null site: never controlled
        "patient_id string, site_code int, patient_pk bigint, patient_pk_hash string, patient_id_hash string, "
        "visit_id bigint, visit_date date, next_appointment_date date, bp string, voided int")
    got = rows(visits.last_visit(v, AS_OF), "patient_pk", "screened_bp_last_visit", "is_bp_controlled_at_last_visit",
               "next_appointment")
    expected = {0: 1, 6: 1}
    assert got == sorted([(i, 0 if bp is None else 1, expected.get(i, 0), D(2021, 1, 31)) for i, bp in enumerate(bps)]
                         + [(99, 1, 0, D(2021, 1, 31))], key=repr)


def test_last_encounter_appointment_365_vs_366_days_after_as_of(spark):
    from cohortlake.plans import encounter

    ids = "patient_id string, site_code int, patient_pk bigint, patient_pk_hash string, patient_id_hash string"
    pharmacy = spark.createDataFrame([], f"{ids}, dispense_id bigint, dispense_date date, expected_return date, voided int")
    art = spark.createDataFrame([
        ("P6", 1, 6, "H6", "I6", D(2019, 1, 1), D(2021, 1, 10), AS_OF.day + dt.timedelta(days=365), D(1980, 1, 1), 0),
        ("P7", 1, 7, "H7", "I7", D(2019, 1, 1), D(2021, 1, 10), AS_OF.day + dt.timedelta(days=366), D(1980, 1, 1), 0),
    ], f"{ids}, start_art_date date, last_visit date, expected_return date, dob date, voided int")
    visits = spark.createDataFrame([], f"{ids}, visit_id bigint, visit_date date, next_appointment_date date, voided int")
    got = rows(encounter.last_encounter(pharmacy, art, visits, AS_OF), "patient_pk", "next_appointment_date")
    assert got == [(6, AS_OF.day + dt.timedelta(days=365)), (7, D(2021, 2, 9))]


def test_latest_obs_multiplies_rows_for_duplicate_last_visits(spark):
    from cohortlake.plans import obs, visits as visit_plans

    ids = "patient_id string, site_code int, patient_pk bigint, patient_pk_hash string, patient_id_hash string"
    cols = (f"{ids}, visit_id bigint, visit_date date, next_appointment_date date, bp string, weight double, "
            "height double, visit_by string, pregnant string, breastfeeding string, lmp date, gestation_age string, "
            "adherence string, adherence_category string, differentiated_care string, stability_assessment string, "
            "family_planning_method string, who_stage string, voided int")
    base = ("P1", 1, 1, "H1", "I1", 5, D(2021, 1, 10), None, None, 60.0, 170.0, "Self", "No", "No", None, "0")
    v = spark.createDataFrame([
        base + ("Good", "ART", "Standard Care", "Stable", "Condoms", "1", 0),
        base + ("Poor", "ART", "Standard Care", "Stable", "Injectable", "1", 0),   # same date and visit id
        ("P1", 1, 1, "H1", "I1", 4, D(2020, 1, 10), None, None, 50.0, 170.0, "Self", "Yes", "Yes", None, "0",
         "Fair", "ART", "Fast Track", "Unstable", None, "2", 0),
    ], cols)
    patients = spark.createDataFrame([("P1", 1, 1, "H1", "I1", D(1980, 6, 1), 0)], f"{ids}, dob date, voided int")
    ipt = spark.createDataFrame([(1, 1, 5, D(2021, 1, 10), "Screened - Negative", 0)],
                                "site_code int, patient_pk bigint, visit_id bigint, visit_date date, "
                                "tb_screening string, voided int")
    d06 = spark.createDataFrame([(1, 1, D(2021, 1, 10), D(2021, 4, 10))],
                                "site_code int, patient_pk bigint, last_encounter_date date, next_appointment_date date")
    out = obs.latest_obs(patients, v, ipt, d06,
                         visit_plans.latest_weight_height(v, AS_OF), AS_OF)
    got = rows(out, "adherence", "differentiated_care", "who_stage", "tb_screening", "on_mmd", "age_last_visit",
               "latest_weight")
    # two distinct adherence values x two family-planning values (joined, not shown) = 4 rows
    assert got == sorted([("Good", "Standard Care", "1", "Screened - Negative", 1, 41, 60.0)] * 2
                         + [("Poor", "Standard Care", "1", "Screened - Negative", 1, 41, 60.0)] * 2, key=repr)


def test_latest_obs_duplicate_patient_rows_multiply_ages(spark):
    from cohortlake.plans import obs

    ids = "patient_id string, site_code int, patient_pk bigint, patient_pk_hash string, patient_id_hash string"
    for dobs, ages in [((D(1980, 6, 1), D(1990, 6, 1)), [31, 31, 41, 41]), ((D(1980, 6, 1), D(1980, 6, 1)), [41] * 4)]:
        patients = spark.createDataFrame([("P1", 1, 1, "H1", "I1", d, 0) for d in dobs], f"{ids}, dob date, voided int")
        empty_visits = spark.createDataFrame([], f"{ids}, visit_id bigint, visit_date date, adherence string, "
                                                 "adherence_category string, differentiated_care string, "
                                                 "stability_assessment string, pregnant string, "
                                                 "family_planning_method string, breastfeeding string, lmp date, "
                                                 "gestation_age string, who_stage string, voided int")
        ipt = spark.createDataFrame([], "site_code int, patient_pk bigint, visit_id bigint, visit_date date, "
                                        "tb_screening string, voided int")
        d01 = spark.createDataFrame([], "site_code int, patient_pk bigint, last_visit_date date, visit_id bigint")
        d06 = spark.createDataFrame([(1, 1, D(2021, 1, 10), D(2021, 2, 10))],
                                    "site_code int, patient_pk bigint, last_encounter_date date, "
                                    "next_appointment_date date")
        d08 = spark.createDataFrame([], "patient_pk_hash string, site_code int, weight double, height double")
        out = obs.latest_obs(patients, empty_visits, ipt, d06, d08, AS_OF)
        assert sorted(r.age_last_visit for r in out.collect()) == ages
