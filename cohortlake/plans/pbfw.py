"""Pregnant and breastfeeding women (D10): the care-visit cohort merged with
the antenatal, postnatal and maternity sources, classified as known / new
positive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlake.functions import ci_equals, ci_in, day_diff, ladder, lenient_number, year_boundary_diff
from cohortlake.operators import first_per_key, full_merge, latest_per_key
from cohortlake.params import AsOf
from cohortlake.plans import KEY

# Infant feeding answers that mean breastfeeding.
BREASTFEEDING_ANSWERS = ["Breastfed exclusively", "Exclusive breastfeeding", "mixed feeding"]
# Gestation window (days) and minimum ages (year boundaries).
MAX_GESTATION_DAYS = 450
# A gestation text of more weeks than this, either side of 0, is unknown (null).
MAX_GESTATION_WEEKS = 10_000
MIN_AGE_COHORT = 10
MIN_AGE_FIRST_VISIT = 1


def _yes(c: str):
    return ci_equals(c, "Yes")


def pregnant_visit():
    return _yes("pregnant")


def breastfeeding_visit():
    return _yes("breastfeeding")


def pbfw_visits(obs: DataFrame, art: DataFrame, patients: DataFrame, last_visit: DataFrame, as_of) -> DataFrame:
    """Women from the latest observations: pregnant, or breastfeeding with an
    age over 10 and a gestation start within 450 days of the end of the
    previous month. (``and`` binds tighter than ``or``: pregnant women skip the
    age and gestation tests.)"""
    a = AsOf.of(as_of)
    weeks = lenient_number("gestation_age")
    days = F.when(F.abs(weeks) <= MAX_GESTATION_WEEKS, (F.floor(weeks) * 7).cast("int"))
    gestation_start = F.date_sub(F.col("lmp"), days)
    j = (
        obs.select(*KEY, "patient_pk_hash", "breastfeeding", "pregnant", "lmp", "gestation_age")
        .join(art.select(*KEY, "start_art_date", F.col("dob").alias("art_dob"), "last_visit"), KEY, "left")
        .join(patients.select(*KEY, "gender", "dob", "date_confirmed_hiv_positive"), KEY, "left")
        .join(last_visit.select(*KEY, "last_visit_date"), KEY, "left")
    )
    cond = _yes("pregnant") | (
        _yes("breastfeeding")
        & (year_boundary_diff("art_dob", "last_visit") > MIN_AGE_COHORT)
        & (day_diff(gestation_start, a.eopm_lit()) <= MAX_GESTATION_DAYS)
    )
    return j.filter(cond).select(
        *KEY, "patient_pk_hash", "breastfeeding", "pregnant", "gender", "dob", "start_art_date",
        "date_confirmed_hiv_positive", "last_visit_date",
    ).distinct()


def first_pregnant_or_breastfeeding_visit(visits: DataFrame, art: DataFrame) -> DataFrame:
    """Date of the first visit (a null date counts as first) that is pregnant,
    or breastfeeding when the patient has a treatment record with an age over 1.

    The treatment condition depends only on the patient, so visits are first
    reduced per key to two candidates - first pregnant visit, first pregnant
    or breastfeeding visit - by a partial aggregation (a patient with very
    many visits sends one row per map task), and only then joined to the
    per-key flag "has a qualifying treatment record"; the flag picks the
    candidate. Visits are not joined to the treatment table row by row.
    """
    preg, bf = pregnant_visit(), breastfeeding_visit()
    # a null date counts as the first: a minimum and a flag, both of fixed width, so that the
    # visits are reduced by a hash aggregate without sorting them
    def first(of, name):
        return [F.min(F.when(of, F.col("visit_date"))).alias(name), F.max(F.when(of, F.col("visit_date").isNull())).alias(f"{name}_undated")]

    cand = visits.filter(preg | bf).groupBy(*KEY).agg(*first(preg, "first_pregnant"), *first(preg | bf, "first_any"))
    date = lambda name: F.when(~F.coalesce(f"{name}_undated", F.lit(False)), F.col(name))
    art_ok = (
        art.filter(year_boundary_diff("dob", "last_visit") > MIN_AGE_FIRST_VISIT)
        .select(*KEY).distinct().withColumn("art_ok", F.lit(True))
    )
    return cand.join(art_ok, KEY, "left").select(
        *KEY,
        F.when(F.col("art_ok"), date("first_any")).otherwise(date("first_pregnant")).alias("anc_date1"),
    )


def pbfw(obs: DataFrame, art: DataFrame, patients: DataFrame, last_visit: DataFrame, visits: DataFrame,
         anc: DataFrame, pnc: DataFrame, mat: DataFrame, mnch_arts: DataFrame, mnch_enrolments: DataFrame,
         as_of) -> DataFrame:
    """D10 (no load date, as in the source)."""
    a = AsOf.of(as_of)
    vs = pbfw_visits(obs, art, patients, last_visit, a)
    first_anc = first_pregnant_or_breastfeeding_visit(visits, art)
    latest_anc = latest_per_key(
        anc.filter(ci_equals("hiv_status_before_anc", "KP") | ci_equals("hiv_test_final_result", "Positive")),
        KEY, "visit_date", ["visit_id"],
    )
    latest_pnc = latest_per_key(
        pnc.filter(ci_equals("prior_hiv_status", "Positive")
                   | (ci_equals("hiv_test_final_result", "Positive") & ci_in("baby_feeding", BREASTFEEDING_ANSWERS))),
        KEY, "visit_date", ["visit_id"],
    )
    latest_mat = latest_per_key(
        mat.filter(ci_equals("hiv_test_final_result", "Positive") | (_yes("on_art_anc") & _yes("initiated_bf"))),
        KEY, "visit_date", ["visit_id"],
    )
    mnch_start = first_per_key(mnch_arts, KEY, "start_art_date", ["art_id"]).select(
        *KEY, F.col("start_art_date").alias("mnch_start_art_date"))
    enrol = latest_per_key(mnch_enrolments, KEY, "enrollment_date_at_mnch", ["enrolment_id"]).select(
        *KEY, F.col("hiv_status_before_anc").alias("enrol_status"))

    carried = ["breastfeeding", "pregnant", "start_art_date", "date_confirmed_hiv_positive", "gender", "dob"]
    j1 = full_merge(
        vs, latest_anc, KEY,
        coalesce={"patient_pk_hash": ("patient_pk_hash", "patient_pk_hash"),
                  "last_visit_date": ("last_visit_date", "visit_date")},
        left_cols={c: c for c in carried},
        right_cols={"hiv_status_before_anc": "hiv_status_before_anc"},
        present={"is_anc_source": "right"},
    )
    carried += ["hiv_status_before_anc", "is_anc_source"]
    merged = j1
    for src in (latest_pnc, latest_mat):
        merged = full_merge(
            merged, src, KEY,
            coalesce={"patient_pk_hash": ("patient_pk_hash", "patient_pk_hash"),
                      "last_visit_date": ("last_visit_date", "visit_date")},
            left_cols={c: c for c in carried},
        )
    joined = (
        merged.join(mnch_start, KEY, "left").join(enrol, KEY, "left").join(first_anc, KEY, "left")
        .select(
            *KEY, "patient_pk_hash", "last_visit_date", "breastfeeding", "pregnant", "gender", "dob", "is_anc_source",
            "date_confirmed_hiv_positive",
            F.col("hiv_status_before_anc").alias("status_source"),
            F.coalesce("start_art_date", "mnch_start_art_date").alias("start_art_date"),
            F.coalesce("enrol_status", "hiv_status_before_anc").alias("hiv_status_before_anc"),
            "anc_date1",
        )
    )
    confirmed, last = F.col("date_confirmed_hiv_positive"), F.col("last_visit_date")
    category = ladder([
        (confirmed < last, "Known Positive"),
        (confirmed == last, "New Positive"),
        (ci_in("hiv_status_before_anc", ["Positive", "KP"]), "Known Positive"),
        ((F.col("is_anc_source") == 1) & ~ci_in("status_source", ["KP"]), "New Positive"),
    ], default="Missing")
    return joined.select(
        "site_code", "patient_pk_hash", "patient_pk", "breastfeeding", "pregnant", "start_art_date",
        "date_confirmed_hiv_positive", "last_visit_date", "hiv_status_before_anc", "is_anc_source", "gender", "dob",
        category.alias("pbfw_category"),
        F.col("anc_date1").alias("green_card_anc_date1"),
    )
