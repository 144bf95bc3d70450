"""First pregnant visit per woman: pregnant at treatment start / enrolment
(D16), pregnant after treatment start (D17)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlake.functions import ci_equals, ci_in
from cohortlake.operators import first_per_key, live
from cohortlake.params import AsOf
from cohortlake.plans import KEY

# Answers that mean "pregnant".
PREGNANT_YES = ["YES", "Y"]


def pregnant_answer() -> Column:
    return ci_in("pregnant", PREGNANT_YES)


def _first_pregnant_women(visits: DataFrame, patients: DataFrame, art: DataFrame) -> DataFrame:
    first = first_per_key(
        live(visits).filter(pregnant_answer()), KEY, "visit_date", ["visit_id"]
    ).select(*KEY, "visit_date")
    women = live(patients).filter(ci_equals("gender", "Female")).select(
        *KEY, "patient_id", "patient_pk_hash", "patient_id_hash", "registration_at_ccc"
    )
    tx = live(art).select(*KEY, "start_art_date")
    return first.join(women, KEY, "inner").join(tx, KEY, "inner")


def _flag(cond: Column, name: str) -> Column:
    return F.when(cond, 1).otherwise(0).alias(name)


def pregnancy_at_initiation(visits: DataFrame, patients: DataFrame, art: DataFrame, as_of) -> DataFrame:
    """First pregnant visit in the treatment-start year / enrolment year."""
    a = AsOf.of(as_of)
    j = _first_pregnant_women(visits, patients, art)
    return j.select(
        "patient_pk", "patient_id", "patient_pk_hash", "patient_id_hash", "site_code",
        _flag(F.year("start_art_date") == F.year("visit_date"), "pregnant_art_start"),
        _flag(F.year("registration_at_ccc") == F.year("visit_date"), "pregnant_at_enrol"),
        a.load_date(),
    )


def pregnancy_during_art(visits: DataFrame, patients: DataFrame, art: DataFrame, as_of) -> DataFrame:
    """First pregnant visit after the treatment start."""
    a = AsOf.of(as_of)
    j = _first_pregnant_women(visits, patients, art)
    return j.select(
        "patient_pk", "patient_id", "patient_pk_hash", "patient_id_hash", "site_code",
        _flag(F.col("visit_date") > F.col("start_art_date"), "pregnant_during_art"),
        a.load_date(),
    )
