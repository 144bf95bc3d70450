"""Latest clinical visit per patient (D01), as at the reporting month (D02),
and latest visit with a weight (D08)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlake.functions import pair_below, plus_days_if_null
from cohortlake.operators import latest_as_at, latest_per_key, live
from cohortlake.params import AsOf
from cohortlake.plans import IDS, KEY

VISIT_TIE = ["visit_id"]


def last_visit(visits: DataFrame, as_of) -> DataFrame:
    """Newest live visit per key (no cut-off); next appointment defaults to
    visit + 30 d; BP recorded flag; BP controlled (sys < 140 and dia < 90)."""
    a = AsOf.of(as_of)
    top = latest_per_key(live(visits), KEY, "visit_date", VISIT_TIE, rank_col="num")
    key_ok = F.col("patient_pk").isNotNull() & F.col("site_code").isNotNull()
    return top.select(
        "num", *IDS,
        F.col("visit_date").alias("last_visit_date"),
        "visit_id",
        "bp",
        plus_days_if_null("next_appointment_date", "visit_date").alias("next_appointment"),
        F.when(F.col("bp").isNotNull(), 1).otherwise(0).alias("screened_bp_last_visit"),
        F.when(key_ok & pair_below("bp", "/", 140.0, 90.0), 1).otherwise(0).alias("is_bp_controlled_at_last_visit"),
        a.load_date(),
    )


def last_visit_as_at(visits: DataFrame, as_of, order: str = "rank_then_cut") -> DataFrame:
    """Newest live visit per key, kept only if on or before the end of the
    previous month (rank, then cut)."""
    a = AsOf.of(as_of)
    top = latest_as_at(live(visits), KEY, "visit_date", a.eopm, VISIT_TIE, order, rank_col="num")
    return top.select(
        "num", "patient_id", "site_code", "patient_pk",
        F.col("visit_date").alias("visit_date_as_at"),
        "patient_pk_hash", "patient_id_hash",
        plus_days_if_null("next_appointment_date", "visit_date").alias("appointment_date_as_at"),
        a.load_date(),
    )


def latest_weight_height(visits: DataFrame, as_of) -> DataFrame:
    """Newest live visit with a weight, per key."""
    a = AsOf.of(as_of)
    top = latest_per_key(live(visits).filter(F.col("weight").isNotNull()), KEY, "visit_date", VISIT_TIE,
                         rank_col="rank")
    return top.select(
        "rank", "visit_date", *IDS, "visit_id", "weight", "height", "visit_by", a.load_date()
    )
