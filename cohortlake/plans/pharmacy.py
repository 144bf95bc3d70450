"""Latest dispense per patient (D03) and as at the reporting month."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlake.functions import plus_days_if_null
from cohortlake.operators import latest_as_at, latest_per_key, live
from cohortlake.params import AsOf
from cohortlake.plans import IDS, KEY

DISPENSE_TIE = ["dispense_id"]


def _shape(top: DataFrame, a: AsOf) -> DataFrame:
    return top.select(
        "num", *IDS,
        F.col("dispense_date").alias("last_dispense_date"),
        plus_days_if_null("expected_return", "dispense_date").alias("expected_return"),
        a.load_date(),
    )


def last_dispense(pharmacy: DataFrame, as_of) -> DataFrame:
    """Newest live dispense per key; missing return date -> dispense + 30 d."""
    a = AsOf.of(as_of)
    return _shape(latest_per_key(live(pharmacy), KEY, "dispense_date", DISPENSE_TIE, rank_col="num"), a)


def dispense_as_at(pharmacy: DataFrame, as_of, order: str = "rank_then_cut") -> DataFrame:
    """D03, kept only if the newest dispense is on or before the end of the
    previous month."""
    a = AsOf.of(as_of)
    top = latest_as_at(live(pharmacy), KEY, "dispense_date", a.eopm, DISPENSE_TIE, order, rank_col="num")
    return _shape(top, a)
