"""HIV testing and prevention datasets: one test per encounter key (D20),
last prevention visit (D21), latest risk assessment (D22), first and third
month refills (D23)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlake.functions import ci_equals, day_diff, hash_id
from cohortlake.operators import copied, dealt, dedup_encounters, first_per_key, follow_up_in_window, large_keys, latest_per_key
from cohortlake.params import AsOf
from cohortlake.plans import KEY
from cohortlake.plans.schema import PREP_VISIT_COLUMNS, RISK_TEXT_COLUMNS

# Fixed value: tests before this date are not reported.
HTS_SINCE = dt.date(2015, 1, 1)

#: Pairs of month 1 and month 3 rows of a key that one task builds, about.
PAIRS_A_TASK = 100_000

# Columns a test carries, in source order.
HTS_COLUMNS = [
    "test_date", "encounter_id", "site_code", "patient_pk", "patient_pk_hash", "emr", "project", "date_extracted",
    "ever_tested_for_hiv", "months_since_last_test", "client_tested_as", "entry_point", "test_strategy",
    "test_result1", "test_result2", "final_test_result", "patient_given_result", "tb_screening",
    "client_self_tested", "couple_discordant", "test_type", "setting", "consent",
]


def encounter_hts_tests(hts: DataFrame, as_of, since: dt.date = HTS_SINCE) -> DataFrame:
    """Per (key, test date, test type) the test with the highest encounter
    id, among tests with a result, a date in [since, as_of] and an id."""
    a = AsOf.of(as_of)
    ok = (
        F.col("final_test_result").isNotNull()
        & F.col("test_date").isNotNull()
        & F.col("encounter_id").isNotNull()
        & (F.col("test_date") >= F.lit(since))
        & (F.to_date("test_date") <= a.lit())
    )
    top = dedup_encounters(hts.filter(ok), [*KEY, "test_date", "test_type"], "encounter_id", rank_col="num")
    return top.select("num", *HTS_COLUMNS, a.load_date())


def prep_last_visit(prep_visits: DataFrame, as_of) -> DataFrame:
    """Newest dated prevention visit per key with all its clinical columns."""
    a = AsOf.of(as_of)
    top = latest_per_key(prep_visits.filter(F.col("visit_date").isNotNull()), KEY, "visit_date", ["visit_id"],
                         rank_col="num")
    return top.select(
        "num", "patient_pk", "patient_pk_hash", "site_code", "encounter_id", "visit_id", "visit_date",
        F.month("visit_date").alias("visit_month"), F.year("visit_date").alias("visit_year"),
        *PREP_VISIT_COLUMNS, a.load_date(),
    )


def latest_prep_assessment(risk: DataFrame, as_of) -> DataFrame:
    """Newest risk assessment per key; eligible when the client is at risk;
    screened when dated; partner clinic number hashed (SHA-256, upper hex)."""
    a = AsOf.of(as_of)
    top = latest_per_key(risk, ["patient_pk", "site_code"], "visit_date", ["visit_id"], rank_col="num")
    return top.select(
        "num", "patient_pk", "patient_pk_hash", "site_code", "visit_date", "visit_id",
        *RISK_TEXT_COLUMNS[:11], "hiv_partner_ccc_number", "hiv_partner_art_start_date", *RISK_TEXT_COLUMNS[11:],
        "client_risk",
        F.when(ci_equals("client_risk", "Risk"), 1).otherwise(0).alias("eligible_prep"),
        F.col("visit_date").alias("assessment_visit_date"),
        F.when(F.col("visit_date").isNotNull(), 1).otherwise(0).alias("screened_prep"),
        hash_id("hiv_partner_ccc_number").alias("hiv_partner_ccc_number_hash"),
        a.load_date(),
    )


def prep_refills(prep_patients: DataFrame, prep_pharmacy: DataFrame, hts: DataFrame, as_of) -> DataFrame:
    """Per enrolled client, the first-ever refill if it is 30-37 days after
    enrolment (month 1) and any refill 60-67 days after that one (month 3),
    each with the test(s) done the same day. Month 3 reports days since
    enrolment. Rows are distinct.

    The tests are read once: the dates of month 1 and month 3 are stacked and joined to
    the tests of their day together, and each different row is flagged with the months it
    belongs to. A key's months meet as rows, never as arrays; those of a key with
    very many of both meet in several tasks (``operators.product``).
    """
    a = AsOf.of(as_of)
    pkey = ["prep_number", "patient_pk", "site_code"]
    enrol = prep_patients.select(*pkey, "prep_enrollment_date")
    tests = hts.select(*KEY, F.to_date("test_date").alias("day"), "test_date", F.col("final_test_result").alias("result"))
    refills = prep_pharmacy.filter(F.col("prep_number").isNotNull()).select(*pkey, "dispense_id", "dispense_date")
    days_in = day_diff("prep_enrollment_date", "dispense_date").alias("days_in")

    first = first_per_key(refills, pkey, "dispense_date", ["dispense_id"]).join(enrol, pkey, "inner")
    month1 = first.select(*KEY, days_in, "dispense_date").filter(F.col("days_in").between(30, 37)).distinct()
    anchors = month1.select(*KEY, F.col("dispense_date").alias("m1_date")).distinct()
    month3 = follow_up_in_window(refills, anchors, KEY, "dispense_date", "m1_date", 60, 67).join(enrol, pkey, "left")
    month3 = month3.select(*KEY, days_in, "dispense_date").distinct()
    dates = month1.withColumn("month", F.lit(1)).unionByName(month3.withColumn("month", F.lit(3)))
    tested = dates.withColumn("day", F.to_date("dispense_date")).join(tests, [*KEY, "day"], "left")
    # one distribution by key, read for both months: flags that come from the grouping
    # are not pushed below it
    fields = ["days_in", "result", "test_date", "dispense_date"]
    rows = tested.select(*KEY, *fields, "month").repartition(*KEY).groupBy(*KEY, *fields).agg(
        *[F.max(F.col("month") == m).alias(f"in{m}") for m in (1, 3)])
    sizes = rows.groupBy(*KEY).agg(*[F.sum(F.col(f"in{m}").cast("int")).cast("double").alias(f"n{m}") for m in (1, 3)])
    pairs = F.col("n1") * F.col("n3")
    large = large_keys(sizes, KEY, pairs > PAIRS_A_TASK, pairs / PAIRS_A_TASK)
    months = [rows.filter(f"in{m}").select(*KEY, *[F.col(c).alias(f"{c}{m}") for c in fields]) for m in (1, 3)]
    clients = prep_patients.filter(F.col("prep_number").isNotNull()).select(
        "prep_number", "prep_number_hash", "patient_pk", "patient_pk_hash", "prep_enrollment_date", "site_code"
    )

    def result(met: DataFrame) -> DataFrame:
        return met.select(
            "prep_number", "patient_pk", "patient_pk_hash", "prep_number_hash", "site_code",
            *[F.col(f"{field}{m}").alias(name.format(m))
              for m in (1, 3)
              for field, name in [("days_in", "refil{}_diff_in_days"), ("result", "test_results_month{}"),
                                  ("test_date", "test_date_month{}"), ("dispense_date", "dispense_date_month{}")]],
            a.load_date(),
        ).distinct()

    usual = clients.join(large.select(*KEY), KEY, "left_anti").join(months[0], KEY, "left").join(months[1], KEY, "left")
    cell = [*KEY, "__share"]
    # a large key has rows of both months
    many = dealt(months[0].join(large, KEY), KEY, [f"{c}1" for c in fields]).join(copied(months[1].join(large, KEY), KEY), cell)
    many = many.join(copied(clients.join(large, KEY).distinct(), KEY), cell)
    return result(usual).unionByName(result(many))
