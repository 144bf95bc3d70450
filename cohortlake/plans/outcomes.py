"""Treatment outcome per patient (D07): a first-match ladder over exits,
appointments and start dates, plus per-site upload and abstraction dates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlake.functions import ci_in, day_diff, ladder
from cohortlake.operators import join_group_facts, latest_as_at, latest_by_group, live
from cohortlake.params import AsOf
from cohortlake.plans import KEY
from cohortlake.plans.encounter import treatments

# Exit reasons that mean the patient died.
DEATH_REASONS = ["DIED", "dead", "Death", "Died"]


def outcome_rules(a: AsOf) -> list[tuple[Column, object]]:
    """The ladder as data: ``[(condition, code), ...]``, first match wins."""
    eopm, sopm = a.eopm_lit(), a.sopm_lit()
    reason = F.col("exit_reason")
    dead = ci_in(reason, DEATH_REASONS)
    exited_alive = F.col("exit_date").isNotNull() & ~ci_in(reason, DEATH_REASONS)
    next_appt = F.col("next_appointment_date")
    first_letter = F.substring(reason, 1, 1)
    edd = F.col("effective_discontinuation_date")
    return [
        (dead, "D"),
        ((day_diff(F.coalesce(next_appt, F.col("art_expected_return")), eopm) > 30) & reason.isNull(), "uL"),
        (exited_alive & F.col("re_enrollment_date").between(sopm, eopm), "V"),
        (exited_alive & (edd >= eopm), "V"),
        (F.col("start_art_date") >= a.month_start_lit(), "NP"),
        (exited_alive & edd.between(sopm, eopm), first_letter),
        (exited_alive & (next_appt > eopm), "V"),
        (day_diff(next_appt, eopm) <= 30, "V"),
        (next_appt > eopm, "V"),
        (edd.isNotNull() & F.col("re_enrollment_date").isNull(), first_letter),
        (next_appt.isNull(), "NV"),
        (F.lit(True), first_letter),
    ]


def latest_exits(status: DataFrame, as_of, order: str = "rank_then_cut") -> DataFrame:
    """Newest live exit per key, kept only if on or before the end of the previous month."""
    a = AsOf.of(as_of)
    return latest_as_at(live(status), ["patient_pk", "site_code"], "exit_date", a.eopm, ["status_id"], order)


def art_outcomes(patients: DataFrame, art: DataFrame, last_encounter: DataFrame, status: DataFrame,
                 manifest: DataFrame, visits: DataFrame, as_of, site_split: int = 32) -> DataFrame:
    """D07. ``patients.voided`` is not checked (treatment records' is).
    ``site_split``: ways each site is split in the join of patient rows to
    per-site facts (a site may hold a large share of the patients)."""
    a = AsOf.of(as_of)
    exits = latest_exits(status, a).select(
        *KEY, "exit_date", "exit_reason", "effective_discontinuation_date", "re_enrollment_date"
    )
    enc = last_encounter.select(*KEY, "last_encounter_date", "next_appointment_date")
    # the distribution of the treatment rows that D06 reads; rows without a start go only
    # with the final grouping, as a filter here would be pushed below it and make it another one
    tx = treatments(art).select(*KEY, "start_art_date", F.col("expected_return").alias("art_expected_return"))
    base = (
        patients.select("patient_id", "patient_pk", "patient_id_hash", "patient_pk_hash", "site_code", "emr", "project")
        .join(tx, KEY, "inner")
        .join(enc, KEY, "left")
        .join(exits, KEY, "left")
    )
    outcomes = base.select(
        "patient_id", "patient_pk", "patient_id_hash", "patient_pk_hash", "start_art_date",
        "exit_reason", "exit_date", "last_encounter_date", "next_appointment_date",
        ladder(outcome_rules(a)).alias("art_outcome"),
        "site_code", "emr", "project", "re_enrollment_date", "effective_discontinuation_date",
    )
    # grouped before the (one-to-one) cast to text: the grouping then reuses
    # the hash partitioning on (site_code, patient_pk) of the joins above
    outcomes = (
        outcomes.groupBy(*outcomes.columns).agg(F.max("start_art_date").alias("__started"))
        .filter(F.col("__started").isNotNull()).drop("__started")
        .withColumn("site_code", F.col("site_code").cast("string"))
    )
    uploads = latest_by_group(
        manifest.select(F.col("site_code").cast("string").alias("site_code"), "date_recieved"),
        ["site_code"], "date_recieved", "date_uploaded",
    )
    abstraction = latest_by_group(
        live(visits).select(F.col("site_code").cast("string").alias("site_code"), "visit_date"),
        ["site_code"], "visit_date", "site_abstraction_date",
    )
    # per-site facts: one row per site, joined with each site split
    # ``site_split`` ways so a site holding many patients is not one task
    site_facts = uploads.join(abstraction, "site_code", "full")
    return (
        join_group_facts(outcomes, site_facts, ["site_code"], ["patient_pk"], ways=site_split)
        .select(
            "patient_id", "patient_pk", "patient_pk_hash", "patient_id_hash", "start_art_date",
            F.year("start_art_date").alias("cohort"),
            "exit_reason", "exit_date", "last_encounter_date", "next_appointment_date", "art_outcome",
            "site_code", "emr", "project", "date_uploaded", "site_abstraction_date",
            "re_enrollment_date", "effective_discontinuation_date", a.load_date(),
        )
    )
