"""Fixture adapter: the driver's TPC-H-like test tables in the clinical shape.

The rules are FIXTURES.md Part 2 (a deterministic function of order key ``k``,
customer key ``pk``, line number ``ln``, quantity and dates). Every table is a
lazy DataFrame derived from the given tables, so its size grows with them.
Dates are shifted +20 years (tests and prevention tables +19). Each event
table carries a record id used as the documented tie-break after the date.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlake.plans.schema import PREP_VISIT_COLUMNS, RISK_TEXT_COLUMNS  # noqa: F401
from cohortlake.sources.tables import read_table

K_COLS = ["patient_id", "site_code", "patient_pk", "patient_pk_hash", "patient_id_hash"]

def generated_text(k: Column, i: int) -> Column:
    """Filler text for the i-th carried column: null by one modulus, else a
    short code by another."""
    return F.when(k % (2 + i % 5) != 0, F.concat(F.lit(f"v{i}-"), (k % (3 + i % 7)).cast("string")))


def _d(y: int, m: int, d: int) -> Column:
    return F.lit(dt.date(y, m, d))


def shift_years(c: Column, years: int) -> Column:
    return F.add_months(F.to_date(c), 12 * years)


def pick(n: Column, values: list) -> Column:
    """``values[n]`` for n = 0..len-1 (a None entry gives null)."""
    out = None
    for i, v in enumerate(values):
        if v is None:
            continue
        out = F.when(n == i, F.lit(v)) if out is None else out.when(n == i, F.lit(v))
    return out


def sha_upper(c: Column) -> Column:
    return F.upper(F.sha2(c.cast("string"), 256))


class FixtureTables:
    """Clinical tables over ``<sf_dir>/*.parquet``; attributes are DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def _raw(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    # ---- shared bases -------------------------------------------------
    @cached_property
    def _cust(self) -> DataFrame:
        c = self._raw("customer")
        pk = F.col("c_custkey")
        return c.select(
            pk.alias("patient_pk"),
            F.col("c_nationkey").alias("site_code"),
            F.col("c_name").alias("patient_id"),
            sha_upper(pk).alias("patient_pk_hash"),
            sha_upper(F.col("c_name")).alias("patient_id_hash"),
            F.col("c_mktsegment").alias("emr"),
            F.concat(F.lit("Project-"), (pk % 3).cast("string")).alias("project"),
        )

    @cached_property
    def _ord(self) -> DataFrame:
        o = self._raw("orders").select(
            F.col("o_orderkey").alias("k"),
            F.col("o_custkey").alias("patient_pk"),
            F.col("o_orderstatus").alias("order_status"),
            F.to_date("o_orderdate").alias("odate"),
        )
        return o.join(self._cust, "patient_pk")

    @cached_property
    def _li(self) -> DataFrame:
        li = self._raw("lineitem").select(
            F.col("l_orderkey").alias("k"),
            F.col("l_linenumber").alias("ln"),
            F.col("l_quantity").alias("qty"),
            F.to_date("l_shipdate").alias("sdate"),
        )
        return li.join(self._ord.drop("odate", "order_status"), "k")

    # ---- patients / treatment ------------------------------------------
    @cached_property
    def ct_patient(self) -> DataFrame:
        pk = F.col("patient_pk")
        return self._cust.select(
            *K_COLS,
            F.date_add(_d(1950, 1, 1), (pk * 37 % 18000).cast("int")).alias("dob"),
            F.when(pk % 2 == 0, "Female").otherwise("Male").alias("gender"),
            F.date_add(_d(2015, 1, 1), (pk % 700).cast("int")).alias("registration_at_ccc"),
            F.when(pk % 6 != 0, F.date_add(_d(2015, 3, 1), (pk * 13 % 2200).cast("int")))
            .alias("date_confirmed_hiv_positive"),
            "emr",
            "project",
            F.when(pk % 23 == 0, 1).otherwise(0).alias("voided"),
        )

    @cached_property
    def ct_art_patients(self) -> DataFrame:
        # one treatment record per customer and order status; one without dates
        # for customers without orders
        first = self._raw("orders").groupBy(F.col("o_custkey").alias("patient_pk"), F.col("o_orderstatus").alias("status")).agg(
            F.min(F.to_date("o_orderdate")).alias("first_order")
        )
        pk = F.col("patient_pk")
        lv = F.date_add(F.add_months(F.col("first_order"), 240), 1500)
        return (
            self._cust.join(first, "patient_pk", "left")
            .select(
                *K_COLS,
                F.when(pk % 31 != 0, F.when(F.col("status") == "P", F.date_add(_d(2021, 2, 1), (pk % 10).cast("int")))
                       .otherwise(F.date_add(_d(2015, 6, 1), (pk * 11 % 900).cast("int")))).alias("start_art_date"),
                lv.alias("last_visit"),
                F.when(pk % 9 != 0, F.date_add(lv, (pk % 400).cast("int"))).alias("expected_return"),
                F.date_add(_d(1950, 1, 1), (pk * 37 % 18000).cast("int")).alias("dob"),
                F.when(pk % 29 == 0, 1).otherwise(0).alias("voided"),
            )
        )

    @cached_property
    def ct_patient_status(self) -> DataFrame:
        k = F.col("k")
        exit_date = F.add_months("odate", 308)  # open orders: November 2020 to February 2021
        return (
            self._ord.filter(F.col("order_status") == "P")
            .select(
                "patient_pk",
                "site_code",
                k.alias("status_id"),
                exit_date.alias("exit_date"),
                pick(k % 5, ["Died", "LTFU", "Transfer out", "Stopped", "dead"]).alias("exit_reason"),
                F.concat(F.lit("Exit-"), (k % 5).cast("string")).alias("exit_description"),
                F.when(k % 3 == 0, F.date_add(exit_date, (k % 120).cast("int"))).alias("effective_discontinuation_date"),
                F.when((k % 5 == 0) | (k % 5 == 4), "Illness").alias("reason_for_death"),
                F.when(k % 4 == 0, F.date_add(exit_date, (k % 200).cast("int"))).alias("re_enrollment_date"),
                F.when(k % 25 == 0, 1).otherwise(0).alias("voided"),
            )
        )

    @cached_property
    def ct_facility_manifest(self) -> DataFrame:
        return self._ord.select(
            "site_code", F.col("k").alias("manifest_id"), shift_years(F.col("odate"), 20).alias("date_recieved")
        )

    # ---- visits / dispenses / labs -------------------------------------
    @cached_property
    def ct_patient_visits(self) -> DataFrame:
        # an open order's visit is recorded twice, with other observations
        copies = F.explode(F.sequence(F.lit(0), F.when(F.col("order_status") == "P", 1).otherwise(0)))
        k, o = F.col("k"), F.col("k") + F.col("copy")
        vd = shift_years(F.col("odate"), 20)
        return self._ord.withColumn("copy", copies).select(
            *K_COLS,
            k.alias("visit_id"),
            vd.alias("visit_date"),
            F.when(k % 7 != 0, F.date_add(vd, (k % 90).cast("int"))).alias("next_appointment_date"),
            F.when(k % 13 == 1, "120-80")
            .when(k % 13 == 2, "high/low")
            .when(k % 13 != 0, F.concat((100 + k % 80).cast("string"), F.lit("/"), (60 + k % 50).cast("string")))
            .alias("bp"),
            F.when(k % 10 != 0, (40 + k % 60).cast("double")).alias("weight"),
            (140 + k % 50).cast("double").alias("height"),
            F.when(k % 2 == 0, "Self").otherwise("Treatment supporter").alias("visit_by"),
            F.when(k % 11 == 0, "Yes").when(k % 11 == 1, "Y").when(k % 11 >= 4, "No").alias("pregnant"),
            F.when(o % 9 == 0, "Yes").when(o % 9 == 1, "").when(o % 9 != 2, "No").alias("breastfeeding"),
            F.date_sub(vd, (k % 280).cast("int")).alias("lmp"),
            F.when(k % 53 == 5, "4000000000").when(k % 53 == 6, "unknown").otherwise((k % 42).cast("string")).alias("gestation_age"),
            pick(o % 4, ["Good", "Fair", "Poor", None]).alias("adherence"),
            pick(k % 3, ["ART", "ARV Adherence", "CTX"]).alias("adherence_category"),
            pick(k % 5, [None, "Fast Track", "Community ART", "Standard Care", "Standard Care"]).alias("differentiated_care"),
            pick(k % 3, ["Stable", "Unstable", None]).alias("stability_assessment"),
            pick(k % 6, [None, "", "Condoms", "Injectable", "None", "None"]).alias("family_planning_method"),
            F.when(o % 5 != 0, (o % 5).cast("string")).alias("who_stage"),
            F.when(k % 17 == 0, 1).otherwise(0).alias("voided"),
        )

    @cached_property
    def ct_patient_pharmacy(self) -> DataFrame:
        k = F.col("k")
        dd = shift_years(F.col("sdate"), 20)
        return self._li.select(
            *K_COLS,
            (k * 10 + F.col("ln")).alias("dispense_id"),
            dd.alias("dispense_date"),
            F.when(k % 10 == 1, _d(1900, 1, 1))
            .when(k % 10 == 2, F.date_add(dd, 400))
            .when(k % 10 != 0, F.date_add(dd, (k % 60).cast("int")))
            .alias("expected_return"),
            F.when(k % 19 == 0, 1).otherwise(0).alias("voided"),
        )

    @cached_property
    def ct_patient_labs(self) -> DataFrame:
        k, ln = F.col("k"), F.col("ln")
        od = shift_years(F.col("sdate"), 20)
        q = F.floor("qty").cast("int")
        return self._li.select(
            *K_COLS,
            k.alias("visit_id"),
            (k * 1000 + ln * 100 + q).alias("lab_id"),
            od.alias("ordered_by_date"),
            F.date_add(od, (k % 14).cast("int")).alias("reported_by_date"),
            F.when(ln <= 4, "Viral Load").when(ln == 5, "HBA1C").when(ln == 6, "FBS")
            .otherwise("Hepatitis C viral load").alias("test_name"),
            F.when(k % 16 == 0, "LDL").when(k % 8 == 0, "ldl").when(k % 8 == 1, "undetectable")
            .when(k % 8 == 3, "1,200").when(k % 8 == 4, "150")
            .when(k % 8 >= 5, F.concat((q % 10).cast("string"), F.lit("."), F.lpad((k % 100).cast("string"), 2, "0")))
            .alias("test_result"),
            "emr",
            "project",
            pick(k % 3, ["Routine", "Baseline", None]).alias("reason"),
            F.when(k % 21 == 0, 1).otherwise(0).alias("voided"),
        )

    @cached_property
    def ct_ipt(self) -> DataFrame:
        k = F.col("k")
        return self._ord.select(
            "patient_pk",
            "site_code",
            k.alias("visit_id"),
            shift_years(F.col("odate"), 20).alias("visit_date"),
            pick(k % 4, [None, "Screened - Negative", "Screened - Positive", "Not Screened"]).alias("tb_screening"),
            F.when(k % 27 == 0, 1).otherwise(0).alias("voided"),
        )

    # ---- programmes -----------------------------------------------------
    @cached_property
    def ct_otz(self) -> DataFrame:
        k, pk = F.col("k"), F.col("patient_pk")
        vd = shift_years(F.col("odate"), 20)
        modules = F.concat_ws(
            ", ",
            F.when(k % 8 == 0, "Orientation"),
            F.when(k % 3 == 0, "Participation"),
            F.when(k % 5 == 0, "Leadership"),
            F.when(k % 7 == 0, "Making Decisions"),
            F.when(k % 3 == 1, "Transition"),
            F.when(k % 5 == 2, "Treatment Literacy"),
            F.when(k % 7 == 3, "srh"),
            F.when(k % 3 == 2, "Beyond"),
        )
        return self._ord.select(
            *K_COLS,
            "emr",
            k.alias("visit_id"),
            vd.alias("visit_date"),
            F.date_add(_d(2018, 1, 1), (pk % 500).cast("int")).alias("otz_enrollment_date"),
            F.when(k % 3 == 0, "Yes").otherwise("No").alias("transfer_in_status"),
            pick(k % 3, ["None", "Orientation", None]).alias("modules_previously_covered"),
            F.when(k % 20 != 0, modules).alias("modules_completed_today"),
            F.when(k % 2 == 0, "Yes").otherwise("No").alias("support_group_involvement"),
            F.when(k % 3 == 0, "ok").alias("remarks"),
            F.when(k % 6 == 0, "Transitioned to adult care").alias("transition_attrition_reason"),
            F.when(k % 6 == 0, F.date_add(vd, 30)).alias("outcome_date"),
            F.when(k % 52 == 0, 1).otherwise(0).alias("voided"),
        )

    @cached_property
    def ct_ovc(self) -> DataFrame:
        k, pk = F.col("k"), F.col("patient_pk")
        vd = shift_years(F.col("odate"), 20)
        return self._ord.select(
            *K_COLS,
            "emr",
            k.alias("visit_id"),
            vd.alias("visit_date"),
            F.date_add(_d(2017, 1, 1), (pk % 600).cast("int")).alias("ovc_enrollment_date"),
            pick(k % 3, ["Mother", "Father", "Guardian"]).alias("relationship_to_client"),
            F.when(k % 2 == 0, "Yes").otherwise("No").alias("enrolledin_cpims"),
            F.concat(F.lit("CP"), k.cast("string")).alias("cpims_unique_identifier"),
            pick(k % 4, [None, "Partner A", "Partner B", "Partner C"]).alias("partner_offering_ovc_services"),
            F.when(k % 7 == 0, "Graduated").alias("ovc_exit_reason"),
            F.when(k % 7 == 0, F.date_add(vd, 30)).alias("exit_date"),
            F.when(k % 35 == 0, 1).otherwise(0).alias("voided"),
        )

    # ---- testing / prevention -------------------------------------------
    @cached_property
    def hts_client_tests(self) -> DataFrame:
        k, ln = F.col("k"), F.col("ln")
        return self._li.select(
            "patient_pk",
            "patient_pk_hash",
            "site_code",
            (k * 10 + ln).alias("encounter_id"),
            shift_years(F.col("sdate"), 19).alias("test_date"),
            F.when(ln % 2 == 0, "Initial").otherwise("Repeat").alias("test_type"),
            "emr",
            "project",
            _d(2021, 2, 1).alias("date_extracted"),
            F.when(k % 2 == 0, "Yes").otherwise("No").alias("ever_tested_for_hiv"),
            (k % 24).cast("int").alias("months_since_last_test"),
            F.when(ln % 2 == 0, "Individual").otherwise("Couple").alias("client_tested_as"),
            pick(k % 4, ["OPD", "VCT", "PMTCT", "IPD"]).alias("entry_point"),
            pick(k % 3, ["HB", "NP", "VI"]).alias("test_strategy"),
            F.when(k % 2 == 0, "Reactive").otherwise("Non-Reactive").alias("test_result1"),
            F.when(k % 2 == 0, "Reactive").alias("test_result2"),
            pick(k % 5, [None, "Positive", "Inconclusive", "Negative", "Negative"]).alias("final_test_result"),
            F.lit("Yes").alias("patient_given_result"),
            pick(k % 3, ["No Signs", "Presumed TB", None]).alias("tb_screening"),
            F.when(k % 2 == 0, "Yes").otherwise("No").alias("client_self_tested"),
            F.when(ln % 2 == 1, "No").alias("couple_discordant"),
            F.when(k % 2 == 0, "Facility").otherwise("Community").alias("setting"),
            F.lit("Yes").alias("consent"),
        )

    @cached_property
    def prep_patient(self) -> DataFrame:
        first = self._li.groupBy("patient_pk", "patient_pk_hash", "site_code").agg(
            F.min(shift_years(F.col("sdate"), 19)).alias("first_dispense")
        )
        pk = F.col("patient_pk")
        pn = F.concat(F.lit("P"), pk.cast("string"))
        return first.select(
            pn.alias("prep_number"),
            sha_upper(pn).alias("prep_number_hash"),
            "patient_pk",
            "patient_pk_hash",
            F.date_sub(F.col("first_dispense"), (20 + pk % 25).cast("int")).alias("prep_enrollment_date"),
            "site_code",
        )

    @cached_property
    def prep_pharmacy(self) -> DataFrame:
        k, ln = F.col("k"), F.col("ln")
        return self._li.select(
            F.concat(F.lit("P"), F.col("patient_pk").cast("string")).alias("prep_number"),
            "patient_pk",
            "site_code",
            (k * 10 + ln).alias("dispense_id"),
            F.concat(F.lit("H"), k.cast("string")).alias("hts_number"),
            pick(ln % 3, ["TDF/FTC", "TDF/3TC", "TDF"]).alias("regimen_prescribed"),
            shift_years(F.col("sdate"), 19).alias("dispense_date"),
        )

    @cached_property
    def prep_visits(self) -> DataFrame:
        k = F.col("k")
        return self._ord.select(
            "patient_pk",
            "patient_pk_hash",
            "site_code",
            k.alias("encounter_id"),
            k.alias("visit_id"),
            F.when(k % 33 != 0, shift_years(F.col("odate"), 19)).alias("visit_date"),
            *[generated_text(k, i).alias(c) for i, c in enumerate(PREP_VISIT_COLUMNS)],
        )

    @cached_property
    def prep_behaviour_risk(self) -> DataFrame:
        k = F.col("k")
        vd = F.when(k % 40 != 9, shift_years(F.col("odate"), 19))
        ccc = (
            F.when(k % 16 == 1, F.concat(F.lit("CCC-"), F.lpad(k.cast("string"), 36, "0")))
            .when(k % 16 != 5, F.concat(F.lit("CCC-"), k.cast("string")))
        )
        return self._ord.select(
            "patient_pk",
            "patient_pk_hash",
            "site_code",
            vd.alias("visit_date"),
            k.alias("visit_id"),
            *[generated_text(k, i).alias(c) for i, c in enumerate(RISK_TEXT_COLUMNS)],
            ccc.alias("hiv_partner_ccc_number"),
            F.when(k % 3 == 0, F.date_sub(vd, (k % 300).cast("int"))).alias("hiv_partner_art_start_date"),
            F.when(k % 8 == 1, "Risk").otherwise("No Risk").alias("client_risk"),
        )

    # ---- maternal sources -----------------------------------------------
    @cached_property
    def mnch_anc_visits(self) -> DataFrame:
        k = F.col("k")
        return self._ord.select(
            "patient_pk", "patient_pk_hash", "site_code", k.alias("visit_id"),
            shift_years(F.col("odate"), 20).alias("visit_date"),
            F.when(k % 5 != 0, F.when(k % 18 == 0, "KP").when(k % 18 == 6, "Negative").otherwise("Unknown"))
            .alias("hiv_status_before_anc"),
            F.when(k % 4 == 0, "Positive").otherwise("Negative").alias("hiv_test_final_result"),
        )

    @cached_property
    def mnch_pnc_visits(self) -> DataFrame:
        k = F.col("k")
        return self._ord.select(
            "patient_pk", "patient_pk_hash", "site_code", k.alias("visit_id"),
            shift_years(F.col("odate"), 20).alias("visit_date"),
            F.when(k % 18 == 1, "Positive").when(k % 18 == 7, "Negative").otherwise("Unknown").alias("prior_hiv_status"),
            F.when(k % 5 == 0, "Positive").otherwise("Negative").alias("hiv_test_final_result"),
            pick(k % 3, ["Exclusive breastfeeding", "mixed feeding", "Not breastfeeding"]).alias("baby_feeding"),
        )

    @cached_property
    def mnch_mat_visits(self) -> DataFrame:
        k = F.col("k")
        return self._ord.select(
            "patient_pk", "patient_pk_hash", "site_code", k.alias("visit_id"),
            shift_years(F.col("odate"), 20).alias("visit_date"),
            F.when(k % 5 == 0, "Positive").otherwise("Negative").alias("hiv_test_final_result"),
            F.when(k % 3 == 0, "Yes").otherwise("No").alias("on_art_anc"),
            F.when(k % 4 == 2, "Yes").otherwise("No").alias("initiated_bf"),
        )

    @cached_property
    def mnch_arts(self) -> DataFrame:
        k = F.col("k")
        return self._ord.select(
            "patient_pk", "site_code", k.alias("art_id"), shift_years(F.col("odate"), 20).alias("start_art_date")
        )

    @cached_property
    def mnch_enrolments(self) -> DataFrame:
        k = F.col("k")
        return self._ord.select(
            "patient_pk", "site_code", k.alias("enrolment_id"),
            pick(k % 3, ["KP", "Positive", "Negative"]).alias("hiv_status_before_anc"),
            shift_years(F.col("odate"), 20).alias("enrollment_date_at_mnch"),
        )


TABLES = [
    "ct_patient", "ct_art_patients", "ct_patient_status", "ct_facility_manifest", "ct_patient_visits",
    "ct_patient_pharmacy", "ct_patient_labs", "ct_ipt", "ct_otz", "ct_ovc", "hts_client_tests",
    "prep_patient", "prep_pharmacy", "prep_visits", "prep_behaviour_risk", "mnch_anc_visits",
    "mnch_pnc_visits", "mnch_mat_visits", "mnch_arts", "mnch_enrolments",
]
