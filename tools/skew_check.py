"""Skew check: one key holds a third of all rows; report, per operator, the
largest number of shuffle records any single task reads, from Spark's event
log written to a scratch folder (no UI). Broadcast joins are disabled, as
for large inputs; AQE stays on (with skew-join splitting) but partition
coalescing is off, so one reduce task reads exactly one hash partition and
an even share is rows / 16.

    python tools/skew_check.py SCRATCH_DIR [ROWS]
    python tools/skew_check.py SCRATCH_DIR ROWS datasets

With ``datasets``, whole datasets run on base tables in which one client holds a third of all
events (and, for D06, 3,000 treatment rows); beside the shuffle records, the most rows that any operator
of one task after a shuffle puts out are reported.
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402


def _events(log_dir: str):
    import zstandard

    for d in sorted(glob.glob(os.path.join(log_dir, "eventlog_v2_*"))):
        for f in sorted(glob.glob(os.path.join(d, "events_*"))):
            with open(f, "rb") as fh:
                stream = zstandard.ZstdDecompressor().stream_reader(fh) if f.endswith(".zstd") else fh
                for line in io.TextIOWrapper(stream, encoding="utf-8"):
                    yield json.loads(line)


def base_tables(spark, n: int, treatment_rows: int):
    """Base tables of ``n`` events each, a third of them of client 0."""
    from types import SimpleNamespace

    keys = max(1000, n // 30)
    day = lambda c, span: F.date_add(F.lit("2009-01-01").cast("date"), (F.col(c) % span).cast("int"))
    seen = F.date_add(F.lit("2011-06-01").cast("date"), (F.col("id") % 3000).cast("int"))  # after all events, every row another day
    who = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % keys)
    client = [F.lit(1).alias("site_code"), F.col("pk").alias("patient_pk"), *[F.concat(F.lit(c), F.col("pk").cast("string")).alias(c) for c in ("patient_id", "patient_pk_hash", "patient_id_hash")]]
    events = spark.range(0, n, 1, 16).withColumn("pk", who)
    people = spark.range(0, keys, 1, 16).withColumn("pk", F.col("id"))
    more = spark.range(0, treatment_rows, 1, 4).withColumn("pk", F.lit(0).cast("long"))
    text = lambda name, count: F.concat(F.lit(name), (F.col("id") % count).cast("string")).alias(name)
    live = F.lit(0).alias("voided")
    visit = events.select(*client, F.col("id").alias("visit_id"), day("id", 700).alias("visit_date"), F.date_add(day("id", 700), 30).alias("next_appointment_date"), F.lit("120/80").alias("bp"),
                          F.lit(50.0).alias("weight"), F.lit(150.0).alias("height"), text("visit_by", 3), F.when(F.col("id") % 5 == 0, "Yes").otherwise("No").alias("pregnant"),
                          F.lit("No").alias("breastfeeding"), day("id", 300).alias("lmp"), F.lit("12").alias("gestation_age"), text("adherence", 4), F.lit("ART").alias("adherence_category"),
                          text("differentiated_care", 3), text("stability_assessment", 2), text("family_planning_method", 3), text("who_stage", 4), live)
    dispense = events.select(*client, F.col("id").alias("dispense_id"), day("id", 700).alias("dispense_date"), F.date_add(day("id", 700), 60).alias("expected_return"), live)
    art = people.unionByName(more).select(*client, F.lit("2009-01-01").cast("date").alias("start_art_date"), seen.alias("last_visit"),
                                          F.date_add(seen, (F.col("id") * 7 % 90).cast("int")).alias("expected_return"), F.lit("1980-01-01").cast("date").alias("dob"), live)
    test = events.select(*client[:2], client[3], F.col("id").alias("encounter_id"), day("id", 700).alias("test_date"), text("final_test_result", 3))
    hts = test
    prep = people.select(*client[:2], client[3], F.concat(F.lit("P"), F.col("pk").cast("string")).alias("prep_number"), F.lit("h").alias("prep_number_hash"), F.lit("2008-12-01").cast("date").alias("prep_enrollment_date"))
    refill = events.select(*client[:2], F.concat(F.lit("P"), F.col("pk").cast("string")).alias("prep_number"), F.col("id").alias("dispense_id"), day("id", 700).alias("dispense_date"))
    status = people.select(*client[:2], F.col("id").alias("status_id"), day("id", 700).alias("exit_date"), F.lit("LTFU").alias("exit_reason"),
                           *[F.lit(None).cast("date").alias(c) for c in ("effective_discontinuation_date", "re_enrollment_date")], live)
    mnch = events.select(*client[:2], client[3], F.col("id").alias("visit_id"), day("id", 700).alias("visit_date"), F.lit("KP").alias("hiv_status_before_anc"), F.lit("Positive").alias("hiv_test_final_result"),
                         F.lit("Positive").alias("prior_hiv_status"), F.lit("mixed feeding").alias("baby_feeding"), F.lit("Yes").alias("on_art_anc"), F.lit("Yes").alias("initiated_bf"))
    return SimpleNamespace(
        ct_patient=people.select(*client, F.lit("1980-01-01").cast("date").alias("dob"), F.lit("Female").alias("gender"), F.lit("2019-01-01").cast("date").alias("registration_at_ccc"),
                                 F.lit("2019-01-01").cast("date").alias("date_confirmed_hiv_positive"), F.lit("e").alias("emr"), F.lit("p").alias("project"), live),
        ct_art_patients=art, ct_patient_visits=visit, ct_patient_pharmacy=dispense, ct_patient_status=status,
        ct_facility_manifest=people.select(F.lit(1).alias("site_code"), F.col("id").alias("manifest_id"), day("id", 700).alias("date_recieved")),
        ct_ipt=events.select(*client[:2], F.col("id").alias("visit_id"), day("id", 700).alias("visit_date"), text("tb_screening", 3), live),
        ct_patient_labs=events.select(*client, F.col("id").alias("visit_id"), F.col("id").alias("lab_id"), day("id", 700).alias("ordered_by_date"), day("id", 700).alias("reported_by_date"),
                                      F.lit("Viral Load").alias("test_name"), (F.col("id") % 900).cast("string").alias("test_result"), F.lit("e").alias("emr"), F.lit("p").alias("project"), F.lit("r").alias("reason"), live),
        hts_client_tests=hts, prep_patient=prep, prep_pharmacy=refill, mnch_anc_visits=mnch, mnch_pnc_visits=mnch, mnch_mat_visits=mnch,
        mnch_arts=people.select(*client[:2], F.col("id").alias("art_id"), F.lit("2019-01-01").cast("date").alias("start_art_date")),
        mnch_enrolments=people.select(*client[:2], F.col("id").alias("enrolment_id"), F.lit("KP").alias("hiv_status_before_anc"), F.lit("2019-01-01").cast("date").alias("enrollment_date_at_mnch")),
    )


def dataset_jobs(spark, n: int) -> dict:
    from cohortlake.plans.graph import DatasetGraph

    few, many = (DatasetGraph(base_tables(spark, n, rows), "2021-02-15") for rows in (100, 3000))
    return {"d06 (3,000 treatment rows of one client)": many.get("d06")} | {ds: few.get(ds) for ds in ("d06", "d07", "d09", "d10", "d14", "d23")}


def main() -> None:
    scratch = sys.argv[1]
    n = int(sys.argv[2]) if len(sys.argv) > 2 else 3_000_000
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", scratch)
             .config("spark.sql.shuffle.partitions", "16")
             .config("spark.sql.autoBroadcastJoinThreshold", "-1")
             .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
             .config("spark.sql.adaptive.coalescePartitions.enabled", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    from cohortlake.operators import (follow_up_in_window, join_group_facts, latest_by_group, latest_per_key,
                                      rows_at_event, top_n_per_key, value_at_months)

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")   # one task = one partition
    keys = 100_000
    ev = spark.range(0, n, 1, 16).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % keys).alias("k"), "id",
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 700).cast("int")).alias("d"))
    anchors = spark.range(0, keys, 1, 16).select(F.col("id").alias("k"), F.lit("2020-01-01").cast("date").alias("a"),
                                                 (F.col("id") * 7).alias("aid"))
    last = latest_per_key(ev, ["k"], "d", ["id"])
    sites = ev.withColumn("g", F.when(F.col("k") == 0, F.lit(0)).otherwise(F.col("k") % 50))
    whole = len(sys.argv) > 3 and sys.argv[3] == "datasets"
    jobs = dataset_jobs(spark, n) if whole else {
        "latest_per_key": latest_per_key(ev, ["k"], "d", ["id"]),
        "top_n_per_key": top_n_per_key(ev, ["k"], "d", ["id"], n=10),
        "value_at_months": value_at_months(ev, anchors, ["k"], "d", "a", [6, 12], ["id"]),
        "follow_up_in_window": follow_up_in_window(ev, anchors, ["k"], "d", "a", 60, 67),
        "rows_at_event": rows_at_event(ev, last, ["k"], "d", "id"),
        # per-group facts (50 groups, group 0 holding a third of the rows, like one big site)
        "join_group_facts": join_group_facts(sites, latest_by_group(sites, ["g"], "d", "g_last"), ["g"], ["id"]),
        "plain_join_on_hot_group (contrast)": sites.join(latest_by_group(sites, ["g"], "d", "g_last"), "g", "left"),
    }
    for name, df in jobs.items():
        spark.sparkContext.setJobDescription(name)
        df.write.format("noop").mode("overwrite").save()
    spark.stop()

    stage_job: dict[int, str] = {}
    worst: dict[str, int] = {}
    made: dict[str, int] = {}
    for e in _events(scratch):
        if e.get("Event") == "SparkListenerJobStart":
            desc = (e.get("Properties") or {}).get("spark.job.description")
            for sid in e.get("Stage IDs", []):
                stage_job[sid] = desc
        elif e.get("Event") == "SparkListenerTaskEnd":
            name = stage_job.get(e["Stage ID"])
            read = ((e.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
            if name:
                worst[name] = max(worst.get(name, 0), read)
                out = [int(a["Update"]) for a in e["Task Info"].get("Accumulables", []) if a.get("Name") == "number of output rows" and str(a.get("Update", "")).isdigit()]
                if read:
                    made[name] = max([made.get(name, 0), *out])
    print(json.dumps({"rows": n, "hot_key_rows": n // 3 + 1, "max_shuffle_records_read_by_one_task": worst}
                     | ({"max_rows_of_one_operator_in_a_task": made} if whole else {})))


if __name__ == "__main__":
    main()
