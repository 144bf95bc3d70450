"""Last adolescent-programme visit per patient and EMR (D18) and last
orphans/vulnerable-children visit (D19)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlake.functions import contains_flags
from cohortlake.operators import latest_per_key, live
from cohortlake.params import AsOf
from cohortlake.plans import KEY

# Module flag name -> text searched for in the completed-modules list.
OTZ_MODULES = {
    "modules_completed_today_otz_orientation": "Orientation",
    "modules_completed_today_otz_participation": "Participation",
    "modules_completed_today_otz_leadership": "Leadership",
    "modules_completed_today_otz_making_decisions": "Making Decisions",
    "modules_completed_today_otz_transition": "Transition",
    "modules_completed_today_otz_treatment_literacy": "Treatment Literacy",
    "modules_completed_today_otz_srh": "SRH",
    "modules_completed_today_otz_beyond": "Beyon",
}


def last_otz_visit(otz: DataFrame, as_of) -> DataFrame:
    """Newest live visit per (key, EMR) with one 0/1 flag per module."""
    a = AsOf.of(as_of)
    top = latest_per_key(live(otz), [*KEY, "emr"], "visit_date", ["visit_id"])
    return top.select(
        "site_code", "patient_pk", "patient_id", "patient_pk_hash", "patient_id_hash", "emr",
        F.col("visit_date").alias("last_visit_date"),
        "otz_enrollment_date", "transfer_in_status", "transition_attrition_reason", "modules_previously_covered",
        *contains_flags("modules_completed_today", OTZ_MODULES),
        a.load_date(),
    )


def last_ovc_visit(ovc: DataFrame, as_of) -> DataFrame:
    """Newest live visit per key (visit date emitted twice, as in the source)."""
    a = AsOf.of(as_of)
    top = latest_per_key(live(ovc), KEY, "visit_date", ["visit_id"])
    return top.select(
        F.col("visit_date").alias("latest_visit_date"),
        "patient_id", "site_code", "patient_pk", "patient_id_hash", "patient_pk_hash", "emr", "visit_date", "visit_id",
        "ovc_enrollment_date", "relationship_to_client", "enrolledin_cpims", "cpims_unique_identifier",
        "partner_offering_ovc_services", "ovc_exit_reason", "exit_date",
        a.load_date(),
    )
