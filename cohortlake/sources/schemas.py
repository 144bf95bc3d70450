"""Registry of the base tables: the columns that the datasets read, with their types.

A table read through ``TableSet``, ``CatalogTables`` or ``JdbcTables`` is held against it. Columns
of the named type are passed on as they are, so predicates still reach the reader. Columns of
another type are cast, and a value that the cast cannot take ends the job with the table, the
column and the value; a missing column is an error when the table is opened, not
a wrong result later. Dates may carry a time of day. Columns the registry does not know pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlake.plans.schema import PREP_VISIT_COLUMNS, RISK_TEXT_COLUMNS

#: Type names of the registry; "any" is a column that is only carried along.
TYPES = {"int": T.IntegerType(), "long": T.LongType(), "date": T.DateType(), "double": T.DoubleType(), "text": T.StringType(), "any": None}


def _columns(**by_type: str) -> dict[str, str]:
    return {name: kind for kind, names in by_type.items() for name in names.split()}


#: The key of a client at a site, and all of their identifiers.
_KEY = _columns(int="site_code", long="patient_pk")
_CLIENT = _KEY | _columns(text="patient_id patient_pk_hash patient_id_hash")
_HASHED = _KEY | _columns(text="patient_pk_hash")
_LIVE = _columns(int="voided")

#: The columns that the datasets read, by table.
TABLE_COLUMNS: dict[str, dict[str, str]] = {
    "ct_patient": _CLIENT | _LIVE | _columns(date="dob registration_at_ccc date_confirmed_hiv_positive", text="gender", any="emr project"),
    "ct_art_patients": _CLIENT | _LIVE | _columns(date="start_art_date last_visit expected_return dob"),
    "ct_patient_status": _KEY | _LIVE | _columns(long="status_id", date="exit_date effective_discontinuation_date re_enrollment_date", text="exit_reason"),
    "ct_facility_manifest": _columns(int="site_code", date="date_recieved"),
    "ct_patient_visits": _CLIENT | _LIVE | _columns(
        long="visit_id", date="visit_date next_appointment_date lmp", double="weight height",
        text="bp pregnant breastfeeding gestation_age adherence adherence_category differentiated_care stability_assessment family_planning_method who_stage",
        any="visit_by"),
    "ct_patient_pharmacy": _CLIENT | _LIVE | _columns(long="dispense_id", date="dispense_date expected_return"),
    "ct_patient_labs": _CLIENT | _LIVE | _columns(long="lab_id", date="ordered_by_date", text="test_name test_result", any="visit_id reported_by_date emr project reason"),
    "ct_ipt": _KEY | _LIVE | _columns(long="visit_id", date="visit_date", text="tb_screening"),
    "ct_otz": _CLIENT | _LIVE | _columns(
        long="visit_id", date="visit_date", text="modules_completed_today",
        any="emr otz_enrollment_date transfer_in_status modules_previously_covered support_group_involvement remarks transition_attrition_reason outcome_date"),
    "ct_ovc": _CLIENT | _LIVE | _columns(
        long="visit_id", date="visit_date",
        any="emr ovc_enrollment_date relationship_to_client enrolledin_cpims cpims_unique_identifier partner_offering_ovc_services ovc_exit_reason exit_date"),
    "hts_client_tests": _HASHED | _columns(
        long="encounter_id", date="test_date", text="test_type final_test_result",
        any="emr project date_extracted ever_tested_for_hiv months_since_last_test client_tested_as entry_point test_strategy test_result1 test_result2 "
            "patient_given_result tb_screening client_self_tested couple_discordant setting consent"),
    "prep_patient": _HASHED | _columns(text="prep_number prep_number_hash", date="prep_enrollment_date"),
    "prep_pharmacy": _KEY | _columns(text="prep_number", long="dispense_id", date="dispense_date"),
    "prep_visits": _HASHED | _columns(long="visit_id", date="visit_date", any=" ".join(["encounter_id", *PREP_VISIT_COLUMNS])),
    "prep_behaviour_risk": _HASHED | _columns(long="visit_id", date="visit_date", text="hiv_partner_ccc_number client_risk",
                                              any=" ".join(["hiv_partner_art_start_date", *RISK_TEXT_COLUMNS])),
    "mnch_anc_visits": _HASHED | _columns(long="visit_id", date="visit_date", text="hiv_status_before_anc hiv_test_final_result"),
    "mnch_pnc_visits": _HASHED | _columns(long="visit_id", date="visit_date", text="prior_hiv_status hiv_test_final_result baby_feeding"),
    "mnch_mat_visits": _HASHED | _columns(long="visit_id", date="visit_date", text="hiv_test_final_result on_art_anc initiated_bf"),
    "mnch_arts": _KEY | _columns(long="art_id", date="start_art_date"),
    "mnch_enrolments": _KEY | _columns(long="enrolment_id", date="enrollment_date_at_mnch", text="hiv_status_before_anc"),
}


class SchemaError(ValueError):
    """A base table lacks columns, or holds types that cannot be cast."""


def _fits(have: T.DataType, want: T.DataType | None) -> bool:
    if want is None or have == want:
        return True
    if isinstance(want, T.DateType):
        return isinstance(have, (T.TimestampType, T.TimestampNTZType))
    # a narrower integer compares and joins like the wider one
    return isinstance(want, T.LongType) and isinstance(have, (T.ByteType, T.ShortType, T.IntegerType))


def _cast(table: str, name: str, have: T.DataType, want: T.DataType) -> Column:
    value = F.col(name)
    text = F.trim(value.cast("string")) if isinstance(have, T.StringType) else value
    made = text.try_cast(want) if not isinstance(have, T.BooleanType) else value.cast("int").cast(want)
    if isinstance(want, T.IntegralType) and isinstance(have, (T.FractionalType, T.StringType)):
        # 1.5 is no id and no flag
        whole = text.try_cast("decimal(38,10)")
        made = F.when(whole == F.floor(whole), whole.try_cast(want))
    said = F.concat(F.lit(f"{table}.{name}: not a {want.simpleString()}: "), value.cast("string"))
    return F.when(value.isNull() | made.isNotNull(), made).otherwise(F.raise_error(said).cast(want)).alias(name)


def conform(df: DataFrame, table: str) -> DataFrame:
    """``df`` held against the registry's columns of ``table``; tables it does not know are left alone."""
    wanted = TABLE_COLUMNS.get(table)
    if wanted is None:
        return df
    have = {f.name: f.dataType for f in df.schema.fields}
    missing = sorted(wanted.keys() - have.keys())
    if missing:
        raise SchemaError(f"{table} lacks {', '.join(missing)}; it has {', '.join(have)}")
    odd = {n for n, kind in wanted.items() if not _fits(have[n], TYPES[kind])}
    complex_ = [n for n in odd if isinstance(have[n], (T.ArrayType, T.MapType, T.StructType, T.BinaryType))]
    if complex_:
        raise SchemaError(", ".join(f"{table}.{n} is {have[n].simpleString()}, not {wanted[n]}" for n in sorted(complex_)))
    if not odd:
        return df
    return df.select(*[_cast(table, f.name, f.dataType, TYPES[wanted[f.name]]) if f.name in odd else F.col(f.name) for f in df.schema.fields])
