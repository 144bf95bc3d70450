"""DuckDB SQL for the fixture adapter (FIXTURES.md Part 2), written
independently of the Spark code in ``cohortlake/sources/adapter.py``.

``prelude(names)`` returns the ``WITH`` items for the requested clinical
tables (plus the shared bases), to be followed by a query's own CTEs.
"""

from __future__ import annotations

from oracle.fixed import PREP_VISIT_COLUMNS, RISK_TEXT_COLUMNS


def d20(x: str) -> str:
    return f"CAST({x} + INTERVAL 20 YEAR AS DATE)"


def d19(x: str) -> str:
    return f"CAST({x} + INTERVAL 19 YEAR AS DATE)"


def gen_text(i: int) -> str:
    return f"CASE WHEN k % {2 + i % 5} <> 0 THEN 'v{i}-' || CAST(k % {3 + i % 7} AS VARCHAR) END"


K = "patient_id, site_code, patient_pk, patient_pk_hash, patient_id_hash"

BASES = {
    "_cust": """
SELECT c_custkey AS patient_pk, c_nationkey AS site_code, c_name AS patient_id,
       upper(sha256(CAST(c_custkey AS VARCHAR))) AS patient_pk_hash,
       upper(sha256(c_name)) AS patient_id_hash,
       c_mktsegment AS emr, 'Project-' || CAST(c_custkey % 3 AS VARCHAR) AS project
FROM customer""",
    "_ord": """
SELECT o.o_orderkey AS k, o.o_orderstatus AS order_status, CAST(o.o_orderdate AS DATE) AS odate, c.*
FROM orders o JOIN _cust c ON c.patient_pk = o.o_custkey""",
    "_li": """
SELECT l.l_orderkey AS k, l.l_linenumber AS ln, l.l_quantity AS qty, CAST(l.l_shipdate AS DATE) AS sdate,
       o.patient_pk, o.site_code, o.patient_id, o.patient_pk_hash, o.patient_id_hash, o.emr, o.project
FROM lineitem l JOIN _ord o ON o.k = l.l_orderkey""",
}

TABLES = {
    "ct_patient": f"""
SELECT {K},
  DATE '1950-01-01' + CAST(patient_pk * 37 % 18000 AS INTEGER) AS dob,
  CASE WHEN patient_pk % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender,
  DATE '2015-01-01' + CAST(patient_pk % 700 AS INTEGER) AS registration_at_ccc,
  CASE WHEN patient_pk % 6 <> 0 THEN DATE '2015-03-01' + CAST(patient_pk * 13 % 2200 AS INTEGER) END
    AS date_confirmed_hiv_positive,
  emr, project,
  CASE WHEN patient_pk % 23 = 0 THEN 1 ELSE 0 END AS voided
FROM _cust""",
    "ct_art_patients": f"""
SELECT {K},
  CASE WHEN patient_pk % 31 = 0 THEN NULL WHEN status = 'P' THEN DATE '2021-02-01' + CAST(patient_pk % 10 AS INTEGER)
       ELSE DATE '2015-06-01' + CAST(patient_pk * 11 % 900 AS INTEGER) END AS start_art_date,
  lv AS last_visit,
  CASE WHEN patient_pk % 9 <> 0 THEN lv + CAST(patient_pk % 400 AS INTEGER) END AS expected_return,
  DATE '1950-01-01' + CAST(patient_pk * 37 % 18000 AS INTEGER) AS dob,
  CASE WHEN patient_pk % 29 = 0 THEN 1 ELSE 0 END AS voided
FROM (
  SELECT c.*, f.status, {d20('f.first_order')} + 1500 AS lv
  FROM _cust c LEFT JOIN (
    SELECT o_custkey, o_orderstatus AS status, min(CAST(o_orderdate AS DATE)) AS first_order FROM orders GROUP BY ALL) f
  ON c.patient_pk = f.o_custkey)""",
    "ct_patient_status": f"""
SELECT patient_pk, site_code, k AS status_id, ed AS exit_date,
  CASE k % 5 WHEN 0 THEN 'Died' WHEN 1 THEN 'LTFU' WHEN 2 THEN 'Transfer out' WHEN 3 THEN 'Stopped' ELSE 'dead' END
    AS exit_reason,
  'Exit-' || CAST(k % 5 AS VARCHAR) AS exit_description,
  CASE WHEN k % 3 = 0 THEN ed + CAST(k % 120 AS INTEGER) END AS effective_discontinuation_date,
  CASE WHEN k % 5 IN (0, 4) THEN 'Illness' END AS reason_for_death,
  CASE WHEN k % 4 = 0 THEN ed + CAST(k % 200 AS INTEGER) END AS re_enrollment_date,
  CASE WHEN k % 25 = 0 THEN 1 ELSE 0 END AS voided
FROM (SELECT *, CAST(odate + INTERVAL 308 MONTH AS DATE) AS ed FROM _ord WHERE order_status = 'P')""",
    "ct_facility_manifest": f"""
SELECT site_code, k AS manifest_id, {d20('odate')} AS date_recieved FROM _ord""",
    "ct_patient_visits": f"""
SELECT {K}, k AS visit_id, vd AS visit_date,
  CASE WHEN k % 7 <> 0 THEN vd + CAST(k % 90 AS INTEGER) END AS next_appointment_date,
  CASE WHEN k % 13 = 1 THEN '120-80' WHEN k % 13 = 2 THEN 'high/low'
       WHEN k % 13 <> 0 THEN CAST(100 + k % 80 AS VARCHAR) || '/' || CAST(60 + k % 50 AS VARCHAR) END AS bp,
  CASE WHEN k % 10 <> 0 THEN CAST(40 + k % 60 AS DOUBLE) END AS weight,
  CAST(140 + k % 50 AS DOUBLE) AS height,
  CASE WHEN k % 2 = 0 THEN 'Self' ELSE 'Treatment supporter' END AS visit_by,
  CASE WHEN k % 11 = 0 THEN 'Yes' WHEN k % 11 = 1 THEN 'Y' WHEN k % 11 >= 4 THEN 'No' END AS pregnant,
  CASE WHEN o % 9 = 0 THEN 'Yes' WHEN o % 9 = 1 THEN '' WHEN o % 9 <> 2 THEN 'No' END AS breastfeeding,
  vd - CAST(k % 280 AS INTEGER) AS lmp,
  CASE k % 53 WHEN 5 THEN '4000000000' WHEN 6 THEN 'unknown' ELSE CAST(k % 42 AS VARCHAR) END AS gestation_age,
  CASE o % 4 WHEN 0 THEN 'Good' WHEN 1 THEN 'Fair' WHEN 2 THEN 'Poor' END AS adherence,
  CASE k % 3 WHEN 0 THEN 'ART' WHEN 1 THEN 'ARV Adherence' ELSE 'CTX' END AS adherence_category,
  CASE k % 5 WHEN 0 THEN NULL WHEN 1 THEN 'Fast Track' WHEN 2 THEN 'Community ART' ELSE 'Standard Care' END
    AS differentiated_care,
  CASE k % 3 WHEN 0 THEN 'Stable' WHEN 1 THEN 'Unstable' END AS stability_assessment,
  CASE k % 6 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'Condoms' WHEN 3 THEN 'Injectable' ELSE 'None' END
    AS family_planning_method,
  CASE WHEN o % 5 <> 0 THEN CAST(o % 5 AS VARCHAR) END AS who_stage,
  CASE WHEN k % 17 = 0 THEN 1 ELSE 0 END AS voided
FROM (SELECT _ord.*, {d20('odate')} AS vd, k + copy AS o
      FROM _ord, LATERAL (SELECT unnest(CASE WHEN order_status = 'P' THEN [0, 1] ELSE [0] END) AS copy))""",
    "ct_patient_pharmacy": f"""
SELECT {K}, k * 10 + ln AS dispense_id, dd AS dispense_date,
  CASE WHEN k % 10 = 1 THEN DATE '1900-01-01' WHEN k % 10 = 2 THEN dd + 400
       WHEN k % 10 <> 0 THEN dd + CAST(k % 60 AS INTEGER) END AS expected_return,
  CASE WHEN k % 19 = 0 THEN 1 ELSE 0 END AS voided
FROM (SELECT *, {d20('sdate')} AS dd FROM _li)""",
    "ct_patient_labs": f"""
SELECT {K}, k AS visit_id, k * 1000 + ln * 100 + CAST(floor(qty) AS INTEGER) AS lab_id,
  od AS ordered_by_date, od + CAST(k % 14 AS INTEGER) AS reported_by_date,
  CASE WHEN ln <= 4 THEN 'Viral Load' WHEN ln = 5 THEN 'HBA1C' WHEN ln = 6 THEN 'FBS'
       ELSE 'Hepatitis C viral load' END AS test_name,
  CASE WHEN k % 16 = 0 THEN 'LDL' WHEN k % 8 = 0 THEN 'ldl' WHEN k % 8 = 1 THEN 'undetectable'
       WHEN k % 8 = 3 THEN '1,200' WHEN k % 8 = 4 THEN '150'
       WHEN k % 8 >= 5 THEN CAST(CAST(floor(qty) AS INTEGER) % 10 AS VARCHAR) || '.' || lpad(CAST(k % 100 AS VARCHAR), 2, '0')
  END AS test_result,
  emr, project,
  CASE k % 3 WHEN 0 THEN 'Routine' WHEN 1 THEN 'Baseline' END AS reason,
  CASE WHEN k % 21 = 0 THEN 1 ELSE 0 END AS voided
FROM (SELECT *, {d20('sdate')} AS od FROM _li)""",
    "ct_ipt": f"""
SELECT patient_pk, site_code, k AS visit_id, {d20('odate')} AS visit_date,
  CASE k % 4 WHEN 1 THEN 'Screened - Negative' WHEN 2 THEN 'Screened - Positive' WHEN 3 THEN 'Not Screened' END
    AS tb_screening,
  CASE WHEN k % 27 = 0 THEN 1 ELSE 0 END AS voided
FROM _ord""",
    "ct_otz": f"""
SELECT {K}, emr, k AS visit_id, vd AS visit_date,
  DATE '2018-01-01' + CAST(patient_pk % 500 AS INTEGER) AS otz_enrollment_date,
  CASE WHEN k % 3 = 0 THEN 'Yes' ELSE 'No' END AS transfer_in_status,
  CASE k % 3 WHEN 0 THEN 'None' WHEN 1 THEN 'Orientation' END AS modules_previously_covered,
  CASE WHEN k % 20 <> 0 THEN concat_ws(', ',
      CASE WHEN k % 8 = 0 THEN 'Orientation' END,
      CASE WHEN k % 3 = 0 THEN 'Participation' END,
      CASE WHEN k % 5 = 0 THEN 'Leadership' END,
      CASE WHEN k % 7 = 0 THEN 'Making Decisions' END,
      CASE WHEN k % 3 = 1 THEN 'Transition' END,
      CASE WHEN k % 5 = 2 THEN 'Treatment Literacy' END,
      CASE WHEN k % 7 = 3 THEN 'srh' END,
      CASE WHEN k % 3 = 2 THEN 'Beyond' END) END AS modules_completed_today,
  CASE WHEN k % 2 = 0 THEN 'Yes' ELSE 'No' END AS support_group_involvement,
  CASE WHEN k % 3 = 0 THEN 'ok' END AS remarks,
  CASE WHEN k % 6 = 0 THEN 'Transitioned to adult care' END AS transition_attrition_reason,
  CASE WHEN k % 6 = 0 THEN vd + 30 END AS outcome_date,
  CASE WHEN k % 52 = 0 THEN 1 ELSE 0 END AS voided
FROM (SELECT *, {d20('odate')} AS vd FROM _ord)""",
    "ct_ovc": f"""
SELECT {K}, emr, k AS visit_id, vd AS visit_date,
  DATE '2017-01-01' + CAST(patient_pk % 600 AS INTEGER) AS ovc_enrollment_date,
  CASE k % 3 WHEN 0 THEN 'Mother' WHEN 1 THEN 'Father' ELSE 'Guardian' END AS relationship_to_client,
  CASE WHEN k % 2 = 0 THEN 'Yes' ELSE 'No' END AS enrolledin_cpims,
  'CP' || CAST(k AS VARCHAR) AS cpims_unique_identifier,
  CASE k % 4 WHEN 1 THEN 'Partner A' WHEN 2 THEN 'Partner B' WHEN 3 THEN 'Partner C' END
    AS partner_offering_ovc_services,
  CASE WHEN k % 7 = 0 THEN 'Graduated' END AS ovc_exit_reason,
  CASE WHEN k % 7 = 0 THEN vd + 30 END AS exit_date,
  CASE WHEN k % 35 = 0 THEN 1 ELSE 0 END AS voided
FROM (SELECT *, {d20('odate')} AS vd FROM _ord)""",
    "hts_client_tests": f"""
SELECT patient_pk, patient_pk_hash, site_code, k * 10 + ln AS encounter_id, {d19('sdate')} AS test_date,
  CASE WHEN ln % 2 = 0 THEN 'Initial' ELSE 'Repeat' END AS test_type,
  emr, project, DATE '2021-02-01' AS date_extracted,
  CASE WHEN k % 2 = 0 THEN 'Yes' ELSE 'No' END AS ever_tested_for_hiv,
  CAST(k % 24 AS INTEGER) AS months_since_last_test,
  CASE WHEN ln % 2 = 0 THEN 'Individual' ELSE 'Couple' END AS client_tested_as,
  CASE k % 4 WHEN 0 THEN 'OPD' WHEN 1 THEN 'VCT' WHEN 2 THEN 'PMTCT' ELSE 'IPD' END AS entry_point,
  CASE k % 3 WHEN 0 THEN 'HB' WHEN 1 THEN 'NP' ELSE 'VI' END AS test_strategy,
  CASE WHEN k % 2 = 0 THEN 'Reactive' ELSE 'Non-Reactive' END AS test_result1,
  CASE WHEN k % 2 = 0 THEN 'Reactive' END AS test_result2,
  CASE k % 5 WHEN 1 THEN 'Positive' WHEN 2 THEN 'Inconclusive' WHEN 3 THEN 'Negative' WHEN 4 THEN 'Negative' END
    AS final_test_result,
  'Yes' AS patient_given_result,
  CASE k % 3 WHEN 0 THEN 'No Signs' WHEN 1 THEN 'Presumed TB' END AS tb_screening,
  CASE WHEN k % 2 = 0 THEN 'Yes' ELSE 'No' END AS client_self_tested,
  CASE WHEN ln % 2 = 1 THEN 'No' END AS couple_discordant,
  CASE WHEN k % 2 = 0 THEN 'Facility' ELSE 'Community' END AS setting,
  'Yes' AS consent
FROM _li""",
    "prep_patient": f"""
SELECT 'P' || CAST(patient_pk AS VARCHAR) AS prep_number,
  upper(sha256('P' || CAST(patient_pk AS VARCHAR))) AS prep_number_hash,
  patient_pk, patient_pk_hash,
  first_dispense - CAST(20 + patient_pk % 25 AS INTEGER) AS prep_enrollment_date,
  site_code
FROM (SELECT patient_pk, patient_pk_hash, site_code, min({d19('sdate')}) AS first_dispense
      FROM _li GROUP BY patient_pk, patient_pk_hash, site_code)""",
    "prep_pharmacy": f"""
SELECT 'P' || CAST(patient_pk AS VARCHAR) AS prep_number, patient_pk, site_code, k * 10 + ln AS dispense_id,
  'H' || CAST(k AS VARCHAR) AS hts_number,
  CASE ln % 3 WHEN 0 THEN 'TDF/FTC' WHEN 1 THEN 'TDF/3TC' ELSE 'TDF' END AS regimen_prescribed,
  {d19('sdate')} AS dispense_date
FROM _li""",
    "prep_visits": f"""
SELECT patient_pk, patient_pk_hash, site_code, k AS encounter_id, k AS visit_id,
  CASE WHEN k % 33 <> 0 THEN {d19('odate')} END AS visit_date,
  {", ".join(f"{gen_text(i)} AS {c}" for i, c in enumerate(PREP_VISIT_COLUMNS))}
FROM _ord""",
    "prep_behaviour_risk": f"""
SELECT patient_pk, patient_pk_hash, site_code, vd AS visit_date, k AS visit_id,
  {", ".join(f"{gen_text(i)} AS {c}" for i, c in enumerate(RISK_TEXT_COLUMNS))},
  CASE WHEN k % 16 = 1 THEN 'CCC-' || lpad(CAST(k AS VARCHAR), 36, '0')
       WHEN k % 16 <> 5 THEN 'CCC-' || CAST(k AS VARCHAR) END AS hiv_partner_ccc_number,
  CASE WHEN k % 3 = 0 THEN vd - CAST(k % 300 AS INTEGER) END AS hiv_partner_art_start_date,
  CASE WHEN k % 8 = 1 THEN 'Risk' ELSE 'No Risk' END AS client_risk
FROM (SELECT *, CASE WHEN k % 40 <> 9 THEN {d19('odate')} END AS vd FROM _ord)""",
    "mnch_anc_visits": f"""
SELECT patient_pk, patient_pk_hash, site_code, k AS visit_id, {d20('odate')} AS visit_date,
  CASE WHEN k % 5 <> 0 THEN (CASE WHEN k % 18 = 0 THEN 'KP' WHEN k % 18 = 6 THEN 'Negative' ELSE 'Unknown' END) END
    AS hiv_status_before_anc,
  CASE WHEN k % 4 = 0 THEN 'Positive' ELSE 'Negative' END AS hiv_test_final_result
FROM _ord""",
    "mnch_pnc_visits": f"""
SELECT patient_pk, patient_pk_hash, site_code, k AS visit_id, {d20('odate')} AS visit_date,
  CASE WHEN k % 18 = 1 THEN 'Positive' WHEN k % 18 = 7 THEN 'Negative' ELSE 'Unknown' END AS prior_hiv_status,
  CASE WHEN k % 5 = 0 THEN 'Positive' ELSE 'Negative' END AS hiv_test_final_result,
  CASE k % 3 WHEN 0 THEN 'Exclusive breastfeeding' WHEN 1 THEN 'mixed feeding' ELSE 'Not breastfeeding' END
    AS baby_feeding
FROM _ord""",
    "mnch_mat_visits": f"""
SELECT patient_pk, patient_pk_hash, site_code, k AS visit_id, {d20('odate')} AS visit_date,
  CASE WHEN k % 5 = 0 THEN 'Positive' ELSE 'Negative' END AS hiv_test_final_result,
  CASE WHEN k % 3 = 0 THEN 'Yes' ELSE 'No' END AS on_art_anc,
  CASE WHEN k % 4 = 2 THEN 'Yes' ELSE 'No' END AS initiated_bf
FROM _ord""",
    "mnch_arts": f"""
SELECT patient_pk, site_code, k AS art_id, {d20('odate')} AS start_art_date FROM _ord""",
    "mnch_enrolments": f"""
SELECT patient_pk, site_code, k AS enrolment_id,
  CASE k % 3 WHEN 0 THEN 'KP' WHEN 1 THEN 'Positive' ELSE 'Negative' END AS hiv_status_before_anc,
  {d20('odate')} AS enrollment_date_at_mnch
FROM _ord""",
}


def prelude(names=None) -> str:
    """``WITH`` items (without the keyword) for the bases and ``names``
    (all tables when ``names`` is None)."""
    wanted = list(TABLES) if names is None else list(names)
    items = [f"{n} AS ({sql}\n)" for n, sql in BASES.items()]
    items += [f"{n} AS ({TABLES[n]}\n)" for n in wanted]
    return ",\n".join(items)


def with_tables(names, body_ctes: str, final: str) -> str:
    """A full query: adapter tables, then the query's CTEs, then the final SELECT."""
    ctes = prelude(names)
    if body_ctes.strip():
        ctes += ",\n" + body_ctes
    return f"WITH {ctes}\n{final}"
