"""DuckDB SQL for the 23 datasets, written from the dataset definitions in
previous month 2021-01-31, start of previous month 2021-01-01, month start
2021-02-01.

Shared conventions, by design: ties after the ranking date are broken by the
table's record id in the same direction; text the source compared under a
case-insensitive collation is compared as ``upper(rtrim(x))``; NULL ordering
is written out (DuckDB sorts NULL last both ways); ``greatest`` skips NULLs.
"""

from __future__ import annotations

from oracle.adapter_sql import with_tables
from oracle.fixed import DECIMAL, NUMBER, PREP_VISIT_COLUMNS, RISK_TEXT_COLUMNS

AS_OF = "DATE '2021-02-15'"
EOPM = "DATE '2021-01-31'"
SOPM = "DATE '2021-01-01'"
MONTH_START = "DATE '2021-02-01'"
PK = "site_code, patient_pk"


def isnum(x: str) -> str:
    return f"coalesce(regexp_matches({x}, '{NUMBER}'), false)"


def ci(x: str) -> str:
    return f"upper(rtrim({x}))"


def desc(*cols: str) -> str:
    return ", ".join(f"{c} DESC NULLS LAST" for c in cols)


def asc(*cols: str) -> str:
    return ", ".join(f"{c} ASC NULLS FIRST" for c in cols)


def numbered(source: str, part: str, order: str, cols: str = "*", where: str = "TRUE", name: str = "rk") -> str:
    """``source`` rows (filtered) with their row number inside ``part``."""
    return (f"(SELECT {cols}, row_number() OVER (PARTITION BY {part} ORDER BY {order}) AS {name} "
            f"FROM {source} WHERE {where})")


def on_key(a: str, b: str) -> str:
    return f"{a}.site_code = {b}.site_code AND {a}.patient_pk = {b}.patient_pk"


SQL: dict[str, str] = {}
IDS = "patient_id, site_code, patient_pk, patient_pk_hash, patient_id_hash"

# ---------------------------------------------------------------- D01
_left = "trim(split_part(bp, '/', 1))"
_right = "trim(substr(bp, strpos(bp, '/') + 1))"
_bp_ok = (f"strpos(bp, '/') > 0 AND {isnum(_left)} AND {isnum(_right)} "
          f"AND TRY_CAST({_left} AS DOUBLE) < 140.0 AND TRY_CAST({_right} AS DOUBLE) < 90.0")
SQL["d01_last_visit"] = with_tables(["ct_patient_visits"], f"""
newest_visit AS {numbered("ct_patient_visits", PK, desc("visit_date", "visit_id"), where="voided = 0", name="num")}""",
                                    f"""
SELECT num, {IDS}, visit_date AS last_visit_date, visit_id, bp,
       coalesce(next_appointment_date, visit_date + 30) AS next_appointment,
       CASE WHEN bp IS NULL THEN 0 ELSE 1 END AS screened_bp_last_visit,
       CASE WHEN site_code IS NOT NULL AND patient_pk IS NOT NULL AND {_bp_ok} THEN 1 ELSE 0 END
         AS is_bp_controlled_at_last_visit,
       {AS_OF} AS load_date
FROM newest_visit WHERE num = 1""")

# ---------------------------------------------------------------- D02 / D08
SQL["d02_last_visit_as_at"] = with_tables(["ct_patient_visits"], f"""
nv AS {numbered("ct_patient_visits", PK, desc("visit_date", "visit_id"), where="voided = 0", name="num")}""", f"""
SELECT num, patient_id, site_code, patient_pk, visit_date AS visit_date_as_at, patient_pk_hash, patient_id_hash,
       coalesce(next_appointment_date, visit_date + 30) AS appointment_date_as_at, {AS_OF} AS load_date
FROM nv WHERE num = 1 AND visit_date <= {EOPM}""")

SQL["d08_latest_weight_height"] = with_tables(["ct_patient_visits"], f"""
weighed AS {numbered("ct_patient_visits", PK, desc("visit_date", "visit_id"),
                     where="voided = 0 AND weight IS NOT NULL", name="rank")}""", f"""
SELECT rank, visit_date, {IDS}, visit_id, weight, height, visit_by, {AS_OF} AS load_date
FROM weighed WHERE rank = 1""")

# ---------------------------------------------------------------- D03 / D04
_nd = f"""
nd AS {numbered("ct_patient_pharmacy", PK, desc("dispense_date", "dispense_id"), where="voided = 0", name="num")}"""
_nd_cols = (f"num, {IDS}, dispense_date AS last_dispense_date, "
            f"coalesce(expected_return, dispense_date + 30) AS expected_return, {AS_OF} AS load_date")
SQL["d03_last_dispense"] = with_tables(["ct_patient_pharmacy"], _nd, f"SELECT {_nd_cols} FROM nd WHERE num = 1")
SQL["d04_dispense_as_at"] = with_tables(["ct_patient_pharmacy"], _nd, f"""
SELECT {_nd_cols} FROM nd WHERE num = 1 AND dispense_date <= {EOPM}""")

# ---------------------------------------------------------------- D05
SQL["d05_last_encounter_as_at"] = with_tables(["ct_patient_visits", "ct_patient_pharmacy"], f"""
v AS (SELECT * FROM {numbered("ct_patient_visits", PK, desc("visit_date", "visit_id"), where="voided = 0")}
      WHERE rk = 1 AND visit_date <= {EOPM}),
d AS (SELECT * FROM {numbered("ct_patient_pharmacy", PK, desc("dispense_date", "dispense_id"), where="voided = 0")}
      WHERE rk = 1 AND dispense_date <= {EOPM})""", f"""
SELECT coalesce(v.patient_id, d.patient_id) AS patient_id, coalesce(v.site_code, d.site_code) AS site_code,
       coalesce(v.patient_pk, d.patient_pk) AS patient_pk,
       coalesce(v.patient_pk_hash, d.patient_pk_hash) AS patient_pk_hash,
       coalesce(v.patient_id_hash, d.patient_id_hash) AS patient_id_hash,
       CASE WHEN v.visit_date > d.dispense_date THEN v.visit_date END AS encounter_date_as_at,
       greatest(coalesce(v.next_appointment_date, v.visit_date + 30),
                coalesce(d.expected_return, d.dispense_date + 30)) AS appointment_date_as_at,
       {AS_OF} AS load_date
FROM v FULL JOIN d ON {on_key("v", "d")}""")

# ---------------------------------------------------------------- D06
# Treatment rows are joined twice on the key (every pair of a key's rows), as
# the dataset definition requires; the result is made distinct.
D06_CTES = f"""
disp1 AS (
  SELECT site_code, patient_pk, dispense_date AS d_date,
         CASE WHEN expected_return IS NULL OR expected_return = DATE '1900-01-01'
                   OR date_diff('day', dispense_date, expected_return) >= 365
              THEN dispense_date + 30 ELSE expected_return END AS d_next
  FROM {numbered("ct_patient_pharmacy", PK, desc("dispense_date", "dispense_id"),
                 where=f"voided = 0 AND dispense_date <= {EOPM}")} WHERE rk = 1),
tx_dates AS (
  SELECT site_code, patient_pk, last_visit AS t_last, expected_return AS t_ret
  FROM ct_art_patients WHERE voided = 0 AND last_visit <= {EOPM}),
visit1 AS (
  SELECT site_code, patient_pk, visit_date AS v_date, coalesce(next_appointment_date, visit_date + 30) AS v_next
  FROM {numbered("ct_patient_visits", PK, desc("visit_date", "visit_id"),
                 where=f"voided = 0 AND visit_date <= {EOPM}")} WHERE rk = 1),
enc_pairs AS (
  SELECT b.patient_id, b.site_code, b.patient_pk, b.patient_pk_hash, b.patient_id_hash,
         greatest(d.d_date, t1.t_last, t2.t_last, v.v_date) AS enc,
         greatest(d.d_next, t1.t_ret, v.v_next) AS nxt
  FROM (SELECT {IDS} FROM ct_art_patients WHERE voided = 0) b
  LEFT JOIN disp1 d ON {on_key("b", "d")}
  LEFT JOIN tx_dates t1 ON {on_key("b", "t1")}
  LEFT JOIN tx_dates t2 ON {on_key("b", "t2")}
  LEFT JOIN visit1 v ON {on_key("b", "v")}),
d06 AS (
  SELECT DISTINCT {IDS}, enc AS last_encounter_date,
         CASE WHEN date_diff('day', {AS_OF}, nxt) <= 365 THEN nxt ELSE enc + 30 END AS next_appointment_date,
         {AS_OF} AS load_date
  FROM enc_pairs WHERE enc <= {EOPM})"""
D06_TABLES = ["ct_patient_pharmacy", "ct_art_patients", "ct_patient_visits"]
SQL["d06_last_encounter"] = with_tables(D06_TABLES, D06_CTES, "SELECT * FROM d06")

# ---------------------------------------------------------------- D07
_death = "('DIED', 'DEAD', 'DEATH')"
D07_CTES = D06_CTES + f""",
exit1 AS (
  SELECT * FROM {numbered("ct_patient_status", PK, desc("exit_date", "status_id"), where="voided = 0")}
  WHERE rk = 1 AND exit_date <= {EOPM}),
facts AS (
  SELECT p.patient_id, p.patient_pk, p.patient_id_hash, p.patient_pk_hash, t.start_art_date,
         x.exit_reason, x.exit_date, e.last_encounter_date, e.next_appointment_date,
         x.re_enrollment_date, x.effective_discontinuation_date, t.expected_return AS art_return,
         CAST(p.site_code AS VARCHAR) AS site_code, p.emr, p.project,
         {ci('x.exit_reason')} IN {_death} AS died,
         x.exit_date IS NOT NULL AND {ci('x.exit_reason')} NOT IN {_death} AS left_alive
  FROM ct_patient p
  JOIN ct_art_patients t ON {on_key("p", "t")}
  LEFT JOIN d06 e ON {on_key("p", "e")}
  LEFT JOIN exit1 x ON {on_key("p", "x")}
  WHERE t.voided = 0 AND t.start_art_date IS NOT NULL),
coded AS (
  SELECT f.*, CASE
    WHEN died THEN 'D'
    WHEN exit_reason IS NULL AND date_diff('day', coalesce(next_appointment_date, art_return), {EOPM}) > 30 THEN 'uL'
    WHEN left_alive AND re_enrollment_date BETWEEN {SOPM} AND {EOPM} THEN 'V'
    WHEN left_alive AND effective_discontinuation_date >= {EOPM} THEN 'V'
    WHEN start_art_date >= {MONTH_START} THEN 'NP'
    WHEN left_alive AND effective_discontinuation_date BETWEEN {SOPM} AND {EOPM} THEN left(exit_reason, 1)
    WHEN left_alive AND next_appointment_date > {EOPM} THEN 'V'
    WHEN date_diff('day', next_appointment_date, {EOPM}) <= 30 THEN 'V'
    WHEN next_appointment_date > {EOPM} THEN 'V'
    WHEN effective_discontinuation_date IS NOT NULL AND re_enrollment_date IS NULL THEN left(exit_reason, 1)
    WHEN next_appointment_date IS NULL THEN 'NV'
    ELSE left(exit_reason, 1) END AS art_outcome
  FROM facts f),
site_upload AS (SELECT CAST(site_code AS VARCHAR) AS s, max(date_recieved) AS date_uploaded
                FROM ct_facility_manifest GROUP BY 1),
site_visit AS (SELECT CAST(site_code AS VARCHAR) AS s, max(visit_date) AS site_abstraction_date
               FROM ct_patient_visits WHERE voided = 0 GROUP BY 1)"""
SQL["d07_art_outcomes"] = with_tables(
    D06_TABLES + ["ct_patient", "ct_patient_status", "ct_facility_manifest"], D07_CTES, f"""
SELECT DISTINCT c.patient_id, c.patient_pk, c.patient_pk_hash, c.patient_id_hash, c.start_art_date,
       CAST(year(c.start_art_date) AS INTEGER) AS cohort, c.exit_reason, c.exit_date, c.last_encounter_date,
       c.next_appointment_date, c.art_outcome, c.site_code, c.emr, c.project, u.date_uploaded,
       sv.site_abstraction_date, c.re_enrollment_date, c.effective_discontinuation_date, {AS_OF} AS load_date
FROM coded c LEFT JOIN site_upload u ON u.s = c.site_code LEFT JOIN site_visit sv ON sv.s = c.site_code""")

# ---------------------------------------------------------------- D11-D13
_vl = f"{ci('test_name')} = 'VIRAL LOAD' AND test_result IS NOT NULL"
_vl_cols = ("patient_id, site_code, patient_pk, patient_pk_hash, patient_id_hash, visit_id, ordered_by_date, "
            "reported_by_date, test_name, test_result, emr, project")
SQL["d11_baseline_viral_load"] = with_tables(["ct_patient_labs"], f"""
first_vl AS {numbered("ct_patient_labs", PK, asc("ordered_by_date", "lab_id"), where=f"{_vl} AND voided = 0",
                      name="rank")}""", f"""
SELECT rank, {_vl_cols}, {AS_OF} AS load_date FROM first_vl WHERE rank = 1""")
SQL["d12_latest_viral_load"] = with_tables(["ct_patient_labs"], f"""
last_vl AS {numbered("ct_patient_labs", PK, desc("ordered_by_date", "lab_id"), where=_vl, name="rank")}""", f"""
SELECT rank, {_vl_cols}, reason, {AS_OF} AS load_date FROM last_vl WHERE rank = 1""")
SQL["d13_ordered_viral_loads"] = with_tables(["ct_patient_labs"], f"""
vls AS {numbered("ct_patient_labs", PK, desc("ordered_by_date", "lab_id"), where=f"{_vl} AND voided = 0",
                 name="rank")}""", f"""
SELECT rank, {_vl_cols}, reason, {AS_OF} AS load_date FROM vls WHERE rank <= 10""")

# ---------------------------------------------------------------- D14
_suppressed = f"""CASE WHEN {isnum('l.test_result')}
           THEN CASE WHEN TRY_CAST(replace(l.test_result, ',', '') AS DOUBLE) < 200 THEN 1 ELSE 0 END
           WHEN {ci('l.test_result')} IN ('UNDETECTABLE', 'NOT DETECTED', '0 COPIES/ML', 'LDL',
                                          'LESS THAN LOW DETECTABLE LEVEL') THEN 1 ELSE 0 END"""
_months = (6, 12, 18, 24)
SQL["d14_viral_load_intervals"] = with_tables(["ct_patient_labs", "ct_art_patients"], f"""
vl_tx AS (
  SELECT l.patient_id, l.site_code, l.patient_pk, t.patient_pk_hash, t.patient_id_hash, l.lab_id,
         l.ordered_by_date, l.test_result, {_suppressed} AS sup,
         12 * (year(l.ordered_by_date) - year(t.start_art_date)) + month(l.ordered_by_date) - month(t.start_art_date)
           AS months_on
  FROM ct_patient_labs l JOIN ct_art_patients t ON {on_key("l", "t")}
  WHERE {ci('l.test_name')} = 'VIRAL LOAD' AND l.test_result IS NOT NULL AND l.voided = 0 AND t.voided = 0),
at_month AS (
  SELECT * FROM {numbered("vl_tx", f"{PK}, months_on", asc("ordered_by_date", "lab_id"),
                          where=f"months_on IN {_months}")} WHERE rk = 1)""", f"""
SELECT c.patient_pk, c.patient_id, c.site_code, c.patient_pk_hash, c.patient_id_hash,
       {", ".join(f"m{n}.test_result AS vl_{n}_month, m{n}.ordered_by_date AS vl_{n}_month_date, "
                  f"m{n}.sup AS vl_{n}_month_sup" for n in _months)},
       {AS_OF} AS load_date
FROM (SELECT DISTINCT {IDS} FROM vl_tx) c
{" ".join(f"LEFT JOIN at_month m{n} ON {on_key('c', f'm{n}')} AND m{n}.months_on = {n}" for n in _months)}""")

# ---------------------------------------------------------------- D15
_dec = f"CASE WHEN regexp_matches(test_result, '{DECIMAL}') THEN TRY_CAST(trim(test_result) AS DECIMAL(18, 2)) END"
_fam1 = f"{ci('test_name')} IN ('HGB', 'HBSAG', 'HBA1C')"
_fam2 = f"{ci('test_name')} IN ('FBS', 'BLOOD SUGAR')"
SQL["d15_latest_diabetes_test"] = with_tables(["ct_patient_labs"], f"""
dm AS (
  SELECT patient_pk_hash, site_code, test_name, {_dec} AS v
  FROM {numbered("ct_patient_labs", "patient_pk_hash, site_code", desc("ordered_by_date", "lab_id"),
                 where=f"({_fam1} OR {_fam2}) AND voided = 0")} WHERE rk = 1)""", f"""
SELECT patient_pk_hash, site_code, v AS numeric_test_result, test_name,
       CASE WHEN patient_pk_hash IS NULL THEN 0 ELSE 1 END AS screened_diabetes,
       CASE WHEN patient_pk_hash IS NOT NULL AND site_code IS NOT NULL
                 AND (({_fam1} AND v > 0 AND v <= 6.5) OR ({_fam2} AND v > 0 AND v < 7.0)) THEN 1 ELSE 0 END
         AS is_diabetes_controlled_at_last_test
FROM dm""")

# ---------------------------------------------------------------- D16 / D17
_preg = f"""
first_preg AS (
  SELECT site_code, patient_pk, visit_date
  FROM {numbered("ct_patient_visits", PK, asc("visit_date", "visit_id"),
                 where=f"voided = 0 AND {ci('pregnant')} IN ('YES', 'Y')")} WHERE rk = 1),
women AS (
  SELECT f.visit_date, p.*, t.start_art_date
  FROM first_preg f
  JOIN ct_patient p ON {on_key("f", "p")}
  JOIN ct_art_patients t ON {on_key("p", "t")}
  WHERE {ci('p.gender')} = 'FEMALE' AND p.voided = 0 AND t.voided = 0)"""
_preg_tables = ["ct_patient_visits", "ct_patient", "ct_art_patients"]
SQL["d16_pregnancy_at_initiation"] = with_tables(_preg_tables, _preg, f"""
SELECT patient_pk, patient_id, patient_pk_hash, patient_id_hash, site_code,
       CASE WHEN year(start_art_date) = year(visit_date) THEN 1 ELSE 0 END AS pregnant_art_start,
       CASE WHEN year(registration_at_ccc) = year(visit_date) THEN 1 ELSE 0 END AS pregnant_at_enrol,
       {AS_OF} AS load_date
FROM women""")
SQL["d17_pregnancy_during_art"] = with_tables(_preg_tables, _preg, f"""
SELECT patient_pk, patient_id, patient_pk_hash, patient_id_hash, site_code,
       CASE WHEN visit_date > start_art_date THEN 1 ELSE 0 END AS pregnant_during_art, {AS_OF} AS load_date
FROM women""")

# ---------------------------------------------------------------- D18 / D19
_modules = [("orientation", "ORIENTATION"), ("participation", "PARTICIPATION"), ("leadership", "LEADERSHIP"),
            ("making_decisions", "MAKING DECISIONS"), ("transition", "TRANSITION"),
            ("treatment_literacy", "TREATMENT LITERACY"), ("srh", "SRH"), ("beyond", "BEYON")]
SQL["d18_last_otz_visit"] = with_tables(["ct_otz"], f"""
otz1 AS (SELECT * FROM {numbered("ct_otz", f"{PK}, emr", desc("visit_date", "visit_id"), where="voided = 0")}
         WHERE rk = 1)""", f"""
SELECT site_code, patient_pk, patient_id, patient_pk_hash, patient_id_hash, emr, visit_date AS last_visit_date,
       otz_enrollment_date, transfer_in_status, transition_attrition_reason, modules_previously_covered,
       {", ".join(f"CASE WHEN strpos(upper(modules_completed_today), '{n}') > 0 THEN 1 ELSE 0 END "
                  f"AS modules_completed_today_otz_{f}" for f, n in _modules)},
       {AS_OF} AS load_date
FROM otz1""")
SQL["d19_last_ovc_visit"] = with_tables(["ct_ovc"], f"""
ovc1 AS (SELECT * FROM {numbered("ct_ovc", PK, desc("visit_date", "visit_id"), where="voided = 0")} WHERE rk = 1)""",
                                        f"""
SELECT visit_date AS latest_visit_date, patient_id, site_code, patient_pk, patient_id_hash, patient_pk_hash, emr,
       visit_date, visit_id, ovc_enrollment_date, relationship_to_client, enrolledin_cpims, cpims_unique_identifier,
       partner_offering_ovc_services, ovc_exit_reason, exit_date, {AS_OF} AS load_date
FROM ovc1""")

# ---------------------------------------------------------------- D20
_hts_cols = ("test_date, encounter_id, site_code, patient_pk, patient_pk_hash, emr, project, date_extracted, "
             "ever_tested_for_hiv, months_since_last_test, client_tested_as, entry_point, test_strategy, test_result1, "
             "test_result2, final_test_result, patient_given_result, tb_screening, client_self_tested, "
             "couple_discordant, test_type, setting, consent")
SQL["d20_encounter_hts_tests"] = with_tables(["hts_client_tests"], f"""
tests AS {numbered("hts_client_tests", f"{PK}, test_date, test_type", desc("encounter_id"), cols=_hts_cols,
                   where=f"final_test_result IS NOT NULL AND encounter_id IS NOT NULL "
                         f"AND test_date BETWEEN DATE '2015-01-01' AND {AS_OF}", name="num")}""", f"""
SELECT num, {_hts_cols}, {AS_OF} AS load_date FROM tests WHERE num = 1""")

# ---------------------------------------------------------------- D21 / D22
SQL["d21_prep_last_visit"] = with_tables(["prep_visits"], f"""
pv AS {numbered("prep_visits", PK, desc("visit_date", "visit_id"), where="visit_date IS NOT NULL", name="num")}""",
                                         f"""
SELECT num, patient_pk, patient_pk_hash, site_code, encounter_id, visit_id, visit_date,
       CAST(month(visit_date) AS INTEGER) AS visit_month, CAST(year(visit_date) AS INTEGER) AS visit_year,
       {", ".join(PREP_VISIT_COLUMNS)}, {AS_OF} AS load_date
FROM pv WHERE num = 1""")
SQL["d22_latest_prep_assessment"] = with_tables(["prep_behaviour_risk"], f"""
ra AS {numbered("prep_behaviour_risk", PK, desc("visit_date", "visit_id"), name="num")}""", f"""
SELECT num, patient_pk, patient_pk_hash, site_code, visit_date, visit_id, {", ".join(RISK_TEXT_COLUMNS)},
       hiv_partner_ccc_number, hiv_partner_art_start_date, client_risk,
       CASE WHEN {ci('client_risk')} = 'RISK' THEN 1 ELSE 0 END AS eligible_prep,
       visit_date AS assessment_visit_date, CASE WHEN visit_date IS NULL THEN 0 ELSE 1 END AS screened_prep,
       upper(sha256(CAST(hiv_partner_ccc_number AS VARCHAR))) AS hiv_partner_ccc_number_hash,
       {AS_OF} AS load_date
FROM ra WHERE num = 1""")

# ---------------------------------------------------------------- D23
SQL["d23_prep_refills"] = with_tables(["prep_patient", "prep_pharmacy", "hts_client_tests"], f"""
first_refill AS (
  SELECT * FROM {numbered("prep_pharmacy", "prep_number, patient_pk, site_code", asc("dispense_date", "dispense_id"),
                          where="prep_number IS NOT NULL")} WHERE rk = 1),
refill_m1 AS (
  SELECT r.site_code, r.patient_pk, r.dispense_date,
         CAST(date_diff('day', e.prep_enrollment_date, r.dispense_date) AS INTEGER) AS days_in,
         h.test_date, h.final_test_result
  FROM first_refill r
  JOIN prep_patient e ON e.prep_number = r.prep_number AND {on_key("e", "r")}
  LEFT JOIN hts_client_tests h ON {on_key("h", "r")} AND h.test_date = r.dispense_date
  WHERE date_diff('day', e.prep_enrollment_date, r.dispense_date) BETWEEN 30 AND 37),
refill_m3 AS (
  SELECT r.site_code, r.patient_pk, r.dispense_date,
         CAST(date_diff('day', e.prep_enrollment_date, r.dispense_date) AS INTEGER) AS days_in,
         h.test_date, h.final_test_result
  FROM prep_pharmacy r
  JOIN (SELECT DISTINCT site_code, patient_pk, dispense_date AS m1_date FROM refill_m1) a ON {on_key("a", "r")}
  LEFT JOIN prep_patient e ON e.prep_number = r.prep_number AND {on_key("e", "r")}
  LEFT JOIN hts_client_tests h ON {on_key("h", "r")} AND h.test_date = r.dispense_date
  WHERE r.prep_number IS NOT NULL AND date_diff('day', a.m1_date, r.dispense_date) BETWEEN 60 AND 67)""", f"""
SELECT DISTINCT c.prep_number, c.patient_pk, c.patient_pk_hash, c.prep_number_hash, c.site_code,
       m1.days_in AS refil1_diff_in_days, m1.final_test_result AS test_results_month1,
       m1.test_date AS test_date_month1, m1.dispense_date AS dispense_date_month1,
       m3.days_in AS refil3_diff_in_days, m3.final_test_result AS test_results_month3,
       m3.test_date AS test_date_month3, m3.dispense_date AS dispense_date_month3, {AS_OF} AS load_date
FROM (SELECT * FROM prep_patient WHERE prep_number IS NOT NULL) c
LEFT JOIN refill_m1 m1 ON {on_key("m1", "c")}
LEFT JOIN refill_m3 m3 ON {on_key("m3", "c")}""")

# ---------------------------------------------------------------- D09
# Attribute groups at the last visit, each a distinct set left-joined to the
# live patients (several values multiply rows; the family-planning group is
# joined but not emitted).
_groups = {
    "g_adh": ("v.adherence", f"{ci('v.adherence_category')} IN ('ARVADHERENCE', 'ART', 'ART|CTX', 'ARV', 'ARV ADHERENCE')"),
    "g_dc": ("v.differentiated_care", "v.differentiated_care IS NOT NULL"),
    "g_stab": ("v.stability_assessment", "TRUE"),
    "g_preg": ("v.pregnant", "v.pregnant IS NOT NULL"),
    "g_fp": ("v.family_planning_method", "v.family_planning_method IS NOT NULL AND rtrim(v.family_planning_method) <> ''"),
    "g_bf": ("v.breastfeeding, v.lmp, v.gestation_age", "v.breastfeeding IS NOT NULL AND rtrim(v.breastfeeding) <> ''"),
    "g_who": ("v.who_stage", "TRUE"),
}
D09_CTES = D06_CTES + f""",
lastv AS (SELECT site_code, patient_pk, visit_date, visit_id
          FROM {numbered("ct_patient_visits", PK, desc("visit_date", "visit_id"), where="voided = 0")} WHERE rk = 1),
at_last AS (
  SELECT v.* FROM ct_patient_visits v
  JOIN lastv l ON {on_key("v", "l")} AND v.visit_date = l.visit_date AND v.visit_id = l.visit_id
  WHERE v.voided = 0),
{",".join(f'''
{g} AS (SELECT DISTINCT v.site_code, v.patient_pk, {cols} FROM at_last v WHERE {cond})''' for g, (cols, cond) in _groups.items())},
wh AS (SELECT patient_pk_hash, site_code, weight, height
       FROM {numbered("ct_patient_visits", PK, desc("visit_date", "visit_id"), where="voided = 0 AND weight IS NOT NULL")}
       WHERE rk = 1),
ages AS (SELECT e.site_code, e.patient_pk, CAST(year(e.last_encounter_date) - year(p.dob) AS INTEGER) AS age
         FROM d06 e JOIN ct_patient p ON {on_key("e", "p")} WHERE p.voided = 0),
mmd AS (SELECT DISTINCT site_code, patient_pk,
               CASE WHEN abs(date_diff('day', last_encounter_date, next_appointment_date)) < 90 THEN 0
                    WHEN abs(date_diff('day', last_encounter_date, next_appointment_date)) >= 90 THEN 1 END AS on_mmd
        FROM d06),
tb AS (SELECT DISTINCT i.site_code, i.patient_pk, i.tb_screening
       FROM {numbered("ct_ipt", PK, desc("visit_date", "visit_id"), where="voided = 0")} i
       JOIN lastv l ON {on_key("i", "l")} AND i.visit_date = l.visit_date AND i.visit_id = l.visit_id
       WHERE i.rk = 1),
d09 AS (
  SELECT p.patient_pk_hash, p.patient_pk, p.site_code, wh.height AS latest_height, wh.weight AS latest_weight,
         ages.age AS age_last_visit, g_adh.adherence, g_dc.differentiated_care, mmd.on_mmd,
         g_stab.stability_assessment, g_preg.pregnant, g_bf.breastfeeding, g_bf.lmp, g_bf.gestation_age,
         g_who.who_stage, tb.tb_screening, {AS_OF} AS load_date
  FROM ct_patient p
  LEFT JOIN wh ON wh.patient_pk_hash = p.patient_pk_hash AND wh.site_code = p.site_code
  LEFT JOIN ages ON {on_key("ages", "p")}
  LEFT JOIN mmd ON {on_key("mmd", "p")}
  {" ".join(f"LEFT JOIN {g} ON {on_key(g, 'p')}" for g in _groups)}
  LEFT JOIN tb ON {on_key("tb", "p")}
  WHERE p.voided = 0)"""
D09_TABLES = D06_TABLES + ["ct_patient", "ct_ipt"]
SQL["d09_latest_obs"] = with_tables(D09_TABLES, D09_CTES, "SELECT * FROM d09")

# ---------------------------------------------------------------- D10
_weeks_text = "TRY_CAST(replace(o.gestation_age, ',', '') AS DOUBLE)"
_weeks = f"CASE WHEN {isnum('o.gestation_age')} AND abs({_weeks_text}) <= 10000 THEN floor({_weeks_text}) END"
_yes = "= 'YES'"


def _newest(table: str, where: str, cols: str) -> str:
    return f"(SELECT {cols} FROM {numbered(table, PK, desc('visit_date', 'visit_id'), where=where)} WHERE rk = 1)"


SQL["d10_pbfw"] = with_tables(D09_TABLES + ["mnch_anc_visits", "mnch_pnc_visits", "mnch_mat_visits", "mnch_arts",
                                            "mnch_enrolments"], D09_CTES + f""",
cohort AS (
  SELECT DISTINCT o.site_code, o.patient_pk, o.patient_pk_hash, o.breastfeeding, o.pregnant, p.gender, p.dob,
         t.start_art_date, p.date_confirmed_hiv_positive, l.visit_date AS last_visit_date
  FROM d09 o
  LEFT JOIN ct_art_patients t ON {on_key("t", "o")}
  LEFT JOIN ct_patient p ON {on_key("p", "o")}
  LEFT JOIN lastv l ON {on_key("l", "o")}
  WHERE {ci('o.pregnant')} {_yes}
     OR ({ci('o.breastfeeding')} {_yes} AND year(t.last_visit) - year(t.dob) > 10
         AND date_diff('day', o.lmp - CAST({_weeks} * 7 AS INTEGER), {EOPM}) <= 450)),
first_pb AS (
  SELECT site_code, patient_pk, visit_date AS anc_date1
  FROM {numbered(f"(SELECT v.* FROM ct_patient_visits v LEFT JOIN ct_art_patients t ON {on_key('t', 'v')} "
                 f"WHERE {ci('v.pregnant')} {_yes} OR ({ci('v.breastfeeding')} {_yes} "
                 f"AND year(t.last_visit) - year(t.dob) > 1))", PK, asc("visit_date", "visit_id"))} WHERE rk = 1),
anc1 AS {_newest("mnch_anc_visits", f"{ci('hiv_status_before_anc')} = 'KP' OR {ci('hiv_test_final_result')} = 'POSITIVE'",
                 "site_code, patient_pk, patient_pk_hash, visit_date, hiv_status_before_anc")},
pnc1 AS {_newest("mnch_pnc_visits", f"{ci('prior_hiv_status')} = 'POSITIVE' OR ({ci('hiv_test_final_result')} = 'POSITIVE' "
                 f"AND {ci('baby_feeding')} IN ('BREASTFED EXCLUSIVELY', 'EXCLUSIVE BREASTFEEDING', 'MIXED FEEDING'))",
                 "site_code, patient_pk, patient_pk_hash, visit_date")},
mat1 AS {_newest("mnch_mat_visits", f"{ci('hiv_test_final_result')} = 'POSITIVE' OR ({ci('on_art_anc')} {_yes} "
                 f"AND {ci('initiated_bf')} {_yes})", "site_code, patient_pk, patient_pk_hash, visit_date")},
mnch_start AS (SELECT site_code, patient_pk, start_art_date
               FROM {numbered("mnch_arts", PK, asc("start_art_date", "art_id"))} WHERE rk = 1),
mnch_status AS (SELECT site_code, patient_pk, hiv_status_before_anc
                FROM {numbered("mnch_enrolments", PK, desc("enrollment_date_at_mnch", "enrolment_id"))} WHERE rk = 1),
with_anc AS (
  SELECT coalesce(c.site_code, a.site_code) AS site_code, coalesce(c.patient_pk, a.patient_pk) AS patient_pk,
         coalesce(c.patient_pk_hash, a.patient_pk_hash) AS patient_pk_hash,
         coalesce(c.last_visit_date, a.visit_date) AS last_visit_date,
         c.breastfeeding, c.pregnant, c.start_art_date, c.date_confirmed_hiv_positive, c.gender, c.dob,
         a.hiv_status_before_anc, CASE WHEN a.patient_pk IS NULL THEN 0 ELSE 1 END AS is_anc_source
  FROM cohort c FULL JOIN anc1 a ON {on_key("c", "a")}),
with_pnc AS (
  SELECT coalesce(w.site_code, n.site_code) AS site_code, coalesce(w.patient_pk, n.patient_pk) AS patient_pk,
         coalesce(w.patient_pk_hash, n.patient_pk_hash) AS patient_pk_hash,
         coalesce(w.last_visit_date, n.visit_date) AS last_visit_date,
         w.breastfeeding, w.pregnant, w.start_art_date, w.date_confirmed_hiv_positive, w.gender, w.dob,
         w.hiv_status_before_anc, w.is_anc_source
  FROM with_anc w FULL JOIN pnc1 n ON {on_key("w", "n")}),
with_mat AS (
  SELECT coalesce(w.site_code, m.site_code) AS site_code, coalesce(w.patient_pk, m.patient_pk) AS patient_pk,
         coalesce(w.patient_pk_hash, m.patient_pk_hash) AS patient_pk_hash,
         coalesce(w.last_visit_date, m.visit_date) AS last_visit_date,
         w.breastfeeding, w.pregnant, w.start_art_date, w.date_confirmed_hiv_positive, w.gender, w.dob,
         w.hiv_status_before_anc, w.is_anc_source
  FROM with_pnc w FULL JOIN mat1 m ON {on_key("w", "m")}),
final_rows AS (
  SELECT w.site_code, w.patient_pk_hash, w.patient_pk, w.breastfeeding, w.pregnant,
         coalesce(w.start_art_date, s.start_art_date) AS start_art_date, w.date_confirmed_hiv_positive,
         w.last_visit_date, coalesce(e.hiv_status_before_anc, w.hiv_status_before_anc) AS hiv_status_before_anc,
         w.hiv_status_before_anc AS anc_status, w.is_anc_source, w.gender, w.dob, f.anc_date1
  FROM with_mat w
  LEFT JOIN mnch_start s ON {on_key("s", "w")}
  LEFT JOIN mnch_status e ON {on_key("e", "w")}
  LEFT JOIN first_pb f ON {on_key("f", "w")})""", f"""
SELECT site_code, patient_pk_hash, patient_pk, breastfeeding, pregnant, start_art_date, date_confirmed_hiv_positive,
       last_visit_date, hiv_status_before_anc, is_anc_source, gender, dob,
       CASE WHEN date_confirmed_hiv_positive < last_visit_date THEN 'Known Positive'
            WHEN date_confirmed_hiv_positive = last_visit_date THEN 'New Positive'
            WHEN {ci('hiv_status_before_anc')} IN ('POSITIVE', 'KP') THEN 'Known Positive'
            WHEN is_anc_source = 1 AND {ci('anc_status')} <> 'KP' THEN 'New Positive'
            ELSE 'Missing' END AS pbfw_category,
       anc_date1 AS green_card_anc_date1
FROM final_rows""")

# D10 over the whole of D09: the same rows by another plan.
SQL["d10_pbfw_from_obs"] = SQL["d10_pbfw"]
