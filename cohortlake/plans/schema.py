"""Column lists of the source tables that datasets carry through unchanged."""

# Columns a prevention visit carries unchanged.
PREP_VISIT_COLUMNS = [
    "blood_pressure", "temperature", "weight", "height", "bmi", "sti_screening", "sti_symptoms",
    "sti_treated", "circumcised", "vmmc_referral", "lmp", "menopausal_status",
    "pregnant_at_this_visit", "edd", "planning_to_get_pregnant", "pregnancy_planned",
    "pregnancy_ended", "pregnancy_end_date", "pregnancy_outcome", "birth_defects", "breastfeeding",
    "family_planning_status", "fp_methods", "adherence_done", "adherence_outcome",
    "adherence_reasons", "symptoms_acute_hiv", "contraindications_prep", "prep_treatment_plan",
    "prep_prescribed", "regimen_prescribed", "months_prescribed", "condoms_issued",
    "tobegivennextappointment", "reasonfornotgivingnextappointment", "hepatitis_b_positive_result",
    "hepatitis_c_positive_result", "vaccination_for_hep_b_started", "treated_for_hep_b",
    "vaccination_for_hep_c_started", "treated_for_hep_c", "next_appointment", "clinical_notes",
]

# The plain text columns of a behaviour-risk assessment.
RISK_TEXT_COLUMNS = [
    "sex_partner_hiv_status", "is_hiv_positive_partner_current_on_art", "is_partner_highrisk",
    "partner_art_risk", "client_assessments", "client_willing_to_take_prep", "prep_decline_reason",
    "risk_reduction_education_offered", "referral_to_other_prev_services",
    "first_establish_partner_status", "partner_enrolledto_ccc", "months_known_hiv_serodiscordant",
    "sex_without_condom", "number_of_children_with_partner",
]
