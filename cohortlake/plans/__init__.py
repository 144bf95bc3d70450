"""Dataset plans: one function per intermediate table, ``(inputs..., as_of) -> DataFrame``."""

KEY = ["site_code", "patient_pk"]
IDS = ["patient_id", "site_code", "patient_pk", "patient_pk_hash", "patient_id_hash"]
