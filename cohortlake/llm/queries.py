"""The operators' queries by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from cohortlake.llm.decontamination import OP8_SQL, op8_decontaminate
from cohortlake.llm.filter_audit import OP12_SQL, op12_filter_audit
from cohortlake.llm.mixing import OP1_SQL, op1_mix
from cohortlake.llm.near_dup import op10_near_dup
from cohortlake.llm.orchard import OP11_SQL, op11_orchard
from cohortlake.llm.pii import op3_pii
from cohortlake.llm.quality_classifier import op5_quality
from cohortlake.llm.quality_rules import op6_quality_rules
from cohortlake.llm.secrets import op4_secrets
from cohortlake.llm.tool_calls import OP2_SQL, op2_tool_calls
from cohortlake.llm.topk import OP13_SQL, op13_top_k
from cohortlake.llm.toxicity import op7_toxicity
from cohortlake.llm.warc import OP9_SQL, op9_warc

QUERIES = {
    "op1_mix": op1_mix,
    "op2_tool_calls": op2_tool_calls,
    "op3_pii": op3_pii,
    "op4_secrets": op4_secrets,
    "op5_quality": op5_quality,
    "op6_quality_rules": op6_quality_rules,
    "op7_toxicity": op7_toxicity,
    "op8_decontaminate": op8_decontaminate,
    "op9_warc": op9_warc,
    "op10_near_dup": op10_near_dup,
    "op11_orchard": op11_orchard,
    "op12_filter_audit": op12_filter_audit,
    "op13_top_k": op13_top_k,
}

SQL: dict[str, str] = {
    "op1_mix": OP1_SQL,
    "op2_tool_calls": OP2_SQL,
    "op8_decontaminate": OP8_SQL,
    "op9_warc": OP9_SQL,
    "op11_orchard": OP11_SQL,
    "op12_filter_audit": OP12_SQL,
    "op13_top_k": OP13_SQL,
}
