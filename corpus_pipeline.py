"""Corpus pipeline: quality rules, near duplicates, benchmark decontamination,
personal data, mixing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet in the shared folder and read again as the next stage's documents,
so that a lost executor costs one stage's running tasks at most. Every stage works
on all rows its predecessor kept; all but the last return the columns of
``documents``, the last one row per copy that the mix takes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortlake.llm import common, decontamination, mixing, near_dup, pii, quality_rules

STAGES = [
    ("quality_rules", quality_rules.stage),
    ("near_dedup", near_dup.stage),
    ("decontamination", decontamination.stage),
    ("personal_data", pii.stage),
    ("mixing", mixing.stage),
]

#: The line rules and the confirmed links have no SQL; tests/llm hold the run against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    scratch = common.Scratch(spark, "pipeline")
    docs, before = common.documents(spark, sf_dir), []
    for name, stage in STAGES:
        docs = scratch.table(stage(spark, docs, sf_dir), name)
        scratch.drop(*before)
        before = [name]
    return docs
