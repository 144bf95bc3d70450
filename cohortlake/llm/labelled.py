"""Labelled documents: all of them, or bounded samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(doc_id: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % parts


def every(labels: DataFrame, label: str, eligible: Column) -> tuple[DataFrame, dict[int, int]]:
    """(doc_id, y): every eligible labelled id of class 0 or 1, and the number of ids of each class.
    An id with several labels counts with the largest."""
    one = labels.filter(eligible & F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    one = one.groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("y")).filter("y in (0, 1)")
    return one, {r["y"]: r["count"] for r in one.groupBy("y").count().collect()}


def sample(labels: DataFrame, label: str, eligible: Column, per_class: int) -> tuple[DataFrame, dict[int, int]]:
    """(doc_id, y): at most ``per_class`` labelled ids of each class, those with the
    least hashes, and the number of eligible ids of each class. An id with
    several labels counts with the largest."""
    one, counts = every(labels, label, eligible)
    order = [F.xxhash64(F.col("doc_id").cast("string")), F.col("doc_id")]
    taken = [one.filter(F.col("y") == y).orderBy(*order).limit(per_class) for y in (0, 1)]
    return taken[0].unionByName(taken[1]), counts
