"""Merging per-key datasets: full merges with coalesced keys, chained left joins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def full_merge(left: DataFrame, right: DataFrame, keys: Sequence[str],
               coalesce: Mapping[str, tuple[str, str]] | None = None,
               left_cols: Mapping[str, str] | None = None,
               right_cols: Mapping[str, str] | None = None,
               present: Mapping[str, str] | None = None) -> DataFrame:
    """Full outer join on ``keys``; keys come out coalesced left-first.

    ``coalesce``   ``{out: (left_col, right_col)}`` coalesced left-first,
    ``left_cols`` / ``right_cols`` ``{out: col}`` taken from one side,
    ``present``    ``{out: "left"|"right"}`` 1/0 flag: the row has that side.
    """
    l, r = left.alias("__l"), right.alias("__r")
    cond = [F.col(f"__l.{k}") == F.col(f"__r.{k}") for k in keys]
    out = [F.coalesce(F.col(f"__l.{k}"), F.col(f"__r.{k}")).alias(k) for k in keys]
    for name, (lc, rc) in (coalesce or {}).items():
        out.append(F.coalesce(F.col(f"__l.{lc}"), F.col(f"__r.{rc}")).alias(name))
    for name, c in (left_cols or {}).items():
        out.append(F.col(f"__l.{c}").alias(name))
    for name, c in (right_cols or {}).items():
        out.append(F.col(f"__r.{c}").alias(name))
    for name, side in (present or {}).items():
        probe = F.col(f"__{side[0]}.{keys[-1]}")
        out.append(F.when(probe.isNotNull(), 1).otherwise(0).alias(name))
    return l.join(r, cond, "full").select(*out)


def left_enrich(base: DataFrame, parts: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """``base`` left-joined to each part on ``keys`` (parts must not repeat
    non-key column names). All joins share the key, so after the first
    exchange the base side keeps its hash partitioning."""
    out = base
    for p in parts:
        out = out.join(p, list(keys), "left")
    return out
