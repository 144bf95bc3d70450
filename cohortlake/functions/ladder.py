"""First-match rule ladders as data: ``[(condition, value), ...]``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def ladder(rules: Sequence[tuple[Column, object]], default=None) -> Column:
    """The value of the first rule whose condition is true (SQL three-valued
    logic: a null condition does not match), else ``default``."""
    if not rules:
        raise ValueError("ladder needs at least one rule")

    def lit(v):
        return v if isinstance(v, Column) else F.lit(v)

    out = F.when(rules[0][0], lit(rules[0][1]))
    for cond, value in rules[1:]:
        out = out.when(cond, lit(value))
    return out.otherwise(lit(default)) if default is not None else out
