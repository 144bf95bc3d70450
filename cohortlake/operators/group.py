"""Per-group maxima joined back to detail rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_by_group(df: DataFrame, group: Sequence[str], ts: str, out: str) -> DataFrame:
    """``max(ts)`` per group (partial aggregation before the shuffle).

    The result has one row per group value; joins to it are left to AQE,
    which broadcasts it only once its materialised size is measured below
    ``spark.sql.autoBroadcastJoinThreshold`` and otherwise keeps a
    sort-merge join (with skew splitting).
    """
    return df.groupBy(*group).agg(F.max(ts).alias(out))


def join_group_facts(detail: DataFrame, facts: DataFrame, on: Sequence[str], spread_by: Sequence[str],
                     ways: int = 32, how: str = "left") -> DataFrame:
    """Join detail rows to one-row-per-group ``facts`` (e.g. per-site maxima)
    with the group split ``ways`` ways.

    The facts are replicated once per salt value 0..ways-1 and each detail row
    takes the salt ``pmod(xxhash64(spread_by), ways)``, so a group that holds a
    large share of the detail rows (one site with a third of all patients) is
    spread over ``ways`` join tasks even when the join is not broadcast. The
    salt is a pure function of the row, so task retries see the same rows.
    If AQE broadcasts the (small) replicated facts, the salt costs one column.
    """
    salt = "__salt"
    d = detail.withColumn(salt, F.pmod(F.xxhash64(*[F.col(c) for c in spread_by]), F.lit(ways)))
    f = facts.withColumn(salt, F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(ways - 1).cast("bigint"))))
    return d.join(f, [*on, salt], how).drop(salt)
