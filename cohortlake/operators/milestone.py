"""Values at fixed calendar-month distances from a per-key anchor date."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _month_index(c):
    return F.year(c) * 12 + F.month(c)


def value_at_months(events: DataFrame, anchors: DataFrame, keys: Sequence[str], ts: str, start: str,
                    months: Sequence[int], values: Sequence[str], tie: Sequence[str] = (),
                    name: Callable[[int, str], str] = lambda n, v: f"{v}_{n}m") -> DataFrame:
    """For each key and each ``n`` in ``months``: the first event (by ``ts``,
    then ``tie``) whose calendar month is exactly ``n`` month boundaries after
    the anchor's ``start``; one wide row per key with at least one match.

    Plan: events are first reduced to the earliest row per (key, month) with a
    partially aggregated ``min(struct)`` - a key with very many events then
    sends at most one row per month through the shuffle - and only that
    reduced set is joined to the anchors. The month distance of a row depends
    only on its calendar month, so the reduction does not change the answer.
    """
    ev = events.filter(F.col(ts).isNotNull())
    reduced = ev.groupBy(*keys, _month_index(F.col(ts)).alias("__ym")).agg(
        F.min(F.struct(
            F.col(ts).alias("__ts"),
            *[F.col(c).alias(f"__tie{i}") for i, c in enumerate(tie)],
            *[F.col(c).alias(f"__v{j}") for j, c in enumerate(values)],
        )).alias("__first")
    )
    anchored = reduced.join(anchors.select(*keys, start), list(keys)).withColumn(
        "__dist", F.col("__ym") - _month_index(F.col(start))
    ).filter(F.col("__dist").isin(list(months)))
    wide = anchored.groupBy(*keys).agg(
        *[F.min(F.when(F.col("__dist") == n, F.col("__first"))).alias(f"__m{n}") for n in months]
    )
    return wide.select(
        *keys, *[F.col(f"__m{n}.__v{j}").alias(name(n, v)) for n in months for j, v in enumerate(values)]
    )
