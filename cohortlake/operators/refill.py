"""Follow-up events inside a day window after a per-key anchor date."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def follow_up_in_window(events: DataFrame, anchors: DataFrame, keys: Sequence[str], event_ts: str,
                        anchor_ts: str, lo: int, hi: int) -> DataFrame:
    """Events whose ``event_ts`` is ``lo``..``hi`` days (inclusive) after an
    anchor's ``anchor_ts`` on the same key, with the anchor's columns.

    The day range becomes an equi-join: every anchor is expanded to its
    ``hi - lo + 1`` candidate dates, and events join on (keys, date). The join
    key includes the date, so a key with very many events is spread over many
    shuffle partitions instead of one; no pairs outside the window are built.
    Days are calendar days: timestamps match by their date and are returned
    as they are.
    """
    day = "__day"
    first = F.to_date(F.col(anchor_ts))
    cand = anchors.withColumn(day, F.explode(F.sequence(F.date_add(first, lo), F.date_add(first, hi))))
    return events.withColumn(day, F.to_date(F.col(event_ts))).join(cand, [*keys, day], "inner").drop(day)
