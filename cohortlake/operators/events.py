"""Rows of an event table that are exactly a per-key anchor event."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rows_at_event(events: DataFrame, anchor: DataFrame, keys: Sequence[str], ts: str, event_id: str,
                  anchor_ts: str | None = None, anchor_id: str | None = None) -> DataFrame:
    """Events with the same key, date and id as the anchor row of their key
    (inner join; a null id or date never matches). The join key includes the
    date and id, so one key's events are spread over many partitions."""
    a = anchor.select(*keys, F.col(anchor_ts or ts).alias(ts), F.col(anchor_id or event_id).alias(event_id))
    return events.join(a, [*keys, ts, event_id], "inner")
