"""DataFrame-level building blocks. All take column names, so they work on any
keyed event table."""

from cohortlake.operators.events import rows_at_event
from cohortlake.operators.group import join_group_facts, latest_by_group
from cohortlake.operators.merge import full_merge, left_enrich
from cohortlake.operators.milestone import value_at_months
from cohortlake.operators.product import copied, dealt, in_tasks, large_keys
from cohortlake.operators.rank import (
    dedup_encounters,
    first_per_key,
    latest_as_at,
    latest_per_key,
    live,
    ranked,
    top_n_per_key,
)
from cohortlake.operators.refill import follow_up_in_window

__all__ = [
    "copied", "dealt", "dedup_encounters", "first_per_key", "follow_up_in_window", "full_merge", "in_tasks", "join_group_facts", "large_keys", "latest_as_at",
    "latest_by_group", "latest_per_key", "left_enrich", "live", "ranked", "rows_at_event", "top_n_per_key",
    "value_at_months",
]
