"""Column-level building blocks (all built-in Spark expressions, codegen-friendly)."""

from cohortlake.functions.dates import (
    day_diff,
    month_boundary_diff,
    plus_days,
    plus_days_if_null,
    repair_return_date,
    year_boundary_diff,
)
from cohortlake.functions.ladder import ladder
from cohortlake.functions.values import (
    banded_days,
    below_or_in,
    ci,
    ci_equals,
    ci_in,
    contains_flag,
    contains_flags,
    decimal_text,
    hash_id,
    is_numeric_text,
    later_of,
    later_strict,
    lenient_number,
    not_blank,
    pair_below,
    range_by_family,
)

__all__ = [
    "banded_days", "below_or_in", "ci", "ci_equals", "ci_in", "contains_flag", "contains_flags",
    "day_diff", "decimal_text", "hash_id", "is_numeric_text", "ladder", "later_of", "later_strict",
    "lenient_number", "month_boundary_diff", "not_blank", "pair_below", "plus_days", "plus_days_if_null",
    "range_by_family", "repair_return_date", "year_boundary_diff",
]
