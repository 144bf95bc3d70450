"""One pass over the clinical visits for all datasets that reduce them per key.

Eight datasets want a key's newest or first visit, each under conditions of its own. Read
one by one, the visits are scanned, sorted and shuffled eight times. Here every
visit is stacked once for each kind of candidate it qualifies for; newest-first and
oldest-first orders become one ascending (order, tie) pair of numbers, so one ranking serves all
kinds. Map tasks forward the leading visits of each (key, kind) only (a partial limit below
the one exchange), so a key with very many visits stays small.

What remains holds the winners of every kind, all rows of them where several are equal, and
stands in for the visits: a dataset's own ranking over its kind gives the row it would
have found in the whole table.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlake.params import AsOf
from cohortlake.plans import KEY
from cohortlake.plans.pbfw import breastfeeding_visit, pregnant_visit
from cohortlake.plans.pregnancy import pregnant_answer

#: Added column: the kind of candidate.
KIND = "visit_kind"

#: Dataset -> the kinds of visits it reads.
USES = {
    "d01": ("newest",), "d02": ("newest",), "d06": ("newest_to_month_end",), "d08": ("newest_weighed",),
    "d09": ("newest",), "d10": ("newest", "first_pregnant", "first_pregnant_or_breastfeeding"),
    "d16": ("first_pregnant_live",), "d17": ("first_pregnant_live",),
}


def kinds(as_of) -> dict[str, tuple[Column, bool]]:
    """Kind -> (condition on the visit, newest first). Soft-deleted visits count only for the
    kinds of the pregnant and breastfeeding cohort, as in its rules."""
    is_live = F.col("voided") == 0
    return {
        "newest": (is_live, True),
        "newest_to_month_end": (is_live & (F.col("visit_date") <= AsOf.of(as_of).eopm_lit()), True),
        "newest_weighed": (is_live & F.col("weight").isNotNull(), True),
        "first_pregnant_live": (is_live & pregnant_answer(), False),
        "first_pregnant": (pregnant_visit(), False),
        "first_pregnant_or_breastfeeding": (pregnant_visit() | breastfeeding_visit(), False),
    }


def _number(c: str, kind: T.DataType) -> Column:
    """A date, timestamp or integer id as a number in the same order."""
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("long")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c)
    return F.col(c).cast("long")


def candidates(visits: DataFrame, as_of, wanted: Iterable[str] | None = None) -> DataFrame:
    """The visits that lead their key under one of the ``wanted`` kinds (default: all), with
    ``visit_kind``. Newest first: null dates and ids last; oldest first: null dates and ids first."""
    at, tie = (_number(c, visits.schema[c].dataType) for c in ("visit_date", "visit_id"))
    least = F.lit(-(1 << 63)).cast("long")
    greatest = F.lit((1 << 63) - 1).cast("long")
    chosen = {k: v for k, v in kinds(as_of).items() if wanted is None or k in set(wanted)}
    stacked = [
        F.when(holds, F.struct(
            F.lit(kind).alias(KIND),
            # ~x falls as x rises and never overflows
            *[F.coalesce(F.bitwise_not(x) if newest else x, greatest if newest else least).alias(name) for x, name in ((at, "__at"), (tie, "__tie"))],
        ))
        for kind, (holds, newest) in chosen.items()
    ]
    rows = visits.withColumn("__kind", F.explode(F.array_compact(F.array(*stacked)))).select(*visits.columns, "__kind.*")
    order = Window.partitionBy(*KEY, KIND).orderBy("__at", "__tie")
    leading = rows.withColumn("__rank", F.rank().over(order)).filter("__rank = 1").drop("__rank", "__at", "__tie")
    return leading.sortWithinPartitions(KIND)


def of_kind(found: DataFrame, *wanted: str) -> DataFrame:
    """The candidates of some kinds, with the visits' own columns."""
    return found.filter(F.col(KIND).isin(list(wanted))).drop(KIND)
