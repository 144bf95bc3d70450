"""Boundary-counting date differences and date repair rules."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from cohortlake.functions._util import col


def day_diff(start, end) -> Column:
    """Days from ``start`` to ``end`` (midnights crossed); null if either is null."""
    return F.datediff(col(end), col(start))


def month_boundary_diff(start, end) -> Column:
    """Number of month boundaries crossed from ``start`` to ``end``.

    31 Jan -> 1 Feb is 1, 1 Jan -> 31 Jan is 0 (not ``months_between``).
    """
    s, e = col(start), col(end)
    return (F.year(e) - F.year(s)) * 12 + (F.month(e) - F.month(s))


def year_boundary_diff(start, end) -> Column:
    """Number of year boundaries crossed (an "age" that can be one too high)."""
    return F.year(col(end)) - F.year(col(start))


def plus_days(c, days: int) -> Column:
    """``c + days``; a date stays a date, a timestamp keeps its time of day."""
    return col(c) + F.expr(f"INTERVAL '{int(days)}' DAY")


def plus_days_if_null(value, base, days: int = 30) -> Column:
    """``value``, or ``base + days`` when ``value`` is null."""
    return F.coalesce(col(value), plus_days(base, days))


def repair_return_date(value, base, max_days: int = 365,
                       sentinel: dt.date = dt.date(1900, 1, 1), days: int = 30) -> Column:
    """Replace a return date that is too far (>= ``max_days`` after ``base``),
    equal to the ``sentinel`` or null by ``base + days``."""
    v = col(value)
    bad = (day_diff(base, v) >= max_days) | (v == F.lit(sentinel)) | v.isNull()
    return F.when(bad, plus_days(base, days)).otherwise(v)
