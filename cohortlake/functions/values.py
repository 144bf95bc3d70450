"""Text/number value helpers: lenient numbers, flags, hashes, null-skipping maxima.

Text comparisons that the source system made under a case-insensitive,
trailing-blank-insensitive collation are written as ``upper(rtrim(x))``.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from cohortlake.functions._util import col

# Digits with optional sign, decimal point, thousands commas and exponent.
# Currency symbols, NaN and Infinity are not numbers here.
NUMERIC_TEXT = r"^\s*[+-]?([0-9][0-9,]*\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
# Plain decimal text (no commas, no exponent): what a cast to DECIMAL accepts.
DECIMAL_TEXT = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)\s*$"


def ci(c) -> Column:
    """Collation key: upper case, trailing blanks removed."""
    return F.upper(F.rtrim(col(c)))


def ci_equals(c, value: str) -> Column:
    return ci(c) == F.lit(value.rstrip().upper())


def ci_in(c, values: Iterable[str]) -> Column:
    return ci(c).isin([v.rstrip().upper() for v in values])


def not_blank(c) -> Column:
    """``x <> ''`` under a trailing-blank-insensitive collation (null -> null)."""
    return F.rtrim(col(c)) != F.lit("")


def is_numeric_text(c) -> Column:
    """True when the text is a number (sign, point, thousands commas, exponent)."""
    return F.coalesce(col(c).rlike(NUMERIC_TEXT), F.lit(False))


def lenient_number(c) -> Column:
    """The number in a text, commas removed; null when the text is not numeric
    or too large for a double."""
    number = F.regexp_replace(col(c), ",", "").try_cast("double")
    return F.when(is_numeric_text(c) & (F.abs(number) < float("inf")), number)


def decimal_text(c, precision: int = 18, scale: int = 2) -> Column:
    """``TRY_CAST(x AS DECIMAL(p, s))`` (rounds half up); null on bad text."""
    return F.when(col(c).rlike(DECIMAL_TEXT), F.trim(col(c)).try_cast(f"decimal({precision},{scale})"))


def pair_below(c, sep: str = "/", max_left: float = 140.0, max_right: float = 90.0) -> Column:
    """True when ``"<left><sep><right>"`` has two numeric halves (split at the
    first separator, blanks trimmed) with left < ``max_left`` and right < ``max_right``."""
    parts = F.split(col(c), re.escape(sep), 2)
    left, right = F.trim(F.get(parts, 0)), F.trim(F.get(parts, 1))
    ok = (
        (F.instr(col(c), sep) > 0)
        & is_numeric_text(left)
        & is_numeric_text(right)
        & (left.try_cast("double") < max_left)
        & (right.try_cast("double") < max_right)
    )
    return F.coalesce(ok, F.lit(False))


def contains_flag(c, needle: str) -> Column:
    """1 when ``needle`` occurs in the text (case-insensitive), else 0 (null -> 0)."""
    return F.when(F.instr(F.upper(col(c)), needle.upper()) > 0, 1).otherwise(0)


def contains_flags(c, needles: Mapping[str, str]) -> list[Column]:
    """One 0/1 flag column per ``{output_name: needle}``."""
    return [contains_flag(c, needle).alias(name) for name, needle in needles.items()]


def below_or_in(c, limit: float, words: Sequence[str]) -> Column:
    """1 if numeric text (commas removed) is below ``limit``; for other text,
    1 if it is one of ``words`` (case-insensitive); else 0."""
    return (
        F.when(is_numeric_text(c), F.when(lenient_number(c) < limit, 1).otherwise(0))
        .when(ci_in(c, words), 1)
        .otherwise(0)
    )


def range_by_family(name, value, families: Sequence[tuple[Sequence[str], float, float, bool]]) -> Column:
    """True when ``value`` lies in the range of the family ``name`` belongs to.

    ``families`` = ``[(names, low_exclusive, high, high_inclusive), ...]``.
    """
    out = F.lit(False)
    v = col(value)
    for names, lo, hi, closed in families:
        upper_ok = (v <= hi) if closed else (v < hi)
        out = out | (ci_in(name, names) & (v > lo) & upper_ok)
    return F.coalesce(out, F.lit(False))


def banded_days(a, b, limit: int = 90) -> Column:
    """0 when |days(a, b)| < ``limit``, 1 when >= ``limit``, null when unknown."""
    d = F.abs(F.datediff(col(b), col(a)))
    return F.when(d <= limit - 1, 0).when(d >= limit, 1)


def later_of(*cols) -> Column:
    """Null-skipping maximum (``greatest``)."""
    return F.greatest(*[col(c) for c in cols])


def later_strict(a, b) -> Column:
    """``a`` when it is strictly later than ``b``, else null."""
    return F.when(col(a) > col(b), col(a))


def hash_id(c, max_chars: int | None = None) -> Column:
    """Upper-case hex SHA-256 of the whole text (null -> null). ``max_chars``
    cuts the text first, for identifiers whose tail is known to be padding;
    different texts with the same start then share a hash."""
    text = col(c).cast("string")
    return F.upper(F.sha2(text if max_chars is None else F.substring(text, 1, max_chars), 256))
