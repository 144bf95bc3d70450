"""Per-key ranking: latest / first / top-n rows per key, as-at cut-offs.

``row_number() over (partition by keys order by ts, tie...)`` followed by a
filter ``rn = 1`` / ``rn <= n`` is planned by Catalyst as a *partial*
``WindowGroupLimit`` before the shuffle and a final one after it, so each map
task forwards at most ``n`` rows per key: a key holding a large share of the
rows does not land whole in one task. Ties on ``ts`` are broken by the
``tie`` columns in the same direction, so results are deterministic (task
retries and re-runs give the same rows).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RN = "__rn"


def live(df: DataFrame, flag: str = "voided") -> DataFrame:
    """Rows not soft-deleted (``flag = 0``); pushed down to the scan."""
    return df.filter(F.col(flag) == 0)


def _order(ts: str | Sequence[str], tie: Sequence[str], desc: bool) -> list[Column]:
    cols = ([ts] if isinstance(ts, str) else list(ts)) + list(tie)
    if desc:
        return [F.col(c).desc_nulls_last() for c in cols]
    return [F.col(c).asc_nulls_first() for c in cols]


def ranked(df: DataFrame, keys: Sequence[str], ts, tie: Sequence[str] = (), desc: bool = True,
           rank_col: str = _RN) -> DataFrame:
    """Add ``rank_col`` = row_number over ``keys`` ordered by ``ts`` then ``tie``
    (descending: nulls last; ascending: nulls first)."""
    w = Window.partitionBy(*keys).orderBy(*_order(ts, tie, desc))
    return df.withColumn(rank_col, F.row_number().over(w))


def _finish(df: DataFrame, rank_col: str | None) -> DataFrame:
    if rank_col is None:
        return df.drop(_RN)
    return df.withColumn(_RN, F.col(_RN).cast("bigint")).withColumnRenamed(_RN, rank_col)


def top_n_per_key(df: DataFrame, keys: Sequence[str], ts, tie: Sequence[str] = (), n: int = 10,
                  desc: bool = True, rank_col: str | None = "rank", where: Column | None = None) -> DataFrame:
    """The first ``n`` rows per key in the given order, with their rank (BIGINT)."""
    if where is not None:
        df = df.filter(where)
    out = ranked(df, keys, ts, tie, desc).filter(F.col(_RN) <= n)
    return _finish(out, rank_col)


def latest_per_key(df: DataFrame, keys: Sequence[str], ts, tie: Sequence[str] = (),
                   rank_col: str | None = None, where: Column | None = None) -> DataFrame:
    """Newest row per key (``ts`` descending, nulls last)."""
    return top_n_per_key(df, keys, ts, tie, 1, True, rank_col, where)


def first_per_key(df: DataFrame, keys: Sequence[str], ts, tie: Sequence[str] = (),
                  rank_col: str | None = None, where: Column | None = None) -> DataFrame:
    """Oldest row per key (``ts`` ascending, nulls first: a null-dated row is "first")."""
    return top_n_per_key(df, keys, ts, tie, 1, False, rank_col, where)


def dedup_encounters(df: DataFrame, keys: Sequence[str], id_col: str, tie: Sequence[str] = (),
                     rank_col: str | None = None) -> DataFrame:
    """Keep the row with the highest ``id_col`` per composite key."""
    return latest_per_key(df, keys, id_col, tie, rank_col)


def latest_as_at(df: DataFrame, keys: Sequence[str], ts: str, cutoff, tie: Sequence[str] = (),
                 order: str = "rank_then_cut", rank_col: str | None = None) -> DataFrame:
    """Newest row per key on or before ``cutoff``.

    ``rank_then_cut``: rank all rows, keep the newest only if it is <= cutoff
    (a key whose newest row is later than the cutoff drops out).
    ``cut_then_rank``: drop rows after the cutoff, then take the newest.
    """
    cut = F.col(ts) <= (cutoff if isinstance(cutoff, Column) else F.lit(cutoff))
    if order == "cut_then_rank":
        return latest_per_key(df.filter(cut), keys, ts, tie, rank_col)
    if order != "rank_then_cut":
        raise ValueError(f"unknown order {order!r}")
    out = ranked(df, keys, ts, tie, True).filter((F.col(_RN) == 1) & cut)
    return _finish(out, rank_col)

