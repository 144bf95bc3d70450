"""Products of rows within a key, spread over tasks where a key has very many of them.

A key's rows are multiplied in cells (key, share): one side is dealt to the key's shares by its
hash, the others are copied to every share. Each combination is met in exactly one
cell, a key's product is built by as many tasks as it has shares, and the share is a pure
function of the row, so task retries see the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Columns of a key's number of shares and of a row's share.
WAYS, SHARE = "__ways", "__share"


def large_keys(sizes: DataFrame, keys: Sequence[str], large: Column, ways: Column) -> DataFrame:
    """(keys, ``__ways``) of the rows of ``sizes`` (one row per key) that are ``large``.

    The list is distributed again, by key and ways (by the key alone Spark leaves the exchange
    out where ``sizes`` is distributed so): its size is then known before what joins it is
    planned, and with an empty list (the usual case) the branch for large keys
    is dropped from the running plan.
    """
    return sizes.filter(large).select(*keys, F.greatest(F.ceil(ways).cast("int"), F.lit(1)).alias(WAYS)).repartition(*keys, WAYS)


def in_tasks(df: DataFrame, *by: str) -> DataFrame:
    """``df`` distributed by the columns to as many tasks as the session shuffles to. Rows about to be
    multiplied are few and small; with the number given they are not put together by their size,
    nor is the distribution left out where the other side of a join turns out small."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by)


def dealt(df: DataFrame, keys: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Rows of large keys (with ``__ways``), each in one share of its key, chosen by the hash of ``by``."""
    share = F.pmod(F.xxhash64(*by), F.col(WAYS)).cast("int")
    return in_tasks(df.withColumn(SHARE, share).drop(WAYS), *keys, SHARE)


def copied(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of large keys (with ``__ways``), each in every share of its key."""
    return in_tasks(df.withColumn(SHARE, F.explode(F.sequence(F.lit(0), F.col(WAYS) - 1))).drop(WAYS), *keys, SHARE)
