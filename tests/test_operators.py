"""DataFrame building blocks on hand-made rows: ties, nulls, boundaries."""

import datetime as dt

from pyspark.sql import functions as F

from cohortlake.operators import (
    first_per_key,
    follow_up_in_window,
    full_merge,
    latest_as_at,
    latest_per_key,
    top_n_per_key,
    value_at_months,
)
from tests.conftest import rows

D = dt.date
SCHEMA = "k int, d date, id int, v string"


def test_latest_and_first_per_key_ties_and_nulls(spark):
    df = spark.createDataFrame([
        (1, D(2021, 1, 5), 1, "a"), (1, D(2021, 1, 5), 2, "b"), (1, None, 3, "c"),
        (2, None, 1, "x"), (2, D(2020, 1, 1), 2, "y"),
    ], SCHEMA)
    assert rows(latest_per_key(df, ["k"], "d", ["id"]), "k", "v") == [(1, "b"), (2, "y")]
    # ascending: a null date counts as the first row
    assert rows(first_per_key(df, ["k"], "d", ["id"]), "k", "v") == [(1, "c"), (2, "x")]


def test_top_n_per_key_ranks(spark):
    df = spark.createDataFrame([(1, D(2021, 1, i), i, str(i)) for i in range(1, 15)] + [(2, D(2021, 1, 1), 1, "z")],
                               SCHEMA)
    out = top_n_per_key(df, ["k"], "d", ["id"], n=10, rank_col="rank")
    got = rows(out, "k", "rank", "v")
    assert [r for r in got if r[0] == 1] == sorted([(1, r, str(15 - r)) for r in range(1, 11)], key=repr)
    assert (2, 1, "z") in got
    assert dict(out.dtypes)["rank"] == "bigint"


def test_latest_as_at_orders(spark):
    eopm = D(2021, 1, 31)
    df = spark.createDataFrame([
        (1, eopm, 1, "on"),                                   # newest event on the cut-off
        (2, D(2021, 1, 30), 1, "old"), (2, D(2021, 2, 1), 2, "new"),   # newest one day after
        (3, D(2021, 2, 5), 1, "after"),                       # only event after
    ], SCHEMA)
    rtc = rows(latest_as_at(df, ["k"], "d", eopm, ["id"], "rank_then_cut"), "k", "v")
    ctr = rows(latest_as_at(df, ["k"], "d", eopm, ["id"], "cut_then_rank"), "k", "v")
    assert rtc == [(1, "on")]
    assert ctr == [(1, "on"), (2, "old")]


def test_full_merge_coalesces_keys_left_first(spark):
    left = spark.createDataFrame([(1, "l1", D(2021, 1, 1)), (2, "l2", None)], "k int, name string, d date")
    right = spark.createDataFrame([(2, "r2", D(2021, 2, 1)), (3, "r3", D(2021, 3, 1))], "k int, name string, d date")
    out = full_merge(left, right, ["k"], coalesce={"name": ("name", "name"), "d": ("d", "d")},
                     present={"in_right": "right"})
    assert rows(out, "k", "name", "d", "in_right") == [
        (1, "l1", D(2021, 1, 1), 0), (2, "l2", D(2021, 2, 1), 1), (3, "r3", D(2021, 3, 1), 1)]


def test_value_at_months_calendar_boundaries(spark):
    anchors = spark.createDataFrame([(1, D(2021, 1, 31)), (2, None)], "k int, start date")
    events = spark.createDataFrame([
        (1, D(2021, 7, 1), 5, "jul-1"),      # 31 Jan -> 1 Jul is 6 boundaries
        (1, D(2021, 7, 20), 1, "jul-20"),    # same month, later
        (1, D(2021, 7, 1), 2, "jul-1b"),     # same date, lower id: first
        (1, D(2022, 1, 2), 3, "jan"),        # 12
        (1, None, 4, "nodate"),
        (2, D(2021, 7, 1), 1, "nostart"),
    ], SCHEMA)
    out = value_at_months(events, anchors, ["k"], "d", "start", [6, 12], ["v", "d"], tie=["id"])
    assert rows(out) == [(1, "jul-1b", D(2021, 7, 1), "jan", D(2022, 1, 2))]


def test_follow_up_in_window_boundaries(spark):
    anchors = spark.createDataFrame([(1, D(2021, 1, 1))], "k int, a date")
    events = spark.createDataFrame([(1, D(2021, 1, 1) + dt.timedelta(days=n), n, str(n)) for n in (59, 60, 67, 68)]
                                   + [(2, D(2021, 3, 2), 9, "other key")], SCHEMA)
    out = follow_up_in_window(events, anchors, ["k"], "d", "a", 60, 67)
    assert rows(out, "v") == [("60",), ("67",)]
    assert "Generate" in out._jdf.queryExecution().optimizedPlan().toString()


def test_windows_limit_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("id"),
                                  F.date_add(F.lit(D(2020, 1, 1)), (F.col("id") % 400).cast("int")).alias("d"))
    plan = latest_per_key(df, ["k"], "d", ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_join_group_facts_equals_plain_left_join(spark):
    from cohortlake.operators import join_group_facts

    detail = spark.createDataFrame([(i, 0 if i % 3 == 0 else i % 5) for i in range(200)] + [(999, None)],
                                   "id int, g int")
    facts = spark.createDataFrame([(0, "zero"), (1, "one"), (3, "three")], "g int, label string")
    salted = join_group_facts(detail, facts, ["g"], ["id"], ways=4)
    plain = detail.join(facts, "g", "left")
    assert rows(salted, "id", "g", "label") == rows(plain, "id", "g", "label")
