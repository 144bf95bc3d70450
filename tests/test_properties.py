"""Operators against pure-Python brute force on random inputs (ties, nulls, skew)."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cohortlake.operators import follow_up_in_window, latest_as_at, top_n_per_key, value_at_months

D0 = dt.date(2020, 1, 1)
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

events = st.lists(
    st.tuples(st.sampled_from([0, 0, 0, 1, 2, 3]),                       # key 0 is hot
              st.one_of(st.none(), st.integers(0, 400).map(lambda d: D0 + dt.timedelta(days=d))),
              st.integers(0, 5)),                                          # small id range: ties
    min_size=0, max_size=40)


def _df(spark, rows):
    return spark.createDataFrame([(k, d, i, f"{k}-{j}") for j, (k, d, i) in enumerate(rows)],
                                 "k int, d date, id int, v string")


def _newest_first(r):
    """Sort key whose maximum is the newest row: dated rows above null dates,
    then date, id and value (a total order)."""
    _, d, i, v = r
    return (d is not None, d or D0, i, v)


@SETTINGS
@given(rows=events, n=st.integers(1, 4))
def test_top_n_matches_brute_force(spark, rows, n):
    df = _df(spark, rows)
    got = sorted(tuple(r) for r in top_n_per_key(df, ["k"], "d", ["id", "v"], n=n, rank_col="rank")
                 .select("k", "rank", "v").collect())
    want = []
    data = [(k, d, i, f"{k}-{j}") for j, (k, d, i) in enumerate(rows)]
    for key in {r[0] for r in data}:
        grp = sorted((r for r in data if r[0] == key), key=_newest_first, reverse=True)
        want += [(key, rank + 1, r[3]) for rank, r in enumerate(grp[:n])]
    assert got == sorted(want)


@SETTINGS
@given(rows=events, cut=st.integers(0, 400), order=st.sampled_from(["rank_then_cut", "cut_then_rank"]))
def test_latest_as_at_matches_brute_force(spark, rows, cut, order):
    cutoff = D0 + dt.timedelta(days=cut)
    df = _df(spark, rows)
    got = sorted(r.v for r in latest_as_at(df, ["k"], "d", cutoff, ["id", "v"], order).collect())
    data = [(k, d, i, f"{k}-{j}") for j, (k, d, i) in enumerate(rows)]
    want = []
    for key in {r[0] for r in data}:
        grp = [r for r in data if r[0] == key]
        if order == "cut_then_rank":
            grp = [r for r in grp if r[1] is not None and r[1] <= cutoff]
        if not grp:
            continue
        top = max(grp, key=_newest_first)
        if top[1] is not None and top[1] <= cutoff:
            want.append(top[3])
    assert got == sorted(want)


@SETTINGS
@given(rows=events, lo=st.integers(0, 60), width=st.integers(0, 10))
def test_follow_up_in_window_matches_brute_force(spark, rows, lo, width):
    hi = lo + width
    anchors = [(0, D0 + dt.timedelta(days=10)), (1, D0 + dt.timedelta(days=100)), (2, None)]
    a = spark.createDataFrame(anchors, "k int, a date")
    got = sorted(r.v for r in follow_up_in_window(_df(spark, rows), a, ["k"], "d", "a", lo, hi).collect())
    want = sorted(f"{k}-{j}" for j, (k, d, i) in enumerate(rows) for ak, ad in anchors
                  if k == ak and d is not None and ad is not None and lo <= (d - ad).days <= hi)
    assert got == want


@SETTINGS
@given(rows=events)
def test_value_at_months_matches_brute_force(spark, rows):
    starts = [(0, dt.date(2019, 11, 30)), (1, dt.date(2020, 1, 31)), (3, None)]
    a = spark.createDataFrame(starts, "k int, s date")
    months = [1, 2, 6]
    out = value_at_months(_df(spark, rows), a, ["k"], "d", "s", months, ["v"], tie=["id"],
                          name=lambda m, v: f"{v}_{m}")
    got = sorted(tuple(r) for r in out.collect())
    data = [(k, d, i, f"{k}-{j}") for j, (k, d, i) in enumerate(rows)]
    want = []
    for key, s in starts:
        if s is None:
            continue
        row, hit = [key], False
        for m in months:
            cands = [r for r in data if r[0] == key and r[1] is not None
                     and (r[1].year - s.year) * 12 + r[1].month - s.month == m]
            best = min(cands, key=lambda r: (r[1], r[2], r[3])) if cands else None
            row.append(best[3] if best else None)
            hit = hit or best is not None
        if hit:
            want.append(tuple(row))
    assert got == sorted(want)


small_rows = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 4)), st.integers(0, 9)), max_size=12)


@SETTINGS
@given(left=small_rows, right=small_rows)
def test_full_merge_matches_brute_force(spark, left, right):
    from cohortlake.operators import full_merge

    lrows = [(k, v, f"l{j}") for j, (k, v) in enumerate(left)]
    rrows = [(k, v, f"r{j}") for j, (k, v) in enumerate(right)]
    ldf = spark.createDataFrame(lrows, "k int, v int, tag string")
    rdf = spark.createDataFrame(rrows, "k int, v int, tag string")
    out = full_merge(ldf, rdf, ["k"], coalesce={"v": ("v", "v")}, left_cols={"lt": "tag"}, right_cols={"rt": "tag"},
                     present={"in_right": "right"})
    got = sorted((tuple(r) for r in out.select("k", "v", "lt", "rt", "in_right").collect()), key=repr)
    want = []
    for lk, lv, lt in lrows:
        matches = [r for r in rrows if lk is not None and r[0] == lk]
        want += [(lk, lv, lt, rt, 1) for _, _, rt in matches] or [(lk, lv, lt, None, 0)]
    for rk, rv, rt in rrows:
        if not any(rk is not None and l[0] == rk for l in lrows):
            want.append((rk, rv, None, rt, 1 if rk is not None else 0))
    assert got == sorted(want, key=repr)


@SETTINGS
@given(detail=small_rows, ways=st.integers(1, 6))
def test_join_group_facts_matches_plain_join(spark, detail, ways):
    from cohortlake.operators import join_group_facts

    d = spark.createDataFrame([(g, i, j) for j, (g, i) in enumerate(detail)], "g int, x int, id int")
    facts = spark.createDataFrame([(0, "a"), (1, "b"), (4, "e")], "g int, label string")
    got = sorted(tuple(r) for r in join_group_facts(d, facts, ["g"], ["id"], ways=ways)
                 .select("id", "label").collect())
    names = {0: "a", 1: "b", 4: "e"}
    assert got == sorted((j, names.get(g)) for j, (g, _) in enumerate(detail))
