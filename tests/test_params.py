"""Reporting clock: month boundaries derived from as_of."""

import datetime as dt

from cohortlake.params import AsOf, with_load_date

D = dt.date


def test_month_boundaries():
    a = AsOf.of("2024-03-31")
    assert (a.eopm, a.sopm, a.month_start) == (D(2024, 2, 29), D(2024, 2, 1), D(2024, 3, 1))
    j = AsOf.of(D(2021, 1, 1))
    assert (j.eopm, j.sopm, j.month_start) == (D(2020, 12, 31), D(2020, 12, 1), D(2021, 1, 1))
    assert AsOf.of(j) is j


def test_with_load_date(spark):
    df = AsOf.of("2021-02-15").with_load_date(spark.range(2))
    assert {r.load_date for r in df.collect()} == {D(2021, 2, 15)}
    assert {r.load_date for r in with_load_date(spark.range(1), "2021-02-15").collect()} == {D(2021, 2, 15)}
