"""Column building blocks on hand-made edge values."""

import datetime as dt

from pyspark.sql import functions as F

from cohortlake.functions import (
    plus_days_if_null,
    banded_days,
    below_or_in,
    contains_flags,
    decimal_text,
    hash_id,
    ladder,
    later_of,
    later_strict,
    lenient_number,
    month_boundary_diff,
    pair_below,
    range_by_family,
    repair_return_date,
    year_boundary_diff,
)

D = dt.date


def one_col(spark, values, typ="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {typ}")


def evaluate(spark, values, expr, typ="string"):
    df = one_col(spark, values, typ).select("i", expr.alias("y")).orderBy("i")
    return [r.y for r in df.collect()]


def test_pair_below_blood_pressure(spark):
    values = ["139.9/89.9", "140/89", "120/90", "120", "/80", "120/", "1e2/80", "NaN/80", "120/80 ",
              "120/80/1", None, "high/low", "120-80", " 100 / 60"]
    got = evaluate(spark, values, pair_below(F.col("x"), "/", 140.0, 90.0))
    assert got == [True, False, False, False, False, False, True, False, True, False, False, False, False, True]


def test_lenient_number_and_suppression(spark):
    values = ["199.99", "200", "1,200", "LDL", "ldl", "> 1000", "$5", "undetectable", None, "0 copies/ml", "150"]
    assert evaluate(spark, values, lenient_number("x")) == [199.99, 200.0, 1200.0, None, None, None, None, None,
                                                             None, None, 150.0]
    words = ["undetectable", "NOT DETECTED", "0 copies/ml", "LDL", "Less than Low Detectable Level"]
    assert evaluate(spark, values, below_or_in("x", 200.0, words)) == [1, 0, 0, 1, 1, 0, 0, 1, 0, 1, 1]


def test_decimal_text_rounds_half_up_and_rejects_bad_text(spark):
    values = ["6.5", "6.51", "7.0", "6.99", "0", "-1", "abc", "6.504", "6.505", "1e2", None]
    got = evaluate(spark, values, decimal_text("x", 18, 2))
    assert [None if v is None else float(v) for v in got] == [6.5, 6.51, 7.0, 6.99, 0.0, -1.0, None, 6.5, 6.51,
                                                              None, None]


def test_range_by_family(spark):
    fams = [(["HgB", "HbsAg", "HBA1C"], 0.0, 6.5, True), (["FBS", "Blood Sugar"], 0.0, 7.0, False)]
    df = spark.createDataFrame(
        [(1, "HBA1C", 6.5), (2, "hba1c", 6.51), (3, "FBS", 7.0), (4, "FBS", 6.99), (5, "HBA1C", 0.0),
         (6, "HBA1C", -1.0), (7, "FBS", None), (8, "Other", 5.0)], "i int, n string, v double")
    got = [r.y for r in df.select("i", range_by_family("n", "v", fams).alias("y")).orderBy("i").collect()]
    assert got == [True, False, False, True, False, False, False, False]


def test_repair_return_date(spark):
    base = D(2021, 1, 1)
    df = spark.createDataFrame(
        [(1, base, D(2021, 12, 31)), (2, base, D(2022, 1, 1)), (3, base, D(2022, 1, 2)), (4, base, D(1900, 1, 1)),
         (5, base, None), (6, base, D(2021, 1, 20))], "i int, b date, r date")
    got = [r.y for r in df.select("i", repair_return_date("r", "b").alias("y")).orderBy("i").collect()]
    plus30 = D(2021, 1, 31)
    assert got == [D(2021, 12, 31), plus30, plus30, plus30, plus30, D(2021, 1, 20)]


def test_boundary_differences(spark):
    df = spark.createDataFrame(
        [(1, D(2021, 1, 31), D(2021, 7, 1)), (2, D(2021, 1, 1), D(2021, 1, 31)), (3, D(2020, 12, 31), D(2021, 1, 1))],
        "i int, a date, b date")
    got = df.select("i", month_boundary_diff("a", "b").alias("m"), year_boundary_diff("a", "b").alias("y")) \
        .orderBy("i").collect()
    assert [(r.m, r.y) for r in got] == [(6, 0), (0, 0), (1, 1)]


def test_banded_days(spark):
    a = D(2021, 1, 1)
    df = spark.createDataFrame([(1, a, D(2021, 3, 31)), (2, a, D(2021, 4, 1)), (3, a, D(2020, 10, 3)), (4, a, None)],
                               "i int, a date, b date")
    got = [r.y for r in df.select("i", banded_days("a", "b").alias("y")).orderBy("i").collect()]
    assert got == [0, 1, 1, None]


def test_hash_id_reads_the_whole_text_unless_a_width_is_given(spark):
    s30, s31 = "x" * 30, "x" * 30 + "y"
    got = evaluate(spark, [s30, s31, None], hash_id("x"))
    assert got[0] != got[1] and len(got[0]) == 64 and got[0] == got[0].upper() and got[2] is None
    cut = evaluate(spark, [s30, s31, None], hash_id("x", 30))
    assert cut[0] == cut[1] == got[0]


def test_numbers_beyond_a_double_are_null(spark):
    assert evaluate(spark, ["1e400", "-1e400", "1e300"], lenient_number("x")) == [None, None, 1e300]


def test_added_days_keep_the_time_of_day(spark):
    import datetime as dt

    df = spark.createDataFrame([(dt.datetime(2020, 1, 1, 14, 30), D(2020, 1, 1))], "t timestamp, d date")
    none = F.lit(None)
    r = df.select(plus_days_if_null(none.cast("timestamp"), "t").alias("t"), plus_days_if_null(none.cast("date"), "d").alias("d"),
                  repair_return_date(none.cast("timestamp"), "t").alias("r")).first()
    assert (r.t, r.d, r.r) == (dt.datetime(2020, 1, 31, 14, 30), D(2020, 1, 31), dt.datetime(2020, 1, 31, 14, 30))


def test_contains_flags_case_insensitive_and_null(spark):
    df = one_col(spark, ["Orientation, srh", None, "Beyond"])
    got = df.select("i", *contains_flags("x", {"o": "Orientation", "s": "SRH", "b": "Beyon"})).orderBy("i").collect()
    assert [(r.o, r.s, r.b) for r in got] == [(1, 1, 0), (0, 0, 0), (0, 0, 1)]


def test_later_of_and_later_strict(spark):
    df = spark.createDataFrame([(1, D(2021, 1, 2), D(2021, 1, 1)), (2, D(2021, 1, 1), D(2021, 1, 1)),
                                (3, None, D(2021, 1, 1)), (4, D(2021, 1, 1), None)], "i int, a date, b date")
    got = df.select("i", later_of("a", "b").alias("g"), later_strict("a", "b").alias("s")).orderBy("i").collect()
    assert [(r.g, r.s) for r in got] == [(D(2021, 1, 2), D(2021, 1, 2)), (D(2021, 1, 1), None),
                                         (D(2021, 1, 1), None), (D(2021, 1, 1), None)]


def test_ladder_first_match_and_null_condition(spark):
    df = one_col(spark, [5, 15, None, 25], "int")
    expr = ladder([(F.col("x") < 10, "low"), (F.col("x") < 20, "mid")], default="high")
    assert evaluate(spark, [5, 15, None, 25], expr, "int") == ["low", "mid", "high", "high"]
    assert df.count() == 4
