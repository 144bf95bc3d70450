"""The building blocks run directly on the raw test tables (no adapter), so
each operator is checked as a general keyed-event operator: customers are
the key, orders and line items the events."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlake.functions import (
    plus_days_if_null,
    banded_days,
    below_or_in,
    contains_flags,
    day_diff,
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
from cohortlake.operators import (
    dedup_encounters,
    first_per_key,
    follow_up_in_window,
    full_merge,
    latest_as_at,
    join_group_facts,
    latest_by_group,
    latest_per_key,
    left_enrich,
    rows_at_event,
    top_n_per_key,
    value_at_months,
)
from cohortlake.params import AsOf
from cohortlake.sources.tables import read_table

# Reporting date for the raw-table examples (inside the order date range).
EXAMPLE_AS_OF = AsOf(dt.date(1998, 8, 15))


def _orders(spark, sf):
    return read_table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", F.to_date("o_orderdate").alias("order_date")
    )


def _lines(spark, sf):
    li = read_table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", F.to_date("l_shipdate").alias("ship_date")
    )
    return li.join(_orders(spark, sf).select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "order_date"),
                   "l_orderkey")


def latest_order_per_customer(spark: SparkSession, sf: str) -> DataFrame:
    top = latest_per_key(_orders(spark, sf), ["o_custkey"], "order_date", ["o_orderkey"], rank_col="rn")
    return top.select("o_custkey", "o_orderkey", "order_date", "o_totalprice", "rn")


def first_order_per_customer(spark: SparkSession, sf: str) -> DataFrame:
    top = first_per_key(_orders(spark, sf), ["o_custkey"], "order_date", ["o_orderkey"], rank_col="rn")
    return top.select("o_custkey", "o_orderkey", "order_date", "o_totalprice", "rn")


def top10_lineitems_per_order_customer(spark: SparkSession, sf: str) -> DataFrame:
    top = top_n_per_key(_lines(spark, sf), ["o_custkey"], "ship_date", ["l_orderkey", "l_linenumber", "l_quantity"],
                        n=10, rank_col="rank")
    return top.select("o_custkey", "rank", "l_orderkey", "l_linenumber", "ship_date", "l_quantity")


def _as_at(spark, sf, order):
    top = latest_as_at(_orders(spark, sf), ["o_custkey"], "order_date", EXAMPLE_AS_OF.eopm, ["o_orderkey"], order,
                       rank_col="rn")
    return top.select("o_custkey", "o_orderkey", "order_date", "rn")


def latest_order_as_at_rank_then_cut(spark: SparkSession, sf: str) -> DataFrame:
    return _as_at(spark, sf, "rank_then_cut")


def latest_order_as_at_cut_then_rank(spark: SparkSession, sf: str) -> DataFrame:
    return _as_at(spark, sf, "cut_then_rank")


def later_of_full_merge_orders_shipments(spark: SparkSession, sf: str) -> DataFrame:
    """Latest open order and latest returned shipment per customer, fully merged."""
    open_orders = latest_per_key(_orders(spark, sf).filter(F.col("o_orderstatus") == "O"), ["o_custkey"],
                                 "order_date", ["o_orderkey"])
    returns = latest_per_key(_lines(spark, sf).filter(F.col("l_returnflag") == "R"), ["o_custkey"], "ship_date",
                             ["l_orderkey", "l_linenumber", "l_quantity"])
    merged = full_merge(open_orders, returns, ["o_custkey"],
                        left_cols={"last_open_order": "order_date"}, right_cols={"last_return": "ship_date"},
                        present={"has_return": "right"})
    return merged.select(
        "o_custkey", "last_open_order", "last_return", "has_return",
        later_of("last_open_order", "last_return").alias("later_date"),
        later_strict("last_return", "last_open_order").alias("return_if_later"),
    )


def month_boundary_diff_orders(spark: SparkSession, sf: str) -> DataFrame:
    li = _lines(spark, sf)
    return li.groupBy(
        month_boundary_diff("order_date", "ship_date").alias("months"),
        year_boundary_diff("order_date", "ship_date").alias("years"),
    ).agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.min(day_diff("order_date", "ship_date")).alias("min_days"),
        F.max(day_diff("order_date", "ship_date")).alias("max_days"),
    )


def milestone_value_at_months(spark: SparkSession, sf: str) -> DataFrame:
    """Quantity and date of the first shipment exactly 1/2/3/6 calendar months
    after each customer's first order."""
    first = _orders(spark, sf).groupBy("o_custkey").agg(F.min("order_date").alias("first_order"))
    return value_at_months(
        _lines(spark, sf), first, ["o_custkey"], "ship_date", "first_order", [1, 2, 3, 6],
        ["l_quantity", "ship_date"], tie=["l_orderkey", "l_linenumber", "l_quantity"],
        name=lambda m, v: f"qty_{m}m" if v == "l_quantity" else f"date_{m}m",
    )


def follow_up_in_window_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders placed 30-37 days after the customer's first order."""
    o = _orders(spark, sf)
    first = o.groupBy("o_custkey").agg(F.min("order_date").alias("first_order"))
    hits = follow_up_in_window(o.select("o_custkey", "o_orderkey", "order_date"), first, ["o_custkey"],
                               "order_date", "first_order", 30, 37)
    return hits.select("o_custkey", "first_order", "o_orderkey", "order_date",
                       day_diff("first_order", "order_date").alias("days_after"))


def rule_ladder_customers(spark: SparkSession, sf: str) -> DataFrame:
    c = read_table(spark, sf, "customer")
    bal = F.col("c_acctbal")
    code = ladder([
        (bal < 0, "NEG"),
        ((F.col("c_mktsegment") == "BUILDING") & (bal > 5000), "BIG_BUILD"),
        (bal.between(0, 1000), "LOW"),
        (F.col("c_nationkey").isin(1, 2, 3), "N123"),
    ], default=F.substring("c_mktsegment", 1, 1))
    return c.select("c_custkey", code.alias("code"))


def contains_flags_part_names(spark: SparkSession, sf: str) -> DataFrame:
    p = read_table(spark, sf, "part")
    return p.select("p_partkey", "p_name", *contains_flags("p_name", {
        "has_ring": "ring", "has_hot": "HOT", "has_plate": "plate", "has_wid": "wid",
    }))


def pair_split_numeric_check(spark: SparkSession, sf: str) -> DataFrame:
    """"a/b" readings derived from order and customer keys, some malformed."""
    o = read_table(spark, sf, "orders")
    k = F.col("o_orderkey")
    text = (
        F.when(k % 11 == 0, F.concat((k % 180).cast("string"), F.lit("/x")))
        .when(k % 13 == 0, F.concat((k % 180).cast("string"), F.lit("-"), (F.col("o_custkey") % 120).cast("string")))
        .when(k % 17 == 0, F.concat(F.lit("/"), (k % 120).cast("string")))
        .otherwise(F.concat((k % 180).cast("string"), F.lit("/"), (F.col("o_custkey") % 120).cast("string")))
    )
    return o.select("o_orderkey", text.alias("reading")).select(
        "o_orderkey", "reading", F.when(pair_below("reading", "/", 140.0, 90.0), 1).otherwise(0).alias("below")
    )


def lenient_number_classify(spark: SparkSession, sf: str) -> DataFrame:
    li = read_table(spark, sf, "lineitem")
    ln = F.col("l_linenumber")
    text = (
        F.when(ln == 1, F.lit("LDL"))
        .when(ln == 2, F.lit("undetectable"))
        .when(ln == 6, F.concat(F.floor("l_quantity").cast("int").cast("string"), F.lit(",000")))
        .when(ln == 7, F.lit("n/a"))
        .otherwise(F.floor("l_extendedprice").cast("bigint").cast("string"))
    )
    return li.select("l_orderkey", "l_linenumber", text.alias("result")).select(
        "l_orderkey", "l_linenumber", "result",
        lenient_number("result").alias("value"),
        below_or_in("result", 200.0, ["undetectable", "LDL"]).alias("suppressed"),
    )


def hashed_customer_key(spark: SparkSession, sf: str) -> DataFrame:
    c = read_table(spark, sf, "customer")
    return c.select("c_custkey", hash_id("c_name").alias("name_hash"), hash_id("c_custkey", 64).alias("key_hash"))


def max_date_per_site_salted_join(spark: SparkSession, sf: str) -> DataFrame:
    c = read_table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    o = _orders(spark, sf).join(c.withColumnRenamed("c_custkey", "o_custkey"), "o_custkey")
    per_nation = latest_by_group(o, ["c_nationkey"], "order_date", "nation_last_order")
    return join_group_facts(c, per_nation, ["c_nationkey"], ["c_custkey"]).select(
        "c_custkey", "c_nationkey", "nation_last_order")


def encounter_dedup_multi_key(spark: SparkSession, sf: str) -> DataFrame:
    li = read_table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", F.to_date("l_shipdate").alias("ship_date")
    )
    top = dedup_encounters(li, ["l_orderkey", "ship_date", "l_returnflag"], "l_linenumber", ["l_quantity"],
                           rank_col="num")
    return top.select("l_orderkey", "ship_date", "l_returnflag", "l_linenumber", "l_quantity", "num")


def lineitems_of_latest_order(spark: SparkSession, sf: str) -> DataFrame:
    """Line items of each customer's latest order (rows at the anchor event)."""
    latest = latest_per_key(_orders(spark, sf), ["o_custkey"], "order_date", ["o_orderkey"])
    lines = _lines(spark, sf).withColumnRenamed("l_orderkey", "o_orderkey")
    return rows_at_event(lines, latest, ["o_custkey"], "order_date", "o_orderkey").select(
        "o_custkey", "o_orderkey", "l_linenumber", "l_quantity", "ship_date")


def repaired_ship_dates(spark: SparkSession, sf: str) -> DataFrame:
    """Ship dates 60+ days after the order, on a sentinel day or missing
    become order date + 30."""
    li = _lines(spark, sf)
    return li.select("l_orderkey", "l_linenumber", "order_date", "ship_date",
                     repair_return_date("ship_date", "order_date", max_days=60, sentinel=dt.date(1996, 1, 2),
                                        days=30).alias("repaired"))


def part_size_in_family_range(spark: SparkSession, sf: str) -> DataFrame:
    p = read_table(spark, sf, "part")
    fams = [(["SMALL", "MEDIUM"], 0.0, 20.0, True), (["LARGE", "PROMO"], 10.0, 40.0, False)]
    return p.select("p_partkey", "p_type", "p_size",
                    F.when(range_by_family("p_type", "p_size", fams), 1).otherwise(0).alias("in_range"))


def customer_order_profile(spark: SparkSession, sf: str) -> DataFrame:
    """Customers left-enriched with per-customer facts (first/last order, open orders)."""
    o = _orders(spark, sf)
    c = read_table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    first = o.groupBy("o_custkey").agg(F.min("order_date").alias("first_order"))
    last = o.groupBy("o_custkey").agg(F.max("order_date").alias("last_order"))
    open_n = o.filter(F.col("o_orderstatus") == "O").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("open_orders"))
    return left_enrich(c, [first, last, open_n], ["o_custkey"])


def segment_facts_per_customer(spark: SparkSession, sf: str) -> DataFrame:
    """Customers joined to one-row-per-segment facts with the segment split 8 ways."""
    c = read_table(spark, sf, "customer")
    seg = c.groupBy("c_mktsegment").agg(F.max("c_acctbal").alias("segment_max_balance"),
                                        F.count(F.lit(1)).alias("segment_customers"))
    return join_group_facts(c.select("c_custkey", "c_mktsegment", "c_acctbal"), seg, ["c_mktsegment"],
                            ["c_custkey"], ways=8)


def banded_shipping_days(spark: SparkSession, sf: str) -> DataFrame:
    """0 for line items shipped within 89 days of the order, 1 from 90 days on."""
    li = _lines(spark, sf)
    return li.select("l_orderkey", "l_linenumber", banded_days("order_date", "ship_date", 90).alias("late"))


def expected_or_default_return(spark: SparkSession, sf: str) -> DataFrame:
    """The ship date of returned items, order date + 30 for the others."""
    li = _lines(spark, sf).withColumn("returned_on", F.when(F.col("l_returnflag") == "R", F.col("ship_date")))
    return li.select("l_orderkey", "l_linenumber", plus_days_if_null("returned_on", "order_date").alias("expected_return"))


EXAMPLES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in [
        latest_order_per_customer, first_order_per_customer, top10_lineitems_per_order_customer,
        latest_order_as_at_rank_then_cut, latest_order_as_at_cut_then_rank, later_of_full_merge_orders_shipments,
        month_boundary_diff_orders, milestone_value_at_months, follow_up_in_window_orders, rule_ladder_customers,
        contains_flags_part_names, pair_split_numeric_check, lenient_number_classify, hashed_customer_key,
        max_date_per_site_salted_join, encounter_dedup_multi_key, lineitems_of_latest_order,
        banded_shipping_days, expected_or_default_return, repaired_ship_dates, part_size_in_family_range, customer_order_profile, segment_facts_per_customer,
    ]
}
