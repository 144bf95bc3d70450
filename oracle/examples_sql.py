"""DuckDB SQL for the building-block examples on the raw test tables.
Reporting date 1998-08-15 (end of previous month 1998-07-31)."""

from __future__ import annotations

from oracle.fixed import NUMBER

ORD = ("(SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS order_date "
       "FROM orders)")
LINES = ("(SELECT l.l_orderkey, l.l_linenumber, l.l_quantity, l.l_returnflag, CAST(l.l_shipdate AS DATE) AS ship_date, "
         "o.o_custkey, CAST(o.o_orderdate AS DATE) AS order_date "
         "FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey)")


def isnum(x: str) -> str:
    return f"coalesce(regexp_matches({x}, '{NUMBER}'), false)"


SQL: dict[str, str] = {}

SQL["latest_order_per_customer"] = f"""
SELECT o_custkey, o_orderkey, order_date, o_totalprice, rn FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY order_date DESC NULLS LAST, o_orderkey DESC NULLS LAST) AS rn
  FROM {ORD}) WHERE rn = 1"""

SQL["first_order_per_customer"] = f"""
SELECT o_custkey, o_orderkey, order_date, o_totalprice, rn FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY order_date ASC NULLS FIRST, o_orderkey ASC NULLS FIRST) AS rn
  FROM {ORD}) WHERE rn = 1"""

SQL["top10_lineitems_per_order_customer"] = f"""
SELECT o_custkey, rank, l_orderkey, l_linenumber, ship_date, l_quantity FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY ship_date DESC NULLS LAST, l_orderkey DESC NULLS LAST,
                               l_linenumber DESC NULLS LAST, l_quantity DESC NULLS LAST) AS rank
  FROM {LINES}) WHERE rank <= 10"""

SQL["latest_order_as_at_rank_then_cut"] = f"""
SELECT o_custkey, o_orderkey, order_date, rn FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY order_date DESC NULLS LAST, o_orderkey DESC NULLS LAST) AS rn
  FROM {ORD}) WHERE rn = 1 AND order_date <= DATE '1998-07-31'"""

SQL["latest_order_as_at_cut_then_rank"] = f"""
SELECT o_custkey, o_orderkey, order_date, rn FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY order_date DESC NULLS LAST, o_orderkey DESC NULLS LAST) AS rn
  FROM {ORD} WHERE order_date <= DATE '1998-07-31') WHERE rn = 1"""

SQL["later_of_full_merge_orders_shipments"] = f"""
WITH oo AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY order_date DESC NULLS LAST,
                                                o_orderkey DESC NULLS LAST) AS rn
                 FROM {ORD} WHERE o_orderstatus = 'O') WHERE rn = 1),
rr AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY ship_date DESC NULLS LAST,
                                                l_orderkey DESC NULLS LAST, l_linenumber DESC NULLS LAST,
                                                l_quantity DESC NULLS LAST) AS rn
                 FROM {LINES} WHERE l_returnflag = 'R') WHERE rn = 1)
SELECT coalesce(oo.o_custkey, rr.o_custkey) AS o_custkey, oo.order_date AS last_open_order, rr.ship_date AS last_return,
       CASE WHEN rr.o_custkey IS NOT NULL THEN 1 ELSE 0 END AS has_return,
       greatest(oo.order_date, rr.ship_date) AS later_date,
       CASE WHEN rr.ship_date > oo.order_date THEN rr.ship_date END AS return_if_later
FROM oo FULL JOIN rr ON oo.o_custkey = rr.o_custkey"""

SQL["month_boundary_diff_orders"] = f"""
SELECT CAST((year(ship_date) - year(order_date)) * 12 + month(ship_date) - month(order_date) AS INTEGER) AS months,
       CAST(year(ship_date) - year(order_date) AS INTEGER) AS years,
       count(*) AS n_lines,
       CAST(min(date_diff('day', order_date, ship_date)) AS INTEGER) AS min_days,
       CAST(max(date_diff('day', order_date, ship_date)) AS INTEGER) AS max_days
FROM {LINES} GROUP BY 1, 2"""


def _ms(n: int) -> str:
    return f"""
m{n} AS (
  SELECT * FROM (
    SELECT l.o_custkey, l.l_quantity AS qty_{n}m, l.ship_date AS date_{n}m,
           row_number() OVER (PARTITION BY l.o_custkey ORDER BY l.ship_date ASC NULLS FIRST, l.l_orderkey ASC NULLS FIRST,
                              l.l_linenumber ASC NULLS FIRST, l.l_quantity ASC NULLS FIRST) AS rk
    FROM {LINES} l JOIN f ON f.o_custkey = l.o_custkey
    WHERE (year(l.ship_date) - year(f.first_order)) * 12 + month(l.ship_date) - month(f.first_order) = {n})
  WHERE rk = 1)"""


SQL["milestone_value_at_months"] = f"""
WITH f AS (SELECT o_custkey, min(order_date) AS first_order FROM {ORD} GROUP BY o_custkey),
{",".join(_ms(n) for n in (1, 2, 3, 6))},
k AS (SELECT o_custkey FROM m1 UNION SELECT o_custkey FROM m2 UNION SELECT o_custkey FROM m3
      UNION SELECT o_custkey FROM m6)
SELECT k.o_custkey, m1.qty_1m, m1.date_1m, m2.qty_2m, m2.date_2m, m3.qty_3m, m3.date_3m, m6.qty_6m, m6.date_6m
FROM k LEFT JOIN m1 ON m1.o_custkey = k.o_custkey LEFT JOIN m2 ON m2.o_custkey = k.o_custkey
LEFT JOIN m3 ON m3.o_custkey = k.o_custkey LEFT JOIN m6 ON m6.o_custkey = k.o_custkey"""

SQL["follow_up_in_window_orders"] = f"""
WITH f AS (SELECT o_custkey, min(order_date) AS first_order FROM {ORD} GROUP BY o_custkey)
SELECT o.o_custkey, f.first_order, o.o_orderkey, o.order_date,
       CAST(date_diff('day', f.first_order, o.order_date) AS INTEGER) AS days_after
FROM {ORD} o JOIN f ON f.o_custkey = o.o_custkey
WHERE date_diff('day', f.first_order, o.order_date) BETWEEN 30 AND 37"""

SQL["rule_ladder_customers"] = """
SELECT c_custkey,
  CASE WHEN c_acctbal < 0 THEN 'NEG'
       WHEN c_mktsegment = 'BUILDING' AND c_acctbal > 5000 THEN 'BIG_BUILD'
       WHEN c_acctbal BETWEEN 0 AND 1000 THEN 'LOW'
       WHEN c_nationkey IN (1, 2, 3) THEN 'N123'
       ELSE substring(c_mktsegment, 1, 1) END AS code
FROM customer"""

SQL["contains_flags_part_names"] = """
SELECT p_partkey, p_name,
  CASE WHEN strpos(upper(p_name), 'RING') > 0 THEN 1 ELSE 0 END AS has_ring,
  CASE WHEN strpos(upper(p_name), 'HOT') > 0 THEN 1 ELSE 0 END AS has_hot,
  CASE WHEN strpos(upper(p_name), 'PLATE') > 0 THEN 1 ELSE 0 END AS has_plate,
  CASE WHEN strpos(upper(p_name), 'WID') > 0 THEN 1 ELSE 0 END AS has_wid
FROM part"""

_l = "trim(split_part(reading, '/', 1))"
_r = "trim(substr(reading, strpos(reading, '/') + 1))"
SQL["pair_split_numeric_check"] = f"""
WITH r AS (
  SELECT o_orderkey,
    CASE WHEN o_orderkey % 11 = 0 THEN CAST(o_orderkey % 180 AS VARCHAR) || '/x'
         WHEN o_orderkey % 13 = 0 THEN CAST(o_orderkey % 180 AS VARCHAR) || '-' || CAST(o_custkey % 120 AS VARCHAR)
         WHEN o_orderkey % 17 = 0 THEN '/' || CAST(o_orderkey % 120 AS VARCHAR)
         ELSE CAST(o_orderkey % 180 AS VARCHAR) || '/' || CAST(o_custkey % 120 AS VARCHAR) END AS reading
  FROM orders)
SELECT o_orderkey, reading,
  CASE WHEN strpos(reading, '/') > 0 AND {isnum(_l)} AND {isnum(_r)}
            AND TRY_CAST({_l} AS DOUBLE) < 140.0 AND TRY_CAST({_r} AS DOUBLE) < 90.0 THEN 1 ELSE 0 END AS below
FROM r"""

SQL["lenient_number_classify"] = f"""
WITH r AS (
  SELECT l_orderkey, l_linenumber,
    CASE WHEN l_linenumber = 1 THEN 'LDL' WHEN l_linenumber = 2 THEN 'undetectable'
         WHEN l_linenumber = 6 THEN CAST(CAST(floor(l_quantity) AS INTEGER) AS VARCHAR) || ',000'
         WHEN l_linenumber = 7 THEN 'n/a'
         ELSE CAST(CAST(floor(l_extendedprice) AS BIGINT) AS VARCHAR) END AS result
  FROM lineitem)
SELECT l_orderkey, l_linenumber, result,
  CASE WHEN {isnum('result')} THEN TRY_CAST(replace(result, ',', '') AS DOUBLE) END AS value,
  CASE WHEN {isnum('result')} THEN (CASE WHEN TRY_CAST(replace(result, ',', '') AS DOUBLE) < 200 THEN 1 ELSE 0 END)
       WHEN upper(rtrim(result)) IN ('UNDETECTABLE', 'LDL') THEN 1 ELSE 0 END AS suppressed
FROM r"""

SQL["hashed_customer_key"] = """
SELECT c_custkey, upper(sha256(substring(c_name, 1, 30))) AS name_hash,
       upper(sha256(substring(CAST(c_custkey AS VARCHAR), 1, 64))) AS key_hash
FROM customer"""

SQL["max_date_per_site_salted_join"] = f"""
WITH n AS (
  SELECT c.c_nationkey, max(o.order_date) AS nation_last_order
  FROM {ORD} o JOIN customer c ON c.c_custkey = o.o_custkey GROUP BY c.c_nationkey)
SELECT c.c_custkey, c.c_nationkey, n.nation_last_order FROM customer c LEFT JOIN n ON n.c_nationkey = c.c_nationkey"""

SQL["encounter_dedup_multi_key"] = """
SELECT l_orderkey, ship_date, l_returnflag, l_linenumber, l_quantity, num FROM (
  SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag, CAST(l_shipdate AS DATE) AS ship_date,
         row_number() OVER (PARTITION BY l_orderkey, CAST(l_shipdate AS DATE), l_returnflag
                            ORDER BY l_linenumber DESC NULLS LAST, l_quantity DESC NULLS LAST) AS num
  FROM lineitem) WHERE num = 1"""

SQL["lineitems_of_latest_order"] = f"""
WITH latest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY order_date DESC NULLS LAST,
                                                o_orderkey DESC NULLS LAST) AS rn FROM {ORD}) WHERE rn = 1)
SELECT l.o_custkey, l.l_orderkey AS o_orderkey, l.l_linenumber, l.l_quantity, l.ship_date
FROM {LINES} l JOIN latest a ON a.o_custkey = l.o_custkey AND a.order_date = l.order_date
                            AND a.o_orderkey = l.l_orderkey"""

SQL["repaired_ship_dates"] = f"""
SELECT l_orderkey, l_linenumber, order_date, ship_date,
       CASE WHEN ship_date IS NULL OR ship_date = DATE '1996-01-02' OR date_diff('day', order_date, ship_date) >= 60
            THEN order_date + 30 ELSE ship_date END AS repaired
FROM {LINES}"""

SQL["part_size_in_family_range"] = """
SELECT p_partkey, p_type, p_size,
       CASE WHEN (upper(rtrim(p_type)) IN ('SMALL', 'MEDIUM') AND p_size > 0 AND p_size <= 20)
              OR (upper(rtrim(p_type)) IN ('LARGE', 'PROMO') AND p_size > 10 AND p_size < 40) THEN 1 ELSE 0 END
         AS in_range
FROM part"""

SQL["customer_order_profile"] = f"""
SELECT c.c_custkey AS o_custkey, c.c_mktsegment, f.first_order, l.last_order, n.open_orders
FROM customer c
LEFT JOIN (SELECT o_custkey, min(order_date) AS first_order FROM {ORD} GROUP BY 1) f ON f.o_custkey = c.c_custkey
LEFT JOIN (SELECT o_custkey, max(order_date) AS last_order FROM {ORD} GROUP BY 1) l ON l.o_custkey = c.c_custkey
LEFT JOIN (SELECT o_custkey, count(*) AS open_orders FROM {ORD} WHERE o_orderstatus = 'O' GROUP BY 1) n
  ON n.o_custkey = c.c_custkey"""

SQL["segment_facts_per_customer"] = """
SELECT c.c_custkey, c.c_mktsegment, c.c_acctbal, s.segment_max_balance, s.segment_customers
FROM customer c
LEFT JOIN (SELECT c_mktsegment, max(c_acctbal) AS segment_max_balance, count(*) AS segment_customers
           FROM customer GROUP BY 1) s ON s.c_mktsegment = c.c_mktsegment"""

SQL["banded_shipping_days"] = f"""
SELECT l_orderkey, l_linenumber,
       CASE WHEN abs(date_diff('day', order_date, ship_date)) < 90 THEN 0
            WHEN abs(date_diff('day', order_date, ship_date)) >= 90 THEN 1 END AS late
FROM {LINES}"""

SQL["expected_or_default_return"] = f"""
SELECT l_orderkey, l_linenumber,
       coalesce(CASE WHEN l_returnflag = 'R' THEN ship_date END, order_date + 30) AS expected_return
FROM {LINES}"""
