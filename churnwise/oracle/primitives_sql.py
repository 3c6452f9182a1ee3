"""Oracle SQL for the operator queries over the provided tables."""

ORDERS_LAST_IN_MONTH = """
SELECT DISTINCT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
       max(CAST(o_orderdate AS DATE)) OVER w AS last_date,
       first_value(o_totalprice) OVER w2 AS last_totalprice, first_value(o_orderstatus) OVER w2 AS last_status
FROM orders
WINDOW w AS (PARTITION BY o_custkey, date_trunc('month', o_orderdate)),
       w2 AS (PARTITION BY o_custkey, date_trunc('month', o_orderdate) ORDER BY o_orderdate DESC, o_orderkey DESC)"""

ORDERS_TOP2 = """
SELECT o_custkey, o_orderkey, o_totalprice,
       CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS INTEGER) AS rank
FROM orders
QUALIFY rank <= 2"""

CUSTOMER_FIRST_ORDERS = """
SELECT o_custkey,
       min(CAST(o_orderdate AS DATE)) AS first_date,
       first(o_totalprice ORDER BY o_orderdate, o_orderkey) AS first_totalprice,
       min(CAST(o_orderdate AS DATE)) FILTER (WHERE o_totalprice >= 100000.0) AS first_big_date,
       first(o_totalprice ORDER BY o_orderdate, o_orderkey) FILTER (WHERE o_totalprice >= 100000.0)
           AS first_big_totalprice
FROM orders GROUP BY o_custkey"""

CUSTOMER_OPEN_CLOSE = """
WITH b AS (SELECT o_custkey, count(*) AS orders, round(sum(o_totalprice), 2) AS total FROM orders
           WHERE o_orderdate >= DATE '1998-04-01' AND o_orderdate < DATE '1998-05-01' GROUP BY o_custkey),
     e AS (SELECT o_custkey, count(*) AS orders, round(sum(o_totalprice), 2) AS total FROM orders
           WHERE o_orderdate >= DATE '1998-05-01' AND o_orderdate < DATE '1998-06-01' GROUP BY o_custkey)
SELECT coalesce(b.o_custkey, e.o_custkey) AS o_custkey,
       CASE WHEN b.o_custkey IS NULL THEN 0 ELSE 1 END AS b_active,
       CASE WHEN e.o_custkey IS NULL THEN 0 ELSE 1 END AS e_active,
       b.orders AS b_orders, b.total AS b_total, e.orders AS e_orders, e.total AS e_total,
       CASE WHEN e.orders - b.orders = 0 THEN 'same' WHEN e.orders - b.orders > 0 THEN 'more'
            WHEN e.orders - b.orders < 0 THEN 'fewer' WHEN b.orders IS NULL THEN 'new' ELSE 'lost' END AS movement
FROM b FULL OUTER JOIN e ON b.o_custkey = e.o_custkey"""

LINEITEM_SHIP_WINDOW = """
SELECT o_orderpriority, count(*) AS lines, round(sum(l_extendedprice), 2) AS revenue,
       round(sum(CASE WHEN date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) <= 7
                       AND l_returnflag = 'R' THEN l_extendedprice END), 2) AS fast_returned_revenue
FROM orders JOIN lineitem ON o_orderkey = l_orderkey
 AND CAST(l_shipdate AS DATE) BETWEEN CAST(o_orderdate AS DATE) AND CAST(o_orderdate AS DATE) + 30
GROUP BY o_orderpriority"""

ORDERS_DISTINCT_ROLLUP = """
SELECT o_orderstatus, o_orderpriority, count(DISTINCT o_custkey) AS customers,
       count(DISTINCT CASE WHEN o_totalprice >= 100000.0 THEN o_custkey END) AS big_customers,
       count(DISTINCT CASE WHEN o_orderpriority = '1-URGENT' THEN o_custkey END) AS urgent_customers
FROM orders GROUP BY o_orderstatus, o_orderpriority"""

_KEYED = """
WITH o AS (SELECT o_orderkey, o_orderpriority, CASE WHEN o_orderstatus <> 'O' THEN o_custkey END AS key FROM orders),
rich AS (SELECT c_custkey AS k FROM customer WHERE c_acctbal > 5000),
unknown AS (SELECT CASE WHEN c_acctbal > 5000 THEN c_custkey END AS k FROM customer WHERE c_acctbal > 5000 OR c_acctbal < 0),
nobody AS (SELECT k FROM rich WHERE k < 0)"""

ORDERS_IN_SETS = _KEYED + """
SELECT o_orderpriority, in_rich, in_unknown, in_empty, count(*) AS orders
FROM (SELECT o_orderpriority, key IN (SELECT k FROM rich) AS in_rich, key IN (SELECT k FROM unknown) AS in_unknown,
             key IN (SELECT k FROM nobody) AS in_empty FROM o) GROUP BY ALL"""

ORDERS_NOT_IN_SET = _KEYED + """
SELECT 'rich' AS set_name, o_orderkey, key FROM o WHERE key NOT IN (SELECT k FROM rich)
UNION ALL SELECT 'unknown', o_orderkey, key FROM o WHERE key NOT IN (SELECT k FROM unknown)
UNION ALL SELECT 'empty', o_orderkey, key FROM o WHERE key NOT IN (SELECT k FROM nobody)"""

CUSTOMER_ORDER_STATE = """
SELECT o_custkey, min(CAST(o_orderdate AS DATE)) AS first_day, max(CAST(o_orderdate AS DATE)) AS last_day,
       first(o_totalprice ORDER BY CAST(o_orderdate AS DATE), o_totalprice) AS first_total,
       last(o_totalprice ORDER BY CAST(o_orderdate AS DATE), o_totalprice) AS last_total
FROM orders GROUP BY o_custkey"""

ORDERS_DISTINCT_TOTALS = """
SELECT o_orderstatus, o_orderpriority, year,
       concat_ws(',', CASE WHEN grouping(o_orderstatus) = 0 THEN 'o_orderstatus' END,
                 CASE WHEN grouping(o_orderpriority) = 0 THEN 'o_orderpriority' END,
                 CASE WHEN grouping(year) = 0 THEN 'year' END) AS dims_used,
       count(DISTINCT o_custkey) AS customers,
       count(DISTINCT CASE WHEN o_totalprice >= 100000.0 THEN o_custkey END) AS big_customers
FROM (SELECT *, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders)
GROUP BY GROUPING SETS ((o_orderstatus, o_orderpriority, year), (o_orderstatus, year), (o_orderpriority), (year), ())"""

ORDERS_SOON_AFTER = """
WITH o AS (SELECT o_custkey, o_orderpriority, o_totalprice, CAST(o_orderdate AS DATE) AS day FROM orders)
SELECT a.o_orderpriority, count(*) AS pairs, round(sum(b.o_totalprice), 2) AS later_total,
       CAST(max(date_diff('day', a.day, b.day)) AS INTEGER) AS longest
FROM o a JOIN o b ON a.o_custkey = b.o_custkey AND b.day > a.day AND b.day <= a.day + 60
GROUP BY a.o_orderpriority"""
