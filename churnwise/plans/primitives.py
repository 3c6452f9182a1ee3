"""The reusable operators applied to the provided TPC-H-style tables
(whole tables), one query each; checked against oracle SQL like the
monthly pipelines."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnwise.functions import columns as C
from churnwise.operators import bitmaps
from churnwise.operators.bands import band_join
from churnwise.operators.existence import not_in, with_in
from churnwise.operators.materialize import materialize
from churnwise.operators.rollup import distinct_flag_rollup
from churnwise.operators.state import KeptState
from churnwise.operators.temporal import first_by, last_in_month, open_close, top_k_per_group
from churnwise.sources.tables import table

MONTH = _dt.date(1998, 5, 1)
BIG_ORDER = 100000.0


def orders_last_in_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return last_in_month(o, "o_custkey", "o_orderdate",
                         {"last_totalprice": "o_totalprice", "last_status": "o_orderstatus"}, tie=["o_orderkey"])


def orders_top2_per_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return top_k_per_group(o, "o_custkey", [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()], 2)


def customer_first_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    picks = {"first": None, "first_big": F.col("o_totalprice") >= BIG_ORDER}
    out = first_by(o, "o_custkey", "o_orderdate", "o_totalprice", "o_orderkey", picks)
    return out.withColumnsRenamed({f"{name}_o_totalprice": f"{name}_totalprice" for name in picks})


def customer_orders_open_close(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    out = open_close(o, "o_custkey", "o_orderdate", MONTH,
                     {"orders": F.count(F.lit(1)), "total": F.round(F.sum("o_totalprice"), 2)})
    diff = F.col("e_orders") - F.col("b_orders")
    return out.withColumn("movement", F.when(diff == 0, "same").when(diff > 0, "more").when(diff < 0, "fewer")
                          .when(F.col("b_orders").isNull(), "new").otherwise("lost"))


def lineitem_ship_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equi-join plus a range residual (lines shipped within 30 days of the
    order), with conditional sums that stay NULL when no line qualifies."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority")
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate", "l_extendedprice", "l_returnflag")
    j = o.join(li, (o.o_orderkey == li.l_orderkey)
               & (F.to_date("l_shipdate").between(F.to_date("o_orderdate"), F.date_add(F.to_date("o_orderdate"), 30))))
    fast = F.datediff(F.to_date("l_shipdate"), F.to_date("o_orderdate")) <= 7
    return j.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("lines"),
        F.round(F.sum("l_extendedprice"), 2).alias("revenue"),
        F.round(F.sum(F.when(fast & (F.col("l_returnflag") == "R"), F.col("l_extendedprice"))), 2)
         .alias("fast_returned_revenue"))


def orders_distinct_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    flags = {"customers": F.col("o_custkey"),
             "big_customers": F.when(F.col("o_totalprice") >= BIG_ORDER, F.col("o_custkey")),
             "urgent_customers": F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_custkey"))}
    return distinct_flag_rollup(o, ["o_orderstatus", "o_orderpriority"], "o_custkey", flags)


def _key_sets(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Customers in credit: as they are, with NULL for those in debt, and none."""
    c = table(spark, sf_dir, "customer")
    rich = c.where(F.col("c_acctbal") > 5000).select(F.col("c_custkey").alias("key"))
    unknown = c.where((F.col("c_acctbal") > 5000) | (F.col("c_acctbal") < 0)).select(
        F.when(F.col("c_acctbal") > 5000, F.col("c_custkey")).alias("key"))
    return {"rich": rich, "unknown": unknown, "empty": rich.where(F.col("key") < 0)}


def _orders_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their customer, unknown (NULL) for open ones."""
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", "o_orderpriority", F.when(F.col("o_orderstatus") != "O", F.col("o_custkey")).alias("key"))


def orders_in_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IN as a three-valued flag, against a set, one that holds NULL, and none."""
    out = _orders_by_key(spark, sf_dir)
    sets = _key_sets(spark, sf_dir)
    for name, keys in sets.items():
        out = with_in(out, keys, "key", f"in_{name}")
    flags = [f"in_{name}" for name in sets]
    return out.groupBy("o_orderpriority", *flags).agg(F.count(F.lit(1)).alias("orders"))


def orders_not_in_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NOT IN as a filter, against the same sets: the orders that stay."""
    orders = _orders_by_key(spark, sf_dir)
    parts = [not_in(orders, keys, "key").select(F.lit(name).alias("set_name"), "o_orderkey", "key") for name, keys in _key_sets(spark, sf_dir).items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


ORDER_STATE = KeptState(keys=("o_custkey",), order="day", first={"first_total": "o_totalprice"}, last={"last_total": "o_totalprice"})


def customer_order_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First and last order of each customer, from states of two spans of days
    that overlap by a year."""
    o = table(spark, sf_dir, "orders").select("o_custkey", F.to_date("o_orderdate").alias("day"), "o_totalprice")
    early, late = F.col("day") < F.lit(_dt.date(1996, 1, 1)), F.col("day") >= F.lit(_dt.date(1995, 1, 1))
    return ORDER_STATE.merge(ORDER_STATE.collapse(o.where(early)), ORDER_STATE.collapse(o.where(late)))


ORDER_TOTALS = [["o_orderstatus", "o_orderpriority", "year"], ["o_orderstatus", "year"], ["o_orderpriority"], ["year"], []]


def orders_distinct_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct customers by status, priority and year, and four totals of them,
    all from one set of bitmaps."""
    o = table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate"))
    flags = {"customers": F.lit(True), "big_customers": F.col("o_totalprice") >= BIG_ORDER}
    dims = ORDER_TOTALS[0]
    kept = materialize(bitmaps.id_bitmaps(o, dims, "o_custkey", flags), "order_bitmaps")
    return bitmaps.totals(kept, dims, ORDER_TOTALS, list(flags))


def orders_soon_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and later ones of the same customer within 60 days, per priority
    of the first: a band join of the whole table with itself."""
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderpriority", F.to_date("o_orderdate").alias("day"), "o_totalprice")
    later = o.select("o_custkey", F.col("day").alias("later_day"), F.col("o_totalprice").alias("later_price"))
    near = band_join(later, o, "o_custkey", "later_day", F.date_add("day", 1), F.date_add("day", 60))
    return near.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("pairs"), F.round(F.sum("later_price"), 2).alias("later_total"),
        F.max(F.datediff("later_day", "day")).alias("longest"))
