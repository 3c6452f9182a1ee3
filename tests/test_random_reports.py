"""Differential test on random data: the Spark report plans (sales drivers,
never-paid, early tickets, slow installs, involuntary funnel) against the
literal oracle, over a random chain of sources."""

import datetime as dt
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from churnwise.oracle import reports_sql
from churnwise.oracle.converged_sql import converged_ctes
from churnwise.oracle.fixed_sql import fixed_ctes
from churnwise.oracle.mobile_sql import mobile_ctes
from churnwise.plans import contracts, converged, fixed, involuntary, mobile, sales
from scripts.oracle_check import digest
from tests.helpers import ORDERS_SCHEMA, SNAPSHOT_SCHEMA, ListSources
from tests.test_random_fixed import P, _create, _random_rows
from tests.test_random_mobile import CANCELS, MASTER, MRC, _random
from tests.test_random_mobile import _create as _create_m

PREPAID = "subsrptn_id long, dt date, cust_sts string, acct_type_cd string, ba_rgn_nm string, subsrptn_sts string"
INTER = ("interaction_id string, account_id long, customer_id long, account_type string, "
         "interaction_start_time timestamp, interaction_channel string, interaction_agent_id string, "
         "interaction_purpose_descrip string")
TRUCK = "create_dte_ojb timestamp, job_no_ojb string, sub_acct_no_sbb long"
PAY = "account_id long, dt date, payment_amt_usd double"
LINES = ("account_id long, org_id string, org_cntry string, order_status string, command_id string, "
         "order_start_date timestamp, completed_date timestamp")
PURPOSES = ["HSD Problem", "Cust Service Calls", "Upgrade tech", "Tech Support", None, "Work Order Status",
            "no service at home", "Billing question"]


def _events(seed, accounts=300):
    rnd = random.Random(seed)
    inter, truck, pay, lines = [], [], [], []
    n = 0
    for a in range(accounts):
        for _ in range(rnd.choice([0, 0, 1, 2, 4])):
            day = dt.date(1998, 5, 1) + dt.timedelta(days=rnd.randrange(0, 95))
            ts = dt.datetime(day.year, day.month, day.day, rnd.randrange(24))
            n += 1
            inter.append((str(1000 + n), a, a, "RES" if rnd.random() < 0.95 else "BUS", ts,
                          rnd.choice(["PHONE", "CHAT"]), rnd.choice(["AG0", "AG1"]), rnd.choice(PURPOSES)))
            if rnd.random() < 0.25:
                truck.append((ts, f"J{n}", a))
        for _ in range(rnd.choice([0, 1, 2, 5])):
            day = dt.date(1998, 3, 15) + dt.timedelta(days=rnd.randrange(0, 150))
            pay.append((a, day, float(rnd.choice([10, 25, 30, 35, 40, 60]))))
            if rnd.random() < 0.2:
                pay.append((a, day, float(rnd.choice([5, 45]))))   # same-day tie
        for _ in range(rnd.choice([0, 1, 2])):
            s = dt.datetime(1998, rnd.choice([4, 5]), rnd.randrange(1, 28))
            lines.append((a, rnd.choice(["OPCO", "OPCO", "OTHER"]), "PR", "COMPLETE",
                          rnd.choice(["CONNECT", "CHANGE"]), s, s + dt.timedelta(days=rnd.randrange(0, 11))))
    return inter, truck, pay, lines


@pytest.fixture(scope="module")
def chain(spark):
    seed = 41
    snap, orders = _random_rows(seed, accounts=300)
    master, cancels, mrc = _random(seed)
    prepaid = [(7870000000 + k, m, "O", "I", "PR", "A") for k in range(0, 300, 7) for m in (P.prev_month, P.month)]
    codes = [("B0",), ("B4",)]
    inter, truck, pay, lines = _events(seed)

    class Src(ListSources):
        def __init__(self):
            super().__init__(spark, snap, orders)
            self._m = spark.createDataFrame(master, MASTER)
            self._c = spark.createDataFrame(cancels, CANCELS)
            self._r = spark.createDataFrame(mrc, MRC).withColumnRenamed("mrc", "mrc/account")
            self._i = spark.createDataFrame(inter, INTER)
            self._t = spark.createDataFrame(truck, TRUCK)
            self._p = spark.createDataFrame(pay, PAY)
            self._l = spark.createDataFrame(lines, LINES)

        def postpaid_master(self): return self._m
        def postpaid_cancellations(self): return self._c
        def postpaid_mrc(self): return self._r
        def interactions(self): return self._i
        def truckrolls(self): return self._t
        def payments(self): return self._p
        def order_lines(self): return self._l

    src = Src()
    t1 = fixed.fixed_table(src, P)
    t2 = contracts.mobile_for_converged(mobile.mobile_table(src, P))
    t3 = contracts.converged_for_reports(converged.converged_table(
        t1, t2, spark.createDataFrame(prepaid, PREPAID), spark.createDataFrame(codes, "bill_code string"), P))

    con = duckdb.connect()
    for name, schema, rows, fn in (("rand_snap", SNAPSHOT_SCHEMA, snap, _create),
                                   ("rand_orders", ORDERS_SCHEMA, orders, _create),
                                   ("r_master", MASTER, master, _create_m), ("r_cancels", CANCELS, cancels, _create_m),
                                   ("r_mrc", MRC, mrc, _create_m), ("r_prepaid", PREPAID, prepaid, _create_m),
                                   ("r_codes", "bill_code string", codes, _create_m)):
        fn(con, name, schema, rows)
    types = {"date": "DATE", "long": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
             "timestamp": "TIMESTAMP"}
    for name, schema, rows in (("r_inter", INTER, inter), ("r_truck", TRUCK, truck), ("r_pay", PAY, pay),
                               ("r_lines", LINES, lines)):
        cols = [c.strip().split(" ") for c in schema.split(",")]
        con.execute(f"CREATE TABLE {name} (" + ", ".join(f"{n} {types[t]}" for n, t in cols) + ")")
        con.executemany(f"INSERT INTO {name} VALUES (" + ", ".join("?" for _ in cols) + ")", rows)
    prefix = ("WITH fx_snapshot AS (SELECT * FROM rand_snap), fx_orders AS (SELECT * FROM rand_orders),\n"
              "fx_master AS (SELECT * FROM r_master), fx_cancels AS (SELECT * FROM r_cancels),\n"
              "fx_mrc AS (SELECT dt, acct_nbr, mrc AS \"mrc/account\" FROM r_mrc),\n"
              "fx_prepaid AS (SELECT * FROM r_prepaid), fx_billcodes AS (SELECT * FROM r_codes),\n"
              "fx_interactions AS (SELECT * FROM r_inter), fx_truckrolls AS (SELECT * FROM r_truck),\n"
              "fx_payments AS (SELECT * FROM r_pay), fx_orderlines AS (SELECT * FROM r_lines),\n"
              + ",\n".join(c.strip() for c in (fixed_ctes(P), mobile_ctes(P), converged_ctes(P))))
    return src, t3, con, prefix


def _same(df, con, sql):
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(sql)
    cols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert len(rows) == len(drows) > 0
    assert digest(df.columns, rows)[0] == digest(cols, drows)[0]


def test_sales_reports_on_random_data(spark, chain):
    src, t3, con, prefix = chain
    sales_sql = prefix + ",\n" + reports_sql.sales_ctes(P).strip()
    snap = src.daily_snapshot()
    nc_rows, new = sales.new_customer_rows(snap, P)
    fc = sales.first_cycle(nc_rows)
    npn = sales.never_paid(fc, sales.first_cycle_payments(fc, src.payments(), P), P)
    from churnwise.catalog import NEVER_PAID_COLUMNS
    _same(npn.select(*NEVER_PAID_COLUMNS), con, sales_sql + reports_sql.NEVER_PAID)
    typed = sales.interactions_in_window(src.interactions(), src.truckrolls(), P)
    _same(sales.early_tickets(new, typed, P), con, sales_sql + reports_sql.EARLY_TICKETS)
    _same(sales.slow_installs(new, src.order_lines(), P), con, sales_sql + reports_sql.SLOW_INSTALLS)
    _same(sales.sales_drivers(t3, snap, src.interactions(), src.truckrolls(), src.payments(), P), con,
          sales_sql + "\nSELECT * FROM sales_drivers")


def test_involuntary_funnel_on_random_data(spark, chain):
    src, t3, con, prefix = chain
    sql = prefix + ",\n" + reports_sql.involuntary_ctes(P).strip() + "\nSELECT * FROM involuntary_equation"
    _same(involuntary.involuntary_equation(t3, src.daily_snapshot(), P), con, sql)
