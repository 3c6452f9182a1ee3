"""Differential test on random data: the Spark converged table (from random
fixed and mobile sources linked by phone) against the literal oracle chain."""

import duckdb
import pytest

from churnwise.oracle.converged_sql import converged_ctes
from churnwise.oracle.fixed_sql import fixed_ctes
from churnwise.oracle.mobile_sql import mobile_ctes
from churnwise.plans import contracts, converged, fixed, mobile
from scripts.oracle_check import digest
from tests.helpers import ORDERS_SCHEMA, SNAPSHOT_SCHEMA, ListSources
from tests.test_random_fixed import P, _create, _random_rows
from tests.test_random_mobile import CANCELS, MASTER, MRC, _random
from tests.test_random_mobile import _create as _create_m

PREPAID = "subsrptn_id long, dt date, cust_sts string, acct_type_cd string, ba_rgn_nm string, subsrptn_sts string"


@pytest.mark.parametrize("seed", [31, 32])
def test_converged_table_matches_oracle_on_random_data(spark, seed):
    snap, orders = _random_rows(seed, accounts=300)
    master, cancels, mrc = _random(seed)
    prepaid = [(7870000000 + k, m, "O", "I", "PR", "A") for k in range(0, 300, 7) for m in (P.prev_month, P.month)]
    codes = [("B0",), ("B4",)]

    class Src(ListSources):
        def __init__(self):
            super().__init__(spark, snap, orders)
            self._m = spark.createDataFrame(master, MASTER)
            self._c = spark.createDataFrame(cancels, CANCELS)
            self._r = spark.createDataFrame(mrc, MRC).withColumnRenamed("mrc", "mrc/account")

        def postpaid_master(self): return self._m
        def postpaid_cancellations(self): return self._c
        def postpaid_mrc(self): return self._r

    src = Src()
    t1 = fixed.fixed_table(src, P)
    t2 = contracts.mobile_for_converged(mobile.mobile_table(src, P))
    df = converged.converged_table(t1, t2, spark.createDataFrame(prepaid, PREPAID),
                                   spark.createDataFrame(codes, "bill_code string"), P)
    rows = [tuple(r) for r in df.collect()]

    con = duckdb.connect()
    _create(con, "rand_snap", SNAPSHOT_SCHEMA, snap)
    _create(con, "rand_orders", ORDERS_SCHEMA, orders)
    _create_m(con, "r_master", MASTER, master)
    _create_m(con, "r_cancels", CANCELS, cancels)
    _create_m(con, "r_mrc", MRC, mrc)
    _create_m(con, "r_prepaid", PREPAID, prepaid)
    _create_m(con, "r_codes", "bill_code string", codes)
    sql = ("WITH fx_snapshot AS (SELECT * FROM rand_snap), fx_orders AS (SELECT * FROM rand_orders),\n"
           "fx_master AS (SELECT * FROM r_master), fx_cancels AS (SELECT * FROM r_cancels),\n"
           "fx_mrc AS (SELECT dt, acct_nbr, mrc AS \"mrc/account\" FROM r_mrc),\n"
           "fx_prepaid AS (SELECT * FROM r_prepaid), fx_billcodes AS (SELECT * FROM r_codes),\n"
           + ",\n".join(c.strip() for c in (fixed_ctes(P), mobile_ctes(P), converged_ctes(P)))
           + "\nSELECT * FROM converged_table")
    res = con.execute(sql)
    cols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert len(rows) == len(drows) > 100
    assert digest(df.columns, rows)[0] == digest(cols, drows)[0]
