"""Differential test on random data: the Spark mobile table against the
literal DuckDB oracle, with the oracle's source views replaced by the same
random rows."""

import datetime as dt
import random

import duckdb
import pytest

from churnwise.oracle.mobile_sql import mobile_ctes
from churnwise.params import RunParams, add_months
from churnwise.plans import mobile
from scripts.oracle_check import digest
from tests.helpers import D

P = RunParams(D(1998, 5, 1))
MASTER = ("dt date, subsrptn_id long, cust_id long, subsrptn_actvtn_dt date, cust_sts string, acct_type_cd string, "
          "rgn_nm string, subsrptn_sts string, flg_susp_curr_mo int, lst_susp_dt string")
CANCELS = ("dt date, subsrptn_id long, subsrptn_sts_dt string, acct_sts_rsn_desc string, lst_susp_rsn_desc string, "
           "acct_type_cd string, rgn_nm string, cust_sts string, subsrptn_sts string")
MRC = "dt date, acct_nbr long, mrc double"
REASONS = [None, "Non Payment", "Customer moved", "Contract - Accepted", "PortIn", "Fraud case", 'x""y',
           "Lost Equipment", "per cust request", "No Use"]


def _random(seed):
    rnd = random.Random(seed)
    months = [add_months(P.month, -i) for i in range(6, -1, -1)]
    master, cancels, mrc = [], [], []
    for s in range(300):
        sid = 7870000000 + s
        act = D(1997, 1, 1) + dt.timedelta(days=rnd.randrange(0, 480))
        for i, m in enumerate(months):
            if rnd.random() < 0.2:
                continue
            master.append((m, sid, s // 3, act + dt.timedelta(days=10 * i * (s % 2)),
                           "O" if rnd.random() < 0.95 else "C", "I" if rnd.random() < 0.95 else "B",
                           "VI" if rnd.random() < 0.05 else "PR", "A" if rnd.random() < 0.9 else "S",
                           rnd.choice([0, 0, 0, 1]),
                           rnd.choice([None, " ", "1997-10-01", "1998-04-15", "1998-04-03"])))
        for _ in range(rnd.choice([0, 0, 1, 1, 2])):
            m = rnd.choice(months)
            cancels.append((m, sid, f"{m.isoformat()[:8]}{rnd.randrange(1, 28):02d} 10:00:00", rnd.choice(REASONS),
                            rnd.choice([None, "none", "FRAUD", '""']), "I", "PR" if rnd.random() < 0.9 else "VI",
                            "O", rnd.choice(["A", "C"])))
    for parent in range(100):
        for m in months[-2:]:
            mrc.append((m, parent, float("nan") if parent % 17 == 3 else float(20 + rnd.randrange(30))))
    return master, cancels, mrc


class _Src:
    def __init__(self, spark, master, cancels, mrc):
        self._m = spark.createDataFrame(master, MASTER)
        self._c = spark.createDataFrame(cancels, CANCELS)
        self._r = spark.createDataFrame(mrc, MRC).withColumnRenamed("mrc", "mrc/account")

    def postpaid_master(self): return self._m
    def postpaid_cancellations(self): return self._c
    def postpaid_mrc(self): return self._r


def _create(con, name, schema, rows):
    types = {"date": "DATE", "long": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR"}
    cols = [c.strip().split(" ") for c in schema.split(",")]
    con.execute(f"CREATE TABLE {name} (" + ", ".join(f"{n} {types[t]}" for n, t in cols) + ")")
    con.executemany(f"INSERT INTO {name} VALUES (" + ", ".join("?" for _ in cols) + ")", rows)


@pytest.mark.parametrize("seed", [5, 6])
def test_mobile_table_matches_oracle_on_random_data(spark, seed):
    master, cancels, mrc = _random(seed)
    df = mobile.mobile_table(_Src(spark, master, cancels, mrc), P)
    rows = [tuple(r) for r in df.collect()]
    con = duckdb.connect()
    _create(con, "r_master", MASTER, master)
    _create(con, "r_cancels", CANCELS, cancels)
    _create(con, "r_mrc", MRC, mrc)
    sql = ("WITH fx_master AS (SELECT * FROM r_master), fx_cancels AS (SELECT * FROM r_cancels),\n"
           "fx_mrc AS (SELECT dt, acct_nbr, mrc AS \"mrc/account\" FROM r_mrc),\n"
           + mobile_ctes(P).strip() + "\nSELECT * FROM mobile_table")
    res = con.execute(sql)
    cols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert len(rows) == len(drows) > 100
    assert digest(df.columns, rows)[0] == digest(cols, drows)[0]
