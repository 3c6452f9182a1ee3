"""Differential test on random data: the Spark fixed table against the
literal DuckDB oracle, with the oracle's two source views replaced by the
same random rows."""

import datetime as dt
import random

import duckdb
import pytest

from churnwise.oracle.fixed_sql import fixed_ctes
from churnwise.params import RunParams
from churnwise.plans import fixed
from scripts.oracle_check import digest
from tests.helpers import D, ORDERS_SCHEMA, SNAPSHOT_SCHEMA, ListSources, days

P = RunParams(D(1998, 5, 1), install_org="OPCO")


def _random_rows(seed=21, accounts=250):
    rnd = random.Random(seed)
    snap, orders = [], []
    for a in range(accounts):
        start = rnd.choice([None, D(1998, 5, 3), D(1997, 12, 1), D(1996, 1, 1), D(1998, 4, 2)])
        ovd0, step = rnd.choice([None, 5, 40, 70, 84, 85, 86]), rnd.choice([0, 0, 1, 2])
        first = rnd.choice([D(1998, 3, 31), D(1998, 4, 10), D(1998, 5, 1), D(1998, 5, 5)])
        last = rnd.choice([D(1998, 6, 1), D(1998, 6, 1), D(1998, 5, 31), D(1998, 5, 20), D(1998, 4, 30)])
        bb, tv, vo = (rnd.choice([1, 1, 0, None]), rnd.choice([0, 1]), rnd.choice([0, 1]))
        phone1 = rnd.choice([None, 0, 7870000000 + a])
        phone2 = rnd.choice([None, 100, 101, 7870000000 + a])
        for d in days(first, last):
            if rnd.random() < 0.1:
                continue
            o = None if ovd0 is None else ovd0 + step * max(0, (d - D(1998, 4, 28)).days)
            tv_d = tv if d < D(1998, 5, 15) else rnd.choice([tv, tv, 1 - tv])
            ts = dt.datetime(start.year, start.month, start.day) if start else None
            snap.append((d, d, a, phone1, phone2, o, ts, 0.0, 30.0 + (a % 3) * 5 + (d >= D(1998, 5, 15)) * rnd.choice([0, 5]),
                         0.0, rnd.choice(["FIBER", "COAX", "FIBCO "]), bb, tv_d, vo, rnd.choice(["X", "N"]),
                         rnd.choice(["X", "N"]), f"B{a % 6}", "0P" if rnd.random() < 0.03 else "1P",
                         "RES" if rnd.random() < 0.97 else "COM", rnd.choice(["X", "N"]), d.replace(day=1)))
        for _ in range(rnd.choice([0, 0, 1, 2])):
            c = D(1998, rnd.choice([4, 5]), rnd.randrange(1, 29))
            orders.append((a, c, c, c - dt.timedelta(days=2), None,
                           rnd.choice(["MIG COAX TO FIB", "NON-PAY", "CUSTOMER REQUEST", None]),
                           rnd.choice(["V_DISCO", "V_DISCO", "RELOCATION/TRAN "]), "RES",
                           rnd.choice(["COMPLETE", "COMPLETE", "OPEN"]), rnd.choice([0, 1]), rnd.choice([0, 1]),
                           rnd.choice([0, 1])))
    return snap, orders


def _duck_type(t):
    return {"date": "DATE", "long": "BIGINT", "int": "INTEGER", "timestamp": "TIMESTAMP", "double": "DOUBLE",
            "string": "VARCHAR"}[t]


def _create(con, name, schema, rows):
    cols = [c.strip().split(" ") for c in schema.split(",")]
    con.execute(f"CREATE TABLE {name} (" + ", ".join(f"{n} {_duck_type(t)}" for n, t in cols) + ")")
    con.executemany(f"INSERT INTO {name} VALUES (" + ", ".join("?" for _ in cols) + ")", rows)


@pytest.mark.parametrize("seed", [21, 22, 23])
def test_fixed_table_matches_oracle_on_random_data(spark, seed):
    snap, orders = _random_rows(seed)
    df = fixed.fixed_table(ListSources(spark, snap, orders), P)
    rows = [tuple(r) for r in df.collect()]
    con = duckdb.connect()
    _create(con, "rand_snap", SNAPSHOT_SCHEMA, snap)
    _create(con, "rand_orders", ORDERS_SCHEMA, orders)
    sql = ("WITH fx_snapshot AS (SELECT * FROM rand_snap), fx_orders AS (SELECT * FROM rand_orders),\n"
           + fixed_ctes(P).strip() + "\nSELECT * FROM fixed_table")
    res = con.execute(sql)
    cols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert len(rows) == len(drows) > 100
    assert digest(df.columns, rows)[0] == digest(cols, drows)[0]
