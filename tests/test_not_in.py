"""IN / NOT IN in three-valued logic, against DuckDB and in the mobile plan."""

import itertools
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from churnwise.operators.existence import not_in, with_in

SETS = {"none": [], "some": [1, 2, 2, 9], "null": [None], "mixed": [2, None, None, 7]}
PROBES = [1, 2, 3, None, 9, 2, None, 7]


def _duck(keys, what):
    con = duckdb.connect()
    con.execute("CREATE TABLE p (id INT, key BIGINT)")
    con.executemany("INSERT INTO p VALUES (?, ?)", list(enumerate(PROBES)))
    con.execute("CREATE TABLE s (key BIGINT)")
    if keys:
        con.executemany("INSERT INTO s VALUES (?)", [(k,) for k in keys])
    return sorted(con.execute(what).fetchall())


@pytest.mark.parametrize("name", SETS)
def test_against_sql(spark, name):
    probes = spark.createDataFrame(list(enumerate(PROBES)), "id int, key long")
    keys = spark.createDataFrame([(k,) for k in SETS[name]], "key long")
    got = sorted(r["id"] for r in not_in(probes, keys, "key").collect())
    assert [(i,) for i in got] == _duck(SETS[name], "SELECT id FROM p WHERE key NOT IN (SELECT key FROM s)")
    flags = sorted((r["id"], r["inside"]) for r in with_in(probes, keys, "key", "inside").collect())
    assert flags == _duck(SETS[name], "SELECT id, key IN (SELECT key FROM s) FROM p")


def test_plan_has_a_hash_or_merge_anti_join(spark, tmp_path):
    spark.range(1000).select(F.col("id").alias("key")).write.parquet(f"{tmp_path}/a")
    a = spark.read.parquet(f"{tmp_path}/a")
    plan = not_in(a, a.where("key % 3 = 0"), "key")._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def test_reinstated_with_null_ids(spark):
    """02: the master keeps what is NOT IN the reinstated."""
    from churnwise.params import RunParams
    from churnwise.plans import mobile

    p = RunParams("1998-05-01")
    schema = "subsrptn_id long, dt date"
    rng = random.Random(2)
    rows = [(i, f"1998-0{m}-01") for i, m in itertools.product([1, 2, 3, None], [3, 4, 5]) if rng.random() < 0.9]
    master = spark.createDataFrame(rows, "subsrptn_id long, dt string").withColumn("dt", F.to_date("dt"))
    for c in mobile.MASTER_COLUMNS:
        if c not in master.columns:
            master = master.withColumn(c, F.lit(None).cast("date" if c == "subsrptn_actvtn_dt" else "string"))

    def kept(fake):
        adj = mobile.adjusted_master(master, spark.createDataFrame([(k,) for k in fake], "subsrptn_id long"), p)
        return sorted(((r["subsrptn_id"], str(r["dt"]), r["reinstated"]) for r in adj.collect()), key=str)

    plain = sorted(((i, d, False) for i, d in rows), key=str)
    last = max(d for i, d in rows if i == 2 and d < "1998-05-01")
    assert kept([]) == plain                                                             # all, NULL ids too
    assert kept([2]) == sorted([x for x in plain if x[0] not in (2, None)] + [(2, last, True)], key=str)
    assert kept([2, None]) == [(2, last, True)]                                          # NOT IN is true for none
