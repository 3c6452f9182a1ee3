"""Views on a spine of dates: a task makes the rows of one date, and repeated
or missing keys have their rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from churnwise.sources import fixtures

KEYS = [0, 10, 10, 20, 30, None]  # class 0: there on each day and in each month
DAYS = {dt.date(1998, 3, 31) + dt.timedelta(days=i) for i in range(63)}
MONTHS = {dt.date(1997, 11, 1), dt.date(1997, 12, 1), *(dt.date(1998, m, 1) for m in range(1, 6))}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("spine"))
    spark.createDataFrame([(k,) for k in KEYS], "c_custkey long").write.parquet(f"{d}/customer.parquet")
    return d


@pytest.mark.parametrize("build", [fixtures.daily_snapshot, fixtures.postpaid_master])
def test_a_task_holds_one_date(spark, folder, build):
    tasks = build(spark, folder).groupBy(F.spark_partition_id().alias("task")).agg(F.countDistinct("dt").alias("n"))
    assert {r["n"] for r in tasks.collect()} == {1}


@pytest.mark.parametrize("build", [fixtures.daily_snapshot, fixtures.postpaid_master])
def test_wide_rows_are_not_sorted_or_shuffled_to_be_written(spark, folder, build):
    df = build(spark, folder)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.index("Exchange") > plan.index("CartesianProduct")
    assert "dt" in _ordered_by(df)


def _ordered_by(df):
    """Names of the columns whose order the plan tells first."""
    same = df._jdf.queryExecution().optimizedPlan().outputOrdering().apply(0).children()
    return [same.apply(i).name() for i in range(same.length())]


def test_rows_of_each_key(spark, folder):
    snap = fixtures.FixtureSources(spark, folder).daily_snapshot()
    got = [(r["k"], r["dt"]) for r in snap.select(F.col("sub_acct_no_sbb").alias("k"), "dt").collect()]
    assert sorted(got, key=str) == sorted([(k, d) for k in KEYS for d in DAYS], key=str)
    months = fixtures.FixtureSources(spark, folder).postpaid_master().where(F.col("subsrptn_id") == fixtures.PHONE_BASE)
    assert sorted(r["dt"] for r in months.collect()) == sorted(MONTHS)
