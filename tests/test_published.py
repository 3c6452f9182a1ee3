"""Stage tables published in the catalog: whole months, or the old ones."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from churnwise.sinks import published

MAY, JUNE = dt.date(1998, 5, 1), dt.date(1998, 6, 1)


@pytest.fixture
def name(spark):
    table = f"stage_{uuid.uuid4().hex[:8]}"
    yield table
    spark.sql(f"DROP VIEW IF EXISTS {table}")


def rows(spark, month, values):
    return spark.createDataFrame([(month, v) for v in values], "month date, v int")


def read(spark, name):
    return sorted((str(r["month"]), r["v"]) for r in spark.table(name).collect())


def month_tables(spark, name):
    return sorted(t.name for t in spark.catalog.listTables() if t.name.startswith(name + "__"))


def test_months_are_replaced_one_by_one(spark, name, tmp_path):
    published.publish(rows(spark, MAY, [1, 2]), name, "month", MAY, str(tmp_path))
    published.publish(rows(spark, JUNE, [3]), name, "month", JUNE, str(tmp_path))
    got = published.publish(rows(spark, MAY, [4]), name, "month", MAY, str(tmp_path))
    assert [r["v"] for r in got.collect()] == [4]
    assert read(spark, name) == [("1998-05-01", 4), ("1998-06-01", 3)]
    assert len(month_tables(spark, name)) == 2 and set(published.months(spark, name)) == {"1998-05-01", "1998-06-01"}


def test_a_month_may_be_made_from_the_table_itself(spark, name, tmp_path):
    published.publish(rows(spark, MAY, [1, 2]), name, "month", MAY, str(tmp_path))
    published.publish(spark.table(name).withColumn("v", F.col("v") + 10), name, "month", MAY, str(tmp_path))
    assert read(spark, name) == [("1998-05-01", 11), ("1998-05-01", 12)]


def test_a_failing_write_leaves_the_old_month(spark, name, tmp_path):
    published.publish(rows(spark, MAY, [1]), name, "month", MAY, str(tmp_path))
    bad = rows(spark, MAY, range(100)).withColumn("v", F.when(F.col("v") < 99, F.col("v")).otherwise(F.raise_error(F.lit("lost")).cast("int")))
    with pytest.raises(Exception, match="lost"):
        published.publish(bad, name, "month", MAY, str(tmp_path))
    with pytest.raises(Exception, match="not a row of 1998-05-01"):
        published.publish(rows(spark, JUNE, [1]), name, "month", MAY, str(tmp_path))
    assert read(spark, name) == [("1998-05-01", 1)]


def test_what_a_killed_run_left_goes_with_the_next(spark, name, tmp_path, monkeypatch):
    published.publish(rows(spark, MAY, [1]), name, "month", MAY, str(tmp_path))
    rows(spark, MAY, [9]).write.option("path", f"{tmp_path}/left").saveAsTable(f"{name}__199805_left")  # written, never published
    assert read(spark, name) == [("1998-05-01", 1)]
    published.publish(rows(spark, JUNE, [2]), name, "month", JUNE, str(tmp_path))
    assert f"{name}__199805_left" not in month_tables(spark, name)
    assert read(spark, name) == [("1998-05-01", 1), ("1998-06-01", 2)]


def test_create_if_absent(spark, name, tmp_path):
    published.publish(rows(spark, MAY, [1]), name, "month", MAY, str(tmp_path), create_if_absent=True)
    published.publish(rows(spark, MAY, [2]), name, "month", MAY, str(tmp_path), create_if_absent=True)
    published.publish(rows(spark, JUNE, [2]), name, "month", JUNE, str(tmp_path), create_if_absent=True)
    assert read(spark, name) == [("1998-05-01", 1)]


def test_a_month_filter_reads_one_table(spark, name, tmp_path):
    for month in (MAY, JUNE):
        published.publish(rows(spark, month, [1]), name, "month", month, str(tmp_path))
    plan = spark.table(name).where(F.col("month") == F.lit(MAY))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
