"""Independent steps run at once."""

import threading

import pytest
from pyspark.sql import functions as F

from churnwise import catalog
from churnwise.operators.together import together


def test_results_come_in_order_and_steps_overlap(spark):
    meet = threading.Barrier(2, timeout=60)
    first, second = together(spark, lambda: (meet.wait(), spark.range(3).count())[1], lambda: (meet.wait(), spark.range(5).count())[1])
    assert (first, second) == (3, 5)


def test_job_settings_are_the_callers(spark):
    spark.sparkContext.setLocalProperty("churnwise.test", "own")
    try:
        assert together(spark, *[lambda: spark.sparkContext.getLocalProperty("churnwise.test")] * 2) == ["own"] * 2
    finally:
        spark.sparkContext.setLocalProperty("churnwise.test", None)


def test_a_failed_step_is_raised_when_all_have_ended(spark):
    ended = []

    def fails():
        raise ValueError("no such table")

    with pytest.raises(ValueError, match="no such table"):
        together(spark, fails, lambda: ended.append(spark.range(2).count()))
    assert ended == [2]


def test_fixed_and_mobile_stage_tables_are_made_at_once(spark, tmp_path, monkeypatch):
    """Each waits for the other before it is written."""
    spark.createDataFrame([(k,) for k in range(40)], "c_custkey long").write.parquet(f"{tmp_path}/customer.parquet")
    orders = spark.range(40).select(F.col("id").alias("o_orderkey"), F.col("id").alias("o_custkey"), F.lit("O").alias("o_orderstatus"),
                                    F.lit("1998-05-03").cast("timestamp").alias("o_orderdate"))
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    meet, real = threading.Barrier(2, timeout=120), catalog.materialize
    monkeypatch.setattr(catalog, "materialize", lambda df, name: (meet.wait(), real(df, name))[1])
    _, t1, t2 = catalog.stage_tables(spark, str(tmp_path))
    assert "fix_s_att_account" in t1.columns and "mob_s_att_account" in t2.columns
    assert t1.count() > 0 and t2.count() > 0
