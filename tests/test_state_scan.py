"""A fold of the kept state reads its rows once."""

import datetime as dt

from churnwise.operators.state import KeptState

SPEC = KeptState(keys=("k",), order="day", first={"bill": "b"}, last={"over": "o"})
DAY = dt.date(2024, 1, 1)


def _scans(df):
    return df._jdf.queryExecution().executedPlan().toString().count("FileScan")


def test_each_row_is_read_once(spark, tmp_path):
    rows = [(k, DAY + dt.timedelta(days=d), DAY, d) for k in (1, 2, None) for d in range(4)]
    spark.createDataFrame(rows, "k long, day date, b date, o int").write.parquet(f"{tmp_path}/rows")
    table = spark.read.parquet(f"{tmp_path}/rows")
    state = SPEC.collapse(table)
    assert _scans(state) == 1
    state.write.parquet(f"{tmp_path}/state")
    assert _scans(SPEC.merge(SPEC.collapse(table), spark.read.parquet(f"{tmp_path}/state"))) == 2


def test_ends_without_values(spark):
    """A value missing on the end day stays missing, whatever other days and states hold."""
    schema = "k long, day date, b date, o int"
    day = lambda n: DAY + dt.timedelta(days=n)
    early = SPEC.collapse(spark.createDataFrame([(1, day(0), None, 5), (1, day(1), day(9), None)], schema))
    late = SPEC.collapse(spark.createDataFrame([(1, day(1), day(3), 8), (1, day(2), day(4), None)], schema))
    expected = [(1, day(0), day(2), None, None)]
    assert [tuple(r) for r in SPEC.merge(early, late).collect()] == expected
    bare = KeptState(keys=("k",), order="day")
    assert [tuple(r) for r in bare.merge(bare.collapse(late.selectExpr("k", "last_day as day")), early).collect()] == [(1, day(0), day(2))]
