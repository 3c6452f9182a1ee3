"""Several months in one run against a run of each month."""

import pytest

from churnwise.operators import materialize
from churnwise.params import RunParams
from churnwise.plans import fixed, months
from churnwise.plans.monthly import MonthlyRun
from tests.helpers import D, ListSources
from tests.test_random_fixed import _random_rows

P = RunParams(D(1998, 5, 1), install_org="OPCO")


def _sorted(df):
    cols = fixed.FIXED_COLUMNS
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("seed,of", [(21, ["1998-04-01", "1998-05-01", "1998-06-01"]), (22, ["1998-05-01"]),
                                     (23, ["1998-06-01", "1998-03-01", "1998-05-20"])])
def test_equals_a_run_of_each_month(spark, seed, of):
    src = ListSources(spark, *_random_rows(seed, accounts=250))
    got = _sorted(months.fixed_tables(src, P, of))
    runs = months.runs_of(P, of)
    assert [r.month for r in runs] == sorted({D(1998, int(m[5:7]), 1) for m in of})
    want = [row for r in runs for row in _sorted(fixed.fixed_table(src, r))]
    assert len(got) == len(want) > 100
    assert got == sorted(want, key=lambda r: tuple((v is None, str(v)) for v in r))


def test_windows_are_joined_or_apart():
    span = lambda *ms: months.windows(months.runs_of(P, ms))
    assert span("1998-04-01", "1998-05-01") == [(D(1998, 2, 28), D(1998, 6, 1))]
    assert span("1998-01-01", "1998-06-01") == [(D(1997, 11, 30), D(1998, 2, 1)), (D(1998, 4, 30), D(1998, 7, 1))]
    with pytest.raises(ValueError):
        months.runs_of(P, [])


def test_empty_snapshot(spark):
    assert months.fixed_tables(ListSources(spark), P, ["1998-04-01", "1998-05-01"]).collect() == []


def test_each_day_is_read_once(spark, tmp_path, monkeypatch):
    """Written intermediates included: the days in one scan, the day-1
    partitions in one more, and one full outer join, whatever the months."""
    src = ListSources(spark, *_random_rows(24, accounts=20))
    path = f"{tmp_path}/snapshot"
    src.daily_snapshot().write.partitionBy("dt").parquet(path)
    monkeypatch.setattr(src, "daily_snapshot", lambda: spark.read.parquet(path))
    plans = []
    real = materialize.materialize

    def spy(df, name="stage"):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df, name)

    monkeypatch.setattr(months, "materialize", spy)
    out = months.fixed_tables(src, P, ["1998-04-01", "1998-05-01", "1998-06-01"])
    plans.append(out._jdf.queryExecution().executedPlan().toString())
    text = "\n".join(plans)
    scans = [line for line in text.split("\n") if "FileScan" in line and path in line]
    assert len(scans) == 2 and all("PartitionFilters: [" in s and "dt" in s.split("PartitionFilters: [")[1] for s in scans)
    assert text.count("FullOuter") == 1
    assert "SortAggregate" not in plans[0]


def test_chain_of_months_reads_the_fixed_tables_once(spark, tmp_path, monkeypatch):
    src = ListSources(spark, *_random_rows(25, accounts=40))
    run = MonthlyRun(spark, src, P, str(tmp_path))
    tables = run.fixed_months(["1998-04-01", "1998-05-01"])
    assert sorted(tables) == [D(1998, 4, 1), D(1998, 5, 1)]
    for m, t1 in tables.items():
        assert _sorted(t1) == _sorted(fixed.fixed_table(src, P.at(m)))
