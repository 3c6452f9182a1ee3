"""Plan properties the scale design relies on (checked on the physical plan)."""

import os

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
HEADLINE = ["fixed_table", "mobile_table", "converged_table", "sales_drivers", "involuntary_equation"]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")
@pytest.mark.parametrize("key", HEADLINE)
def test_no_pairwise_joins_or_expand(spark, key):
    plan = _plan(entry.queries()[key](spark, SF))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Expand ["):
        assert bad not in plan, f"{key}: {bad}"


@pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")
def test_snapshot_scans_are_partition_pruned(spark):
    from churnwise.params import RunParams
    from churnwise.plans import fixed
    from churnwise.sources.fixtures import FIXTURE_MONTH, FixtureSources
    p = RunParams(FIXTURE_MONTH)
    snap = FixtureSources(spark, SF).daily_snapshot()
    summary = _plan(fixed.account_month_summary(snap, p))
    assert "PartitionFilters: [isnotnull(dt" in summary and "1998-03-31" in summary
    day1 = _plan(fixed.day_one_rows(snap, (p.prev_month, p.month, p.next_month)).select("sub_acct_no_sbb"))
    assert "PartitionFilters: [dt" in day1 and " IN (1998-04-01,1998-05-01,1998-06-01)" in day1
    # column pruning: the day-1 projection does not read the charges
    assert "hsd_chrg" not in day1.split("ReadSchema")[1].split("\n")[0]


@pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")
def test_links_use_window_group_limit(spark):
    plan = _plan(entry.queries()["fixed_mobile_links"](spark, SF))
    assert "WindowGroupLimit" in plan


@pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")
@pytest.mark.parametrize("key", ["never_paid", "first_cycle_payment_rows"])
def test_payments_scan_is_bounded_at_run_time(spark, key):
    """The payment days are listed between two scalar subqueries over the written first cycles."""
    df = entry.queries()[key](spark, SF)
    scan = [line for line in _plan(df).split("\n") if "FileScan" in line and "payment_amt_usd" in line]
    assert len(scan) == 1
    filters = scan[0].split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert filters.count("ubquery") >= 2 and "dt" in filters
    df.collect()
    qe = df._jdf.queryExecution().executedPlan().toString()
    assert "first_bill_created" in qe


@pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")
def test_new_customer_rows_are_read_from_the_first_day_seen(spark, monkeypatch):
    from churnwise.catalog import P
    from churnwise.plans import sales
    from churnwise.sources.fixtures import FixtureSources
    plans = []
    real = sales.materialize
    monkeypatch.setattr(sales, "materialize", lambda df, name: (plans.append((name, _plan(df))), real(df, name))[1])
    sales.new_customer_rows(FixtureSources(spark, SF).daily_snapshot(), P)
    rows = dict(plans)["new_customer_rows"]
    scans = [line for line in rows.split("\n") if "FileScan" in line and "hsd_chrg" in line]
    assert len(scans) == 1 and "ubquery" in scans[0].split("PartitionFilters: [")[1].split("PushedFilters")[0]


@pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")
def test_fixed_table_reads_the_snapshot_three_times(spark, monkeypatch):
    """Over the whole run, written intermediates included: three scans and one full outer join."""
    from churnwise.catalog import P
    from churnwise.plans import fixed
    from churnwise.sources.fixtures import FixtureSources
    plans = []
    real = fixed.materialize
    monkeypatch.setattr(fixed, "materialize", lambda df, name: (plans.append(_plan(df)), real(df, name))[1])
    src = FixtureSources(spark, SF)
    plans.append(_plan(fixed.fixed_table(src, P)))
    lines = "\n".join(plans).split("\n")
    assert sum("FileScan" in x and "/daily_snapshot" in x for x in lines) <= 3
    assert sum("FullOuter" in x for x in lines) == 1


@pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")
def test_interactions_are_hash_aggregated(spark, monkeypatch):
    from churnwise.plans import sales
    plans = []
    real = sales.materialize
    monkeypatch.setattr(sales, "materialize", lambda df, name: (plans.append(_plan(df)), real(df, name))[1])
    plans.append(_plan(entry.queries()["interaction_types"](spark, SF)))
    assert not any("SortAggregate" in p for p in plans)
