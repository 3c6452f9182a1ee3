"""The aggregated involuntary-churn rule equals the literal row-level rule
(month-end joins, last three record days) on random snapshots with gaps."""

import datetime as dt
import random

from pyspark.sql import functions as F

from churnwise.params import RunParams
from churnwise.plans import fixed
from tests.helpers import D, ListSources, days, snap_row

M = D(1998, 5, 1)
P = RunParams(M)
THR = 85


def _month(d):
    return d.replace(day=1)


def _next_month(d):
    return (d.replace(day=28) + dt.timedelta(days=4)).replace(day=1)


def _month_end(d):
    return _next_month(d) - dt.timedelta(days=1)


def brute_force(rows):
    """rows: {(acct, day): overdue} of the window (residential, with product)."""
    by_acct = {}
    for (a, d), o in rows.items():
        by_acct.setdefault(a, {})[d] = o
    out = set()
    for a, recs in by_acct.items():
        # under the threshold on a month-end record or the day before it -> next month
        ok_start = set()
        for e in [d for d in recs if d == _month_end(d)]:
            for d in (e, e - dt.timedelta(days=1)):
                if d in recs and recs[d] is not None and recs[d] < THR:
                    ok_start.add(_next_month(d))
        # at/over the threshold on one of the last three days of any month's last record
        cand = set()
        for m in {_month(d) for d in recs}:
            last = max(d for d in recs if _month(d) == m)
            cand |= {last, last - dt.timedelta(days=1), last - dt.timedelta(days=2)}
        over_end = {_month(d) for d in cand if d in recs and recs[d] is not None and recs[d] >= THR}
        for m in ok_start & over_end:
            last = max(d for d in recs if _month(d) == m)
            if recs[last] is not None and recs[last] >= THR:
                out.add((m, a))
    return {a for m, a in out if m == M}


def test_involuntary_rule_matches_literal_reading(spark):
    rnd = random.Random(11)
    rows = {}
    for a in range(300):
        start = rnd.choice([60, 70, 80, 84, 85, 86, 90])
        step = rnd.choice([0, 1, 1, 2])
        for d in days(D(1998, 3, 31), D(1998, 6, 1)):
            if rnd.random() < 0.15:          # random gaps
                continue
            o = start + step * max(0, (d - D(1998, 4, 25)).days)
            rows[(a, d)] = None if rnd.random() < 0.05 else o
    snap = [snap_row(d, a, overdue=o) for (a, d), o in rows.items()]
    summary = fixed.account_month_summary(ListSources(spark, snap).daily_snapshot(), P)
    got = {r.fix_s_att_account for r in
           fixed.involuntary_churners(summary, P).where(F.col("month") == F.lit(M)).collect()}
    expect = brute_force(rows)
    assert expect, "the random data should contain involuntary churners"
    assert got == expect
