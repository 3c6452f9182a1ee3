"""The fixed table of several months in one run (PAR-1, SRC-2): the month is a
key of every step instead of a constant of the run.

A run of one month reads the daily snapshot over a window of about two months,
so a run a month reads most days twice or more. Here each day is read once:

* ``account_segments`` aggregates the snapshot per (account, month, segment) in
  one pass, with the columns of the single run's summary. The bounds of the
  windows cut the calendar into segments, so all rows of a group belong to the
  same windows and each group can be dealt whole. All the facts are least and
  greatest values, or values on them, so segments merge without the rows.
* The facts of a calendar month (``whole_months``) merge its segments. Those of
  a window (``window_starts``, the connect date on the latest record that the
  run sees) deal each segment to the windows that hold it and merge those.
* The opening and closing bases take the day-1 partitions of all months, the
  only ones read a second time, for their wide columns. A day-1 row closes one
  month and opens the next, so it is dealt to both, and the full outer join is
  on (account, month).
* The rest is ``fixed.label_months``, whose joins are on (account, month).

Months need not be consecutive; days in no window are not read. The result holds
the rows of a single run of each month, in any order.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnwise.functions import columns as C
from churnwise.functions import labels as L
from churnwise.operators.materialize import materialize
from churnwise.params import RunParams, add_months
from churnwise.plans import fixed
from churnwise.plans.fixed import ACCOUNT, MONTH


def runs_of(p: RunParams, months: Iterable[_dt.date | str]) -> list[RunParams]:
    """The run parameters of each distinct month, in order."""
    runs = sorted({p.at(m).month for m in months})
    if not runs:
        raise ValueError("no month given")
    return [p.at(m) for m in runs]


def windows(runs: list[RunParams]) -> list[tuple[_dt.date, _dt.date]]:
    """The snapshot windows of the runs, those that touch or overlap joined."""
    out: list[tuple[_dt.date, _dt.date]] = []
    for lo, hi in sorted(r.snapshot_window for r in runs):
        if out and lo <= out[-1][1] + _dt.timedelta(days=1):
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def account_segments(snapshot: DataFrame, runs: list[RunParams]) -> DataFrame:
    """One row per (account, month, segment) of the windows: the facts of
    ``fixed.account_month_summary`` over the segment, a day of it (``day``), and
    the subsidy flag of the month's first day (of accounts of any type)."""
    dt = F.col("dt")
    covered = None
    for lo, hi in windows(runs):
        span = dt.between(F.lit(lo), F.lit(hi))
        covered = span if covered is None else covered | span
    # how many windows have begun, and how many have ended, before a day
    bounds = [dt >= F.lit(r.snapshot_window[0]) for r in runs] + [dt > F.lit(r.snapshot_window[1]) for r in runs]
    segment = sum((C.flag(b) for b in bounds), F.lit(0))
    res = F.col("cust_typ_sbb") == "RES"
    aggregates = fixed.month_facts(runs[0], res)
    return (snapshot.where(covered)
            .groupBy(F.col("sub_acct_no_sbb").alias(ACCOUNT), F.trunc(dt, "month").alias("month"), segment.alias("segment"))
            .agg(*aggregates, F.max(dt).alias("day"), F.max(F.when(res, 1)).alias("residential"),
                 F.max(F.when((dt == F.trunc(dt, "month")) & (F.col("acp") == "X"), 1)).alias("subsidized")))


def whole_months(segments: DataFrame, months: Iterable[_dt.date]) -> DataFrame:
    """The summary of whole calendar months: their segments merged."""
    latest = {"last_overdue": "last_dt", "last_connect": "last_dt", "last_mix": "last_ok_dt"}
    greatest = ["last_dt", "last_ok_dt", "has_month_end", "ok_at_end", "ok_before_end", "last_over_dt", "seen_0p"]
    return (segments.where(F.col("month").isin(*months) & (F.col("residential") == 1))
            .groupBy(ACCOUNT, "month")
            .agg(*[F.max(c).alias(c) for c in greatest], *[F.max_by(c, at).alias(c) for c, at in latest.items()]))


def window_starts(segments: DataFrame, runs: list[RunParams]) -> DataFrame:
    """(account, run month): the connect date on the latest record of each run's
    window, and the subsidy flags of the first days of M-1 and M."""
    day, month = F.col("day"), F.col("month")
    dealt = F.filter(F.array(*[F.when(day.between(*[F.lit(d) for d in r.snapshot_window]), F.lit(r.month)) for r in runs]),
                     lambda m: m.isNotNull())
    run = F.col(MONTH)
    # the subsidy days lie in every run's window: the first days of M-1 and of M
    return (segments.withColumn(MONTH, F.explode(dealt)).groupBy(ACCOUNT, MONTH).agg(
        F.max_by("last_connect", "last_dt").alias("max_start"),
        F.max(F.when(month == F.add_months(run, -1), F.col("subsidized"))).alias("_sub_b"),
        F.max(F.when(month == run, F.col("subsidized"))).alias("_sub_e")))


def fixed_tables(src, p: RunParams, months: Iterable[_dt.date | str]) -> DataFrame:
    """The fixed tables of all ``months``, as one DataFrame with the month as a
    column; ``p`` gives the parameters but the month."""
    runs = runs_of(p, months)
    own = [r.month for r in runs]
    base = sorted({m for r in runs for m in (r.prev_month, r.month)})
    firsts = sorted({d for m in base for d in (m, add_months(m, 1))})
    snap = src.daily_snapshot()
    segments = materialize(account_segments(snap, runs), "account_segment")
    summary = materialize(whole_months(segments, base), "account_month")
    inputs = window_starts(segments, runs).withColumnRenamed(MONTH, "_month").withColumnRenamed(ACCOUNT, "sub_acct_no_sbb")

    # a day-1 row opens its own month and closes the one before
    side = lambda at, name: F.struct(at.alias("_month"), F.lit(name).alias("_side"))
    dealt = F.explode(F.array(side(F.col("dt"), "b"), side(F.add_months("dt", -1), "e")))
    rows = fixed.day_one_rows(snap, firsts).select("dt", *fixed.DAY_ONE_COLUMNS, dealt.alias("_of"))
    rows = rows.select("dt", *fixed.DAY_ONE_COLUMNS, "_of.*").where(F.col("_month").isin(*base))
    rows = materialize(rows.join(inputs, ["sub_acct_no_sbb", "_month"], "left"), "day_one")
    status_all = fixed.customer_status(rows.where(F.col("_side") == "b"), rows.where(F.col("_side") == "e"), p)
    left = (F.col("fix_b_fla_active") == 1) & (F.col("fix_e_fla_active") == 0)
    status_all = materialize(status_all.where(F.col(MONTH).isin(*own) | left).distinct(), "status")
    status = fixed.with_movements(status_all.where(F.col(MONTH).isin(*own)))
    before = [r.prev_month for r in runs]
    return fixed.label_months(status, status_all.where(F.col(MONTH).isin(*before) & left), src.service_orders(), summary, own, p)
