"""The monthly chain as stage tables: fixed (T1) and mobile (T2) tables,
the converged table (T3), then the sales-driver and involuntary-funnel
reports, each written month-partitioned under a shared stage folder and
read back by the next step (partition-pruned to the run month).

Writing the stage tables is what cuts lineage between steps: a lost
executor in the report step re-reads T3 files instead of recomputing the
whole chain.
"""

from __future__ import annotations

import dataclasses
import datetime as _dt
import time
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnwise import sinks
from churnwise.sinks import published
from churnwise.operators import materialize as materialize_mod
from churnwise.params import RunParams
from churnwise.plans import contracts, converged, fixed, involuntary, mobile, sales
from churnwise.plans import months as months_plan

T1, T2, T3 = "fixed_table", "mobile_table", "converged_table"
SALES, FUNNEL = "sales_drivers", "involuntary_equation"


@dataclass
class MonthlyRun:
    spark: SparkSession
    src: object
    params: RunParams
    stage_root: str
    #: An existing stage table is left as it is, with all its months.
    create_if_absent: bool = False
    #: A database: the stage tables are published there (see sinks.published).
    catalog: str | None = None
    timings: dict = field(default_factory=dict)

    def _path(self, name: str) -> str:
        return f"{self.stage_root.rstrip('/')}/{name}"

    def _step(self, name: str, build, month_col: str) -> DataFrame:
        """Build (eager checkpoints inside run here) and write one stage table."""
        t0 = time.time()
        if self.catalog:
            month = published.publish(build(), f"{self.catalog}.{name}", month_col, self.params.month, self.stage_root, self.create_if_absent)
            self.timings[name] = round(time.time() - t0, 3)
            return month
        write = sinks.create_if_absent if self.create_if_absent else sinks.write_month
        write(build(), self._path(name), month_col)
        self.timings[name] = round(time.time() - t0, 3)
        return sinks.read_month(self.spark, self._path(name), month_col, self.params.month)

    def fixed(self) -> DataFrame:
        return self._step(T1, lambda: fixed.fixed_table(self.src, self.params), "fix_s_dim_month")

    def fixed_months(self, months: Iterable[_dt.date | str]) -> dict[_dt.date, DataFrame]:
        """The fixed tables of several months from one pass over the snapshot,
        each written as its month of T1."""
        runs = [dataclasses.replace(self, params=r) for r in months_plan.runs_of(self.params, months)]
        t0 = time.time()
        together = materialize_mod.materialize(months_plan.fixed_tables(self.src, self.params, [r.params.month for r in runs]), "fixed_months")
        self.timings["fixed_months"] = round(time.time() - t0, 3)
        return {r.params.month: r._step(T1, lambda r=r: together.where(F.col("fix_s_dim_month") == F.lit(r.params.month)), "fix_s_dim_month")
                for r in runs}

    def mobile(self) -> DataFrame:
        return self._step(T2, lambda: mobile.mobile_table(self.src, self.params), "mob_s_dim_month")

    def converged(self, t1: DataFrame, t2: DataFrame) -> DataFrame:
        def build():
            t3 = converged.converged_table(t1, contracts.mobile_for_converged(t2), self.src.prepaid_master(),
                                           self.src.fmc_bill_codes(), self.params)
            return contracts.converged_for_reports(t3)
        return self._step(T3, build, "fmc_s_dim_month")

    def reports(self, t3: DataFrame) -> dict[str, DataFrame]:
        p, s = self.params, self.src
        out = {
            SALES: self._step(SALES, lambda: sales.sales_drivers(
                t3, s.daily_snapshot(), s.interactions(), s.truckrolls(), s.payments(), p), "opd_s_dim_month"),
            FUNNEL: self._step(FUNNEL, lambda: involuntary.involuntary_equation(t3, s.daily_snapshot(), p),
                               "fmc_s_dim_month"),
        }
        return out

    def run(self, release_intermediates: bool = True, t1: DataFrame | None = None) -> dict[str, DataFrame]:
        """The chain of one month; ``t1``: its fixed table, if it is written already."""
        before = set(materialize_mod.created())
        try:
            t1 = self.fixed() if t1 is None else t1
            t2 = self.mobile()
            t3 = self.converged(t1, t2)
            return {T1: t1, T2: t2, T3: t3, **self.reports(t3)}
        finally:
            if release_intermediates:
                # every result above is read from its stage table, not from these
                materialize_mod.release(self.spark, [p for p in materialize_mod.created() if p not in before])

    def run_months(self, months: Iterable[_dt.date | str]) -> dict[_dt.date, dict[str, DataFrame]]:
        """The chain of several months: the fixed tables, which read the daily
        history, together, then the other steps month by month."""
        before = set(materialize_mod.created())
        try:
            fixed_of = self.fixed_months(months)
        finally:
            materialize_mod.release(self.spark, [p for p in materialize_mod.created() if p not in before])
        out = {}
        for month, t1 in fixed_of.items():
            one = dataclasses.replace(self, params=self.params.at(month), timings={})
            out[month] = one.run(t1=t1)
            self.timings[month.isoformat()] = one.timings
        return out
