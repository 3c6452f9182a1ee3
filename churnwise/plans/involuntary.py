"""Involuntary-churn funnel: accounts reaching overdue day 30, day 50
(soft disconnect), the backlog band before the threshold and the hard
disconnect, by product, rolled up by opening/closing segment (OP-21).

Plan shape: the month's daily overdue values are reduced to four flags per
account by one ``groupBy(account)`` before meeting the converged table, so
the one-row-per-account-per-day join of the source logic never
materialises; the 20 distinct counts are a two-level rollup.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnwise.functions import labels as L
from churnwise.operators.rollup import distinct_flag_rollup
from churnwise.params import RunParams

ACCOUNT = "fix_s_att_account"
DIMS = ["fmc_s_dim_month", "fmc_b_fla_fmcsegment", "fmc_b_fla_fmc", "fmc_b_fla_tech", "fix_b_fla_tenure",
        "fmc_e_fla_fmcsegment", "fmc_e_fla_fmc", "fmc_e_fla_tech", "fix_e_fla_tenure", "fix_s_fla_churnflag",
        "fix_s_fla_churntype", "fix_s_fla_mainmovement", "fmc_s_fla_waterfall"]
STAGES = ("overdueday1", "softdx", "backlog", "harddx")


def overdue_stages(snapshot: DataFrame, p: RunParams) -> DataFrame:
    """Per account: whether any day of month M sits at overdue day 30, day 50,
    in the backlog band [threshold - days(month start..month end),
    threshold], or at/over the threshold."""
    thr = p.overdue_days
    band_low = thr - (p.month_end - p.month).days
    d = F.col("delinquency_days")
    rows = snapshot.where((F.col("dt") >= F.lit(p.month)) & (F.col("dt") < F.lit(p.next_month))
                          & (F.col("play_type") != L.PLAY_NONE) & (F.col("cust_typ_sbb") == "RES"))
    return rows.groupBy(F.col("sub_acct_no_sbb").alias(ACCOUNT)).agg(
        F.max(d == p.funnel_day1).alias("_overdueday1"),
        F.max(d == p.funnel_soft).alias("_softdx"),
        F.max(d.between(band_low, thr)).alias("_backlog"),
        F.max(d >= thr).alias("_harddx"))


def funnel_flags(fmc: DataFrame, stages: DataFrame, p: RunParams, extra: list[str] = ()) -> DataFrame:
    """Report rows of month M with each funnel flag (the account or NULL),
    overall and per product (closing product for day 30 / day 50, opening
    product for backlog / hard disconnect)."""
    base = fmc.where(F.col("fmc_s_dim_month") == F.lit(p.month)).join(stages, ACCOUNT, "left")
    acct = F.col(ACCOUNT)
    on = lambda c: F.coalesce(F.col(c), F.lit(False))
    flag = {
        "overdueday1flag": F.when(on("_overdueday1"), acct),
        "softdxflag": F.when(on("_softdx"), acct),
        "backlogflag": F.when(on("_backlog"), acct),
        "harddxflag": F.when(on("_harddx") & (F.col("fmc_s_fla_churntype") == "Involuntary Churner"), acct),
    }
    cols = [v.alias(k) for k, v in flag.items()]
    for prod in ("bb", "tv", "vo"):
        for stage, side in (("overdueday1", "e"), ("softdx", "e"), ("backlog", "b"), ("harddx", "b")):
            cols.append(F.when(flag[f"{stage}flag"].isNotNull() & F.col(f"fix_{side}_fla_{prod}").isNotNull(),
                               flag[f"{stage}flag"]).alias(f"{stage}_{prod}"))
    return base.select(*DIMS, *extra, ACCOUNT, "fix_e_fla_bb", "fix_e_fla_tv", "fix_e_fla_vo", *cols)


def _counts() -> dict:
    c = F.col
    out = {"che_s_mes_active_base": c(ACCOUNT), "che_s_mes_total_bb": c("fix_e_fla_bb"),
           "che_s_mes_total_tv": c("fix_e_fla_tv"), "che_s_mes_total_vo": c("fix_e_fla_vo"),
           "che_s_mes_day1": c("overdueday1flag"), "che_s_mes_softdx": c("softdxflag"),
           "che_s_mes_backlog": c("backlogflag"), "che_s_mes_harddx": c("harddxflag")}
    for prod in ("bb", "tv", "vo"):
        out[f"che_s_mes_overdue1day_{prod}"] = c(f"overdueday1_{prod}")
        out[f"che_s_mes_softdx_{prod}"] = c(f"softdx_{prod}")
        out[f"che_s_mes_backlog_{prod}"] = c(f"backlog_{prod}")
        out[f"che_s_mes_harddx_{prod}"] = c(f"harddx_{prod}")
    return out


def involuntary_equation(fmc: DataFrame, snapshot: DataFrame, p: RunParams) -> DataFrame:
    """Funnel counts by the 13 opening/closing dimensions."""
    rows = funnel_flags(fmc, overdue_stages(snapshot, p), p)
    return distinct_flag_rollup(rows, DIMS, ACCOUNT, _counts()).orderBy(F.col("fmc_s_dim_month").asc_nulls_last())


def fast_check(fmc: DataFrame, snapshot: DataFrame, p: RunParams) -> DataFrame:
    """Month totals of the funnel, without dimensions (the source's QA query)."""
    rows = funnel_flags(fmc, overdue_stages(snapshot, p), p)
    c = F.col
    counts = {f"{s}_clients": c(f"{s}flag") for s in STAGES}
    for s in STAGES:
        for prod in ("bb", "tv", "vo"):
            counts[f"{s}_{prod}"] = c(f"{s}_{prod}")
    counts["che_s_mes_active_base"] = c(ACCOUNT)
    return distinct_flag_rollup(rows, [], ACCOUNT, counts)


def churn_type_check(fmc: DataFrame, snapshot: DataFrame, p: RunParams) -> DataFrame:
    """Hard disconnects per converged churn type (the source's QA query)."""
    rows = funnel_flags(fmc, overdue_stages(snapshot, p), p, extra=["fmc_s_fla_churntype"])
    c = F.col
    counts = {"harddx_clients": c("harddxflag"), "harddx_bb": c("harddx_bb"), "harddx_tv": c("harddx_tv"),
              "harddx_vo": c("harddx_vo")}
    return distinct_flag_rollup(rows, ["fmc_s_fla_churntype"], ACCOUNT, counts)
