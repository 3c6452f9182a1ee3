"""Postpaid mobile monthly table: reinstatement of falsely cancelled
subscribers, opening/closing base, MRC split per subscriber, movements,
spins, churn from cancellations, rejoiners.

Plan shape: the six-month master is read once into an *adjusted master*
(every master row of subscribers not falsely cancelled, plus the latest row
of the reinstated ones), which is checkpointed and then filtered for the
opening base, closing base, new-customer test, rejoiner test and cleaning
test. Windows of the source logic (first activation, latest cancellation,
latest master row) are ``min_by``/``max_by`` aggregations per subscriber.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnwise.functions import columns as C
from churnwise.functions import labels as L
from churnwise.operators.existence import left_join_fanout, not_in, presence, with_memberships
from churnwise.operators.materialize import materialize
from churnwise.params import RunParams

ACCOUNT = "mob_s_att_account"

MOBILE_COLUMNS = [
    "mob_s_dim_month", "mob_s_att_account", "mob_s_att_ParentAccount", "mob_s_att_MobileType",
    "mob_b_fla_active", "mob_e_fla_active", "mob_b_dim_date", "mob_b_mes_tenure_days", "mob_b_dim_max_start",
    "mob_b_fla_Tenure", "mob_b_mes_MRC", "mob_b_mes_rgus", "mob_e_dim_date", "mob_e_mes_tenure_days",
    "mob_e_dim_max_start", "mob_e_fla_Tenure", "mob_e_mes_MRC", "mob_e_mes_rgus", "mob_s_fla_movement",
    "mob_s_mes_mrc_diff", "mob_s_fla_SpinMovement", "mob_s_fla_churn", "mob_s_dim_churn_type",
    "mob_s_fla_rejoiner_month",
]


# The columns of the master that the monthly logic reads.
MASTER_COLUMNS = ["dt", "subsrptn_id", "cust_id", "subsrptn_actvtn_dt", "cust_sts", "acct_type_cd", "rgn_nm",
                  "subsrptn_sts", "flg_susp_curr_mo", "lst_susp_dt"]


def active_residential(prefix: str = "") -> Column:
    """Open, individual, outside region VI, active subscription."""
    c = lambda n: F.col(prefix + n)
    return (c("cust_sts") == "O") & (c("acct_type_cd") == "I") & (c("rgn_nm") != "VI") & (c("subsrptn_sts") == "A")


def _sts_date(c: str = "subsrptn_sts_dt") -> Column:
    """Status date text (date or timestamp text) -> date, from its first 10 characters."""
    return F.to_date(F.substring(F.col(c), 1, 10))


def invalid_cancellation(acct_reason: str = "acct_sts_rsn_desc", susp_reason: str = "lst_susp_rsn_desc") -> Column:
    return (C.lower_like_any(acct_reason, L.INVALID_REASON_PATTERNS)
            | C.lower_like_any(susp_reason, L.INVALID_SUSPENSION_PATTERNS))


def false_churns(cancels: DataFrame, p: RunParams) -> DataFrame:
    """Subscribers whose latest cancellation of the six previous months has a
    reason that is not a real churn (OP-12, first half)."""
    lo, hi = p.shift(-p.mobile_lookback_months), p.month
    # months M-6 .. M-1, written as a range on the raw column so it reaches the scan
    rows = cancels.where((F.col("dt") >= F.lit(lo)) & (F.col("dt") < F.lit(hi)))
    invalid = F.coalesce(invalid_cancellation(), F.lit(False))
    # latest status date wins; on a tie an invalid reason wins. The two last dates
    # decide it, which keeps the aggregation buffer of fixed width
    day = _sts_date()
    latest = rows.groupBy("subsrptn_id").agg(F.max(day).alias("last"), F.max(F.when(invalid, day)).alias("last_invalid"),
                                             F.max(F.when(day.isNull() & invalid, True)).alias("undated"))
    return latest.where((F.col("last_invalid") == F.col("last"))
                        | (F.col("last").isNull() & F.col("undated"))).select("subsrptn_id")


def adjusted_master(master: DataFrame, fake: DataFrame, p: RunParams) -> DataFrame:
    """Six-month master with reinstated subscribers (OP-12, second half).

    Columns: those of MASTER_COLUMNS, ``activation_dt``, ``dt_2`` (the month the row
    stands for; the run month for reinstated rows) and ``reinstated``.
    """
    lo, M = p.shift(-p.mobile_lookback_months), p.month
    rows = master.where(F.col("dt").between(F.lit(lo), F.lit(M))).select(*MASTER_COLUMNS)
    per_sub = rows.groupBy("subsrptn_id").agg(
        F.min_by(F.to_date("subsrptn_actvtn_dt"), F.col("dt")).alias("activation_dt"))
    per_sub = per_sub.join(fake.withColumn("_fake", F.lit(True)), "subsrptn_id", "left").withColumnRenamed("subsrptn_id", "_sub")
    rows = rows.join(per_sub, F.col("subsrptn_id").eqNullSafe(F.col("_sub"))).drop("_sub")
    rows = rows.withColumn("reinstated", F.coalesce("_fake", F.lit(False)))
    # the others are those NOT IN the reinstated, in three-valued logic
    there = presence(fake, "subsrptn_id")
    rows = rows.where(F.col("reinstated") | (~there["nulls"] & (F.col("subsrptn_id").isNotNull() | ~there["rows"])))
    # a reinstated subscriber keeps one row, its latest before M, standing for M (a
    # subscriber has a row a month, so the windows are small)
    before = F.col("dt") < F.lit(M)
    latest = Window.partitionBy("subsrptn_id").orderBy(before.desc(), F.col("dt").desc(), *[F.col(c).asc() for c in MASTER_COLUMNS[2:]])
    rows = rows.withColumn("_nth", F.when(F.col("reinstated"), F.row_number().over(latest)))
    rows = rows.where(~F.col("reinstated") | ((F.col("_nth") == 1) & before))
    return (rows.withColumn("dt_2", F.when(F.col("reinstated"), F.lit(M)).otherwise(F.to_date("dt")))
            .drop("_nth", "_fake", "subsrptn_actvtn_dt"))


def _tenure_cols(adj: DataFrame, side: str, asof: Column, p: RunParams) -> list[Column]:
    days = F.datediff(asof, F.col("activation_dt"))
    band = F.when(days <= p.tenure_early, L.EARLY).when(days <= p.tenure_mid, L.MID).when(days > p.tenure_mid, L.LATE)
    return [days.alias(f"mob_{side}_mes_tenure_days"), F.col("activation_dt").alias(f"mob_{side}_dim_max_start"),
            band.alias(f"mob_{side}_fla_Tenure")]


def customer_status(adj: DataFrame, p: RunParams) -> DataFrame:
    """Opening base (active at M-1, plus reinstated) full-outer-joined with
    the closing base (active at M) on the subscriber."""
    M, prev = p.month, p.prev_month
    act = active_residential()
    open_rows = adj.where(act & (((F.col("dt_2") == F.lit(prev)) & ~F.col("reinstated"))
                                 | ((F.col("dt_2") == F.lit(M)) & F.col("reinstated"))))
    # reinstated subscribers are aged as of the end of M-1, the others as of their month end
    b_asof = F.when(F.col("reinstated"), F.add_months(F.last_day("dt_2"), -1)).otherwise(F.last_day("dt_2"))
    bom = open_rows.select(
        F.col("subsrptn_id").alias(ACCOUNT), F.col("cust_id").alias("_b_parent"), F.lit(1).alias("_b"),
        F.col("reinstated").alias("_b_reinstated"),
        F.last_day("dt_2").alias("mob_b_dim_date"), *_tenure_cols(open_rows, "b", b_asof, p),
        F.lit(None).cast("double").alias("mob_b_mes_MRC"), F.lit(1).alias("mob_b_mes_rgus"))
    close_rows = adj.where(act & (F.col("dt_2") == F.lit(M)))
    eom = close_rows.select(
        F.col("subsrptn_id").alias(ACCOUNT), F.col("cust_id").alias("_e_parent"), F.lit(1).alias("_e"),
        F.col("reinstated").alias("_e_reinstated"),
        F.last_day("dt_2").alias("mob_e_dim_date"), *_tenure_cols(close_rows, "e", F.last_day("dt_2"), p),
        F.lit(None).cast("double").alias("mob_e_mes_MRC"), F.lit(1).alias("mob_e_mes_rgus"))
    st = bom.join(eom, ACCOUNT, "full_outer")
    return st.select(
        F.lit(M).alias("mob_s_dim_month"), ACCOUNT,
        F.coalesce("_b_parent", "_e_parent").alias("mob_s_att_ParentAccount"),
        F.lit(L.POSTPAID).alias("mob_s_att_MobileType"),
        F.when(F.coalesce("_e_reinstated", F.lit(False)) | F.col("_b").isNotNull(), 1).otherwise(0)
         .alias("mob_b_fla_active"),
        F.when(F.col("_e").isNotNull(), 1).otherwise(0).alias("mob_e_fla_active"),
        *MOBILE_COLUMNS[6:18])


def with_mrc(status: DataFrame, mrc: DataFrame, p: RunParams) -> DataFrame:
    """Parent-account MRC split evenly over the parent's active subscribers
    (OP-11); NULL when the parent has none or no MRC row."""
    prev = p.prev_month
    close_month = prev if p.month < p.mrc_rate_switch else p.month
    per_parent = (mrc.where(F.col("dt").between(F.lit(prev), F.lit(p.month)))
                  .groupBy(F.to_date("dt").alias("dt"), F.col("acct_nbr").alias("_parent"))
                  .agg(F.sum(F.col("`mrc/account`")).alias("mrc")))
    counts = (status.groupBy(F.col("mob_s_att_ParentAccount").alias("_parent"))
              .agg(F.sum("mob_b_fla_active").alias("_nb"), F.sum("mob_e_fla_active").alias("_ne")))
    shares = (counts
              .join(per_parent.where(F.col("dt") == F.lit(prev)).select("_parent", F.col("mrc").alias("_bm")),
                    "_parent", "left")
              .join(per_parent.where(F.col("dt") == F.lit(close_month)).select("_parent", F.col("mrc").alias("_em")),
                    "_parent", "left")
              .select("_parent",
                      F.when(F.col("_nb") != 0, F.col("_bm") / F.col("_nb")).alias("_b_share"),
                      F.when(F.col("_ne") != 0, F.col("_em") / F.col("_ne")).alias("_e_share")))
    out = status.join(shares, status["mob_s_att_ParentAccount"] == shares["_parent"], "left")
    return out.select(*[F.col("_b_share").alias(c) if c == "mob_b_mes_MRC"
                        else F.col("_e_share").alias(c) if c == "mob_e_mes_MRC" else F.col(c)
                        for c in status.columns])


def disconnections(cancels: DataFrame, p: RunParams) -> DataFrame:
    """Cancellations of month M that are real churn, typed by reason."""
    rows = cancels.where((F.col("dt") == F.lit(p.month)) & (F.col("acct_type_cd") == "I")
                         & (F.col("rgn_nm") != "VI")
                         & ~C.lower_like_any("acct_sts_rsn_desc", L.INVALID_REASON_PATTERNS)
                         & ~C.lower_like_any("lst_susp_rsn_desc", L.INVALID_SUSPENSION_PATTERNS))
    invol = (C.lower_like_any("acct_sts_rsn_desc", L.INVOLUNTARY_REASON_PATTERNS)
             | C.lower_like_any("lst_susp_rsn_desc", L.INVOLUNTARY_SUSPENSION_PATTERNS))
    out = rows.select(F.col("subsrptn_id").alias(ACCOUNT), _sts_date().alias("disconnection_date"),
                      F.when(invol, "Involuntary").otherwise("Voluntary").alias("churn_type"))
    if p.dedupe_mobile_churners:  # the source keeps every cancellation row
        out = out.groupBy(ACCOUNT).agg(F.max_by("churn_type", F.struct("disconnection_date", "churn_type")).alias("churn_type"))
    return out.select(ACCOUNT, "churn_type")


def mobile_table(src, p: RunParams) -> DataFrame:
    M, prev = p.month, p.prev_month
    cancels = src.postpaid_cancellations()
    fake = materialize(false_churns(cancels, p))
    adj = materialize(adjusted_master(src.postpaid_master(), fake, p))
    status = with_mrc(customer_status(adj, p), src.postpaid_mrc(), p)

    # every membership test of the month, attached with one join: seen active in
    # the six previous months (new vs come back), reinstated, rejoiner candidate
    # (active at M-2, not cancelled while active at M-1), and cleaning (active
    # at M-1 and not suspended during M-1)
    lo = p.shift(-p.mobile_lookback_months)
    act = active_residential()
    susp = F.trim("lst_susp_dt")
    susp_month = F.trunc(F.to_date(F.when(F.length(susp) == 10, susp).otherwise(F.lit("1900-01-01"))), "month")
    cancelled_prev = cancels.where((F.col("dt") == F.lit(prev)) & act).select("subsrptn_id")
    ids = lambda df: df.select(F.col("subsrptn_id").alias(ACCOUNT))
    seen = adj.where(F.col("dt").between(F.lit(lo), F.lit(prev)) & act)
    status = with_memberships(status, {
        "_seen": ids(seen),
        "_fake": ids(fake),
        "_rejoin": ids(not_in(adj.where((F.col("dt") == F.lit(p.shift(-2))) & act), cancelled_prev, "subsrptn_id")),
        "_clean": ids(adj.where((F.col("dt") == F.lit(prev)) & act & (F.col("flg_susp_curr_mo") == 0)
                                & (susp_month != F.lit(prev)))),
    }, ACCOUNT)

    b, e = F.col("mob_b_mes_rgus"), F.col("mob_e_mes_rgus")
    # new: NOT IN the seen, in three-valued logic
    there = presence(seen, "subsrptn_id")
    fake_c = F.col("_fake")
    new_c = ~F.col("_seen") & ~there["nulls"] & (F.col(ACCOUNT).isNotNull() | ~there["rows"])
    movement = (F.when(((e - b) == 0) | fake_c, L.SAME)
                .when((e - b) > 0, L.UPSELL).when((e - b) < 0, L.DOWNSELL)
                .when(b.isNull() & (e > 0) & new_c & ~fake_c, L.NEW_CUSTOMER)
                .when(b.isNull() & (e > 0) & ~new_c & ~fake_c, L.COME_BACK)
                .when((b > 0) & e.isNull(), L.NULL_LAST_DAY)
                .when(b.isNull() & e.isNull(), L.ALWAYS_NULL))
    diff = F.coalesce("mob_e_mes_MRC", F.lit(0.0)) - F.coalesce("mob_b_mes_MRC", F.lit(0.0))
    same, d = F.col("mob_s_fla_movement") == L.SAME, C.ieee(diff)
    status = (status.withColumn("mob_s_fla_movement", movement)
              .withColumn("mob_s_mes_mrc_diff", F.round(diff, 0))
              .withColumn("mob_s_fla_SpinMovement",
                          F.when(same & (d == 0), L.MOBILE_SPIN[0]).when(same & (d > 0), L.MOBILE_SPIN[1])
                          .when(same & (d < 0), L.MOBILE_SPIN[2]).otherwise(L.MOBILE_SPIN[3])))

    churn = disconnections(cancels, p).withColumn("_churner", F.lit(1))
    status = left_join_fanout(status, churn, ACCOUNT)  # one row per cancellation of the month
    status = (status.withColumn("mob_s_fla_churn", F.when(F.col("_churner").isNotNull(), L.MOB_CHURNER)
                                .otherwise(L.MOB_NONCHURNER))
              .withColumn("mob_s_dim_churn_type",
                          F.when(F.col("churn_type") == "Involuntary", L.MOB_INVOLUNTARY)
                          .when(F.col("churn_type") == "Voluntary", L.MOB_VOLUNTARY)))
    return final_flags(status).where(F.col("mob_b_fla_active") + F.col("mob_e_fla_active") >= 1)


def final_flags(df: DataFrame) -> DataFrame:
    """Last overrides; every expression reads the *input* columns."""
    c = F.col
    churner = c("mob_s_fla_churn") == L.MOB_CHURNER
    null_last = c("mob_s_fla_movement") == L.NULL_LAST_DAY
    out = {
        "mob_b_fla_active": F.when(~c("_clean") & null_last, 0).otherwise(c("mob_b_fla_active")),
        "mob_e_fla_active": F.when(churner, 0).otherwise(c("mob_e_fla_active")),
        "mob_b_mes_MRC": F.when(~F.isnan("mob_b_mes_MRC"), c("mob_b_mes_MRC")),
        "mob_e_mes_rgus": F.when(churner, 0).otherwise(c("mob_e_mes_rgus")),
        "mob_s_fla_movement": F.when(churner, L.NULL_LAST_DAY).otherwise(c("mob_s_fla_movement")),
        "mob_s_fla_SpinMovement": F.when(churner, L.MOBILE_SPIN[3]).otherwise(c("mob_s_fla_SpinMovement")),
        "mob_s_fla_churn": F.when(null_last & (c("mob_s_fla_churn") == L.MOB_NONCHURNER), L.MOB_CHURNER)
                            .otherwise(c("mob_s_fla_churn")),
        "mob_s_dim_churn_type": F.when(null_last & c("mob_s_dim_churn_type").isNull(), L.MOB_VOLUNTARY)
                                 .otherwise(c("mob_s_dim_churn_type")),
        "mob_s_fla_rejoiner_month": C.flag((c("mob_b_fla_active") == 0) & (c("mob_e_fla_active") == 1)
                                           & c("_rejoin")),
    }
    return df.select([out[n].alias(n) if n in out else c(n) for n in MOBILE_COLUMNS])


def quick_check(mobile: DataFrame) -> DataFrame:
    """Accounts by flags (the source's commented check, kept with its swapped
    aliases: ``EOM_RGUs`` counts opening-active accounts)."""
    dims = ["mob_s_dim_month", "mob_b_fla_active", "mob_e_fla_active", "mob_s_fla_movement",
            "mob_s_fla_SpinMovement", "mob_s_fla_churn", "mob_s_dim_churn_type"]
    from churnwise.operators.rollup import distinct_flag_rollup
    flags = {
        "accounts": F.col(ACCOUNT),
        "EOM_RGUs": F.when(F.col("mob_b_fla_active") == 1, F.col(ACCOUNT)),
        "BOM_RGUs": F.when(F.col("mob_e_fla_active") == 1, F.col(ACCOUNT)),
    }
    return distinct_flag_rollup(mobile, dims, ACCOUNT, flags)
