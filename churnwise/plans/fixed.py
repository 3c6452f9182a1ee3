"""Fixed-line monthly table: opening/closing base, movements, voluntary and
involuntary churn, rejoiners, early-disconnect/migration flags, 0P churn and
transfers, for one month.

Plan shape (why it scales):

* The daily snapshot is scanned three times: over the whole window for a
  single ``groupBy(account, month)`` aggregation (partial aggregation before
  the shuffle, so a hot account costs one row per map task), on two days for
  the subsidy flags, and on the three day-1 partitions that form the
  opening/closing bases. The day-1 rows with their per-account inputs, and
  the base of the month, are written once and read by every branch.
* Every ``first_value(...) OVER (... ORDER BY dt DESC)`` of the source logic
  is a ``max_by(value, dt)`` in that aggregation; the month-end and last-three-
  days involuntary tests are conditional aggregates, so no daily row is joined
  back to a per-account table.
* All joins of the base are on (account, month), so the joined table keeps
  one hash partitioning and only the (small) right sides move; the
  single-valued per-account facts (rejoiner, order reasons, 0P, transfers)
  arrive in one join. ``label_months`` labels any number of months at once
  (see ``plans.months``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnwise.functions import columns as C
from churnwise.functions import labels as L
from churnwise.operators.existence import with_memberships
from churnwise.operators.materialize import materialize
from churnwise.params import RunParams, add_months

ACCOUNT = "fix_s_att_account"
MONTH = "fix_s_dim_month"

# The columns of the fixed table, in order (the stage-table
# contract read by the converged base).
FIXED_COLUMNS = [
    "fix_s_dim_month", "fix_s_att_account", "fix_b_fla_active", "fix_e_fla_active",
    "fix_s_att_contact_phone1", "fix_s_att_contact_phone2",
    "fix_b_dim_date", "fix_b_mes_outstage", "fix_b_dim_max_start", "fix_b_fla_tenure", "fix_b_mes_mrc",
    "fix_b_fla_tech_type", "fix_b_fla_fmc", "fix_b_mes_num_rgus", "fix_b_att_mix_name_adj",
    "fix_b_dim_mix_code_adj", "fix_b_fla_bb_rgu", "fix_b_fla_tv_rgu", "fix_b_fla_vo_rgu",
    "fix_b_dim_bb_code", "fix_b_dim_tv_code", "fix_b_dim_vo_code", "fix_b_fla_subsidized", "fix_b_att_BillCode",
    "fix_e_dim_date", "fix_e_mes_outstage", "fix_e_dim_max_start", "fix_e_fla_tenure", "fix_e_mes_mrc",
    "fix_e_fla_tech_type", "fix_e_fla_fmc", "fix_e_mes_num_rgus", "fix_e_att_mix_name_adj",
    "fix_e_fla_MixCodeAdj", "fix_e_dim_bb_rgu", "fix_e_dim_tv_rgu", "fix_e_dim_vo_rgu",
    "fix_e_dim_bb_code", "fix_e_dim_tv_code", "fix_e_dim_vo_code", "fix_e_fla_subsidized", "fix_e_att_BillCode",
    "fix_s_fla_main_movement", "fix_s_fla_spin_movement", "fix_s_fla_ChurnFlag", "fix_s_fla_churn_type",
    "fix_s_fla_final_churn", "fix_s_fla_Rejoiner",
]


#: What the opening/closing base reads of a day-1 row, besides its date.
DAY_ONE_COLUMNS = ["sub_acct_no_sbb", "home_phone_sbb", "bus_phone_sbb", "drop_type", "hsd", "video", "voice", "video_chrg",
                   "hsd_chrg", "voice_chrg", "delinquency_days", "welcome_offer", "joint_customer", "bill_code"]


# ----------------------------------------------------------------------------
# Scans of the daily snapshot
# ----------------------------------------------------------------------------

def snapshot_window(snapshot: DataFrame, p: RunParams) -> DataFrame:
    """Rows of the run window (partition-prunable range on ``dt``)."""
    lo, hi = p.snapshot_window
    return snapshot.where(F.col("dt").between(F.lit(lo), F.lit(hi)))


def account_month_summary(snapshot: DataFrame, p: RunParams) -> DataFrame:
    """One row per (account, month) of the window with every per-month fact
    the fixed logic needs, from one aggregation pass.

    ``main`` rows are residential rows with a product (play type not 0P); the
    source logic's working set. ``ok`` rows are main rows not yet at the
    disconnect threshold.
    """
    res = snapshot_window(snapshot, p).where(F.col("cust_typ_sbb") == "RES")
    return res.groupBy(F.col("sub_acct_no_sbb").alias(ACCOUNT), F.trunc("dt", "month").alias("month")).agg(*month_facts(p))


def month_facts(p: RunParams, counts: Column | None = None) -> list[Column]:
    """The aggregates of ``account_month_summary``, over the rows for which
    ``counts`` holds (all, if not given)."""
    thr = p.overdue_days
    dt, ovd = F.col("dt"), F.col("delinquency_days")
    main, none = F.col("play_type") != L.PLAY_NONE, F.col("play_type") == L.PLAY_NONE
    if counts is not None:
        main, none = main & counts, none & counts
    ok = main & ((ovd <= thr) | ovd.isNull())
    at_end = dt == F.last_day(dt)
    before_end = dt == F.date_sub(F.last_day(dt), 1)
    mdt = F.when(main, dt)
    # the mix as a small number: a text value would make the aggregation buffer
    # of variable width, and Spark would sort the whole snapshot for it
    mix = C.mix_number("hsd", "video", "voice")
    return [
        F.max(mdt).alias("last_dt"),                                   # last record of the month
        F.max_by(ovd, mdt).alias("last_overdue"),                      # overdue on that record
        F.max_by(F.to_date("connect_dte_sbb"), mdt).alias("last_connect"),
        F.max(F.when(ok, dt)).alias("last_ok_dt"),                     # last record under the threshold
        F.max_by(mix, F.when(ok, dt)).alias("last_mix"),               # its product mix
        F.max(F.when(main & at_end, 1)).alias("has_month_end"),
        F.max(F.when(main & at_end & (ovd < thr), 1)).alias("ok_at_end"),
        F.max(F.when(main & before_end & (ovd < thr), 1)).alias("ok_before_end"),
        F.max(F.when(main & (ovd >= thr), dt)).alias("last_over_dt"),  # last record at/over threshold
        F.max(F.when(none, 1)).alias("seen_0p"),
    ]


def account_facts(summary: DataFrame) -> DataFrame:
    """Per account: the connect date on its latest record of the window."""
    return (summary.where(F.col("last_dt").isNotNull())
            .groupBy(ACCOUNT)
            .agg(F.max_by("last_connect", "last_dt").alias("max_start")))


def subsidized_flags(snapshot: DataFrame, p: RunParams) -> DataFrame:
    """Accounts flagged ``acp = 'X'`` on the first day of M-1 (opening flag)
    and of M (closing flag); one scan of two day partitions."""
    prev, cur = p.prev_month, p.month
    rows = snapshot.where(F.col("dt").isin(prev, cur) & (F.col("acp") == "X"))
    return rows.groupBy(F.col("sub_acct_no_sbb").alias(ACCOUNT)).agg(
        F.max(F.when(F.col("dt") == F.lit(prev), 1)).alias("_sub_b"),
        F.max(F.when(F.col("dt") == F.lit(cur), 1)).alias("_sub_e"))


def day_one_rows(snapshot: DataFrame, days) -> DataFrame:
    """Residential product rows on the given first-of-month days."""
    return snapshot.where(F.col("dt").isin(*days) & (F.col("play_type") != L.PLAY_NONE)
                          & (F.col("cust_typ_sbb") == "RES"))


# ----------------------------------------------------------------------------
# Opening / closing base (OP-01)
# ----------------------------------------------------------------------------

def _base_side(rows: DataFrame, side: str, p: RunParams) -> DataFrame:
    """Project day-1 rows into opening (``b``) or closing (``e``) columns."""
    a = F.col("sub_acct_no_sbb")
    bb, tv, vo = F.col("hsd"), F.col("video"), F.col("voice")
    dt = F.col("dt")
    b = side == "b"
    names = {  # opening and closing columns carry different suffixes
        "mix_code": "fix_b_dim_mix_code_adj" if b else "fix_e_fla_MixCodeAdj",
        "rgu": "fix_b_fla_{}_rgu" if b else "fix_e_dim_{}_rgu",
    }
    return rows.select(
        a.alias(ACCOUNT),
        F.col("_month").alias(MONTH),
        F.lit(1).alias(f"_{side}"),
        dt.alias(f"fix_{side}_dim_date"),
        F.col("home_phone_sbb").alias(f"_{side}_phone1"),
        F.col("bus_phone_sbb").alias(f"_{side}_phone2"),
        C.tech_type("drop_type").alias(f"fix_{side}_fla_tech_type"),
        C.mix_code(bb, tv, vo).alias(names["mix_code"]),
        C.mix_name(bb, tv, vo).alias(f"fix_{side}_att_mix_name_adj"),
        F.lit(0).alias(f"fix_{side}_dim_bb_code"),
        F.lit(0).alias(f"fix_{side}_dim_tv_code"),
        F.lit(0).alias(f"fix_{side}_dim_vo_code"),
        F.when(bb == 1, a).alias(names["rgu"].format("bb")),
        F.when(tv == 1, a).alias(names["rgu"].format("tv")),
        F.when(vo == 1, a).alias(names["rgu"].format("vo")),
        (bb + tv + vo).alias(f"fix_{side}_mes_num_rgus"),
        (F.col("video_chrg") + F.col("hsd_chrg") + F.col("voice_chrg")).alias(f"fix_{side}_mes_mrc"),
        F.col("delinquency_days").alias(f"fix_{side}_mes_outstage"),
        F.col("max_start").alias(f"fix_{side}_dim_max_start"),
        C.tenure_band("max_start", dt, p.tenure_early, p.tenure_mid).alias(f"fix_{side}_fla_tenure"),
        C.fixed_fmc_hint("welcome_offer", "joint_customer").alias(f"fix_{side}_fla_fmc"),
        F.coalesce(F.col(f"_sub_{side}"), F.lit(0)).alias(f"fix_{side}_fla_subsidized"),
        F.col("bill_code").alias(f"fix_{side}_att_BillCode"),
    )


def _phone(a: str, b: str) -> Column:
    ok = lambda c: F.col(c).isNotNull() & (F.col(c) != 0)
    return F.when(ok(a), F.col(a)).when(ok(b), F.col(b))


def customer_status(open_rows: DataFrame, close_rows: DataFrame, p: RunParams) -> DataFrame:
    """Opening rows (overdue <= threshold or NULL) full-outer-joined with
    closing rows (overdue < threshold or NULL) on account and month."""
    thr = p.overdue_days
    ovd = F.col("delinquency_days")
    bom = _base_side(open_rows.where((ovd <= thr) | ovd.isNull()), "b", p)
    eom = _base_side(close_rows.where((ovd < thr) | ovd.isNull()), "e", p)
    st = bom.join(eom, [ACCOUNT, MONTH], "full_outer")
    return st.select(
        MONTH, ACCOUNT,
        F.coalesce("_b", F.lit(0)).alias("fix_b_fla_active"),
        F.coalesce("_e", F.lit(0)).alias("fix_e_fla_active"),
        _phone("_b_phone1", "_e_phone1").alias("fix_s_att_contact_phone1"),
        _phone("_b_phone2", "_e_phone2").alias("fix_s_att_contact_phone2"),
        *[c for c in FIXED_COLUMNS[6:42]],
    )


def with_movements(status: DataFrame) -> DataFrame:
    mv = C.fixed_movement("fix_b_mes_num_rgus", "fix_e_mes_num_rgus", "fix_e_dim_max_start", MONTH)
    return (status.withColumn("fix_s_fla_main_movement", mv)
            .withColumn("fix_s_fla_spin_movement",
                        C.fixed_spin("fix_s_fla_main_movement", "fix_b_mes_mrc", "fix_e_mes_mrc")))


# ----------------------------------------------------------------------------
# Churn populations
# ----------------------------------------------------------------------------

def disconnect_orders(orders: DataFrame, months) -> DataFrame:
    """Completed residential disconnect orders completed in ``months``, with
    the reason class and the number of products each order removes."""
    lo, hi = min(months), max(months)
    end = F.to_date("completed_date")
    dx = (F.when(F.col("cease_reason_desc") == L.DX_MIGRATION_REASON, L.DX_MIGRATION)
          .when(F.col("cease_reason_desc") == L.DX_NONPAY_REASON, L.DX_INVOLUNTARY)
          .otherwise(L.DX_VOLUNTARY))
    units = sum(C.flag(F.col(c) > 0) for c in ("lob_vo_count", "lob_bb_count", "lob_tv_count"))
    return (orders.where((F.col("order_type") == L.DISCONNECT) & (F.col("account_type") == "RES")
                         & (F.col("order_status") == "COMPLETE")
                         & (end >= F.lit(lo)) & (end < F.lit(add_months(hi, 1))))
            .select(F.col("account_id").alias(ACCOUNT), F.trunc(end, "month").alias("month"),
                    dx.alias("dx_type"), units.alias("units")))


def voluntary_churners(status: DataFrame, orders: DataFrame, summary: DataFrame) -> DataFrame:
    """(month, account, churn type) of voluntary churners (OP-08).

    Churned units per reason class are compared with the units on the last
    record under the threshold; an account still active with fewer units is
    a partial churn and is left out. The churn type is only set when the
    account is not active at closing.
    """
    per_reason = orders.groupBy(ACCOUNT, "month", "dx_type").agg(F.sum("units").alias("churned"))
    most = per_reason.groupBy(ACCOUNT, "month").agg(F.max("churned").alias("churned"))
    last = (summary.where(F.col("last_ok_dt").isNotNull())
            .select(ACCOUNT, "month", C.mix_number_units("last_mix").alias("last_units")))
    vol = most.join(last, [ACCOUNT, "month"]).where(F.col("churned") >= F.col("last_units"))
    st = status.select(F.col(MONTH).alias("month"), ACCOUNT, "fix_b_mes_num_rgus", "fix_e_fla_active")
    partial = (F.col("fix_e_fla_active") == 1) & (F.col("fix_b_mes_num_rgus") > F.col("last_units"))
    return (st.join(vol, [ACCOUNT, "month"])
            .where(~F.coalesce(partial, F.lit(False)))
            .select("month", ACCOUNT,
                    F.when(F.col("fix_e_fla_active") == 0, L.FIX_VOLUNTARY).alias("churn_type")))


def involuntary_churners(summary: DataFrame, p: RunParams) -> DataFrame:
    """(month, account, churn type) of involuntary churners (OP-09): under the
    threshold on the last day of the previous month or the day before it, at
    or over it on one of the last three record days of the month, and at or
    over it on the month's last record."""
    prev = summary.select(ACCOUNT, F.add_months("month", 1).alias("month"),
                          ((F.col("has_month_end") == 1)
                           & F.coalesce((F.col("ok_at_end") == 1) | (F.col("ok_before_end") == 1), F.lit(False))
                           ).alias("was_ok"))
    cur = summary.where((F.col("last_over_dt") >= F.date_sub("last_dt", 2))
                        & (F.col("last_overdue") >= p.overdue_days))
    return (cur.join(prev.where("was_ok"), [ACCOUNT, "month"])
            .select("month", ACCOUNT, F.lit(L.FIX_INVOLUNTARY).alias("churn_type")))


# ----------------------------------------------------------------------------
# The monthly table
# ----------------------------------------------------------------------------

def fixed_table(src, p: RunParams, summary: DataFrame | None = None) -> DataFrame:
    """Fixed table for month ``p.month`` (rows active at opening or closing)."""
    snap = src.daily_snapshot()
    M, prev, nxt = p.month, p.prev_month, p.next_month
    # one pass over the snapshot window, read by the branches below
    summary = summary if summary is not None else materialize(account_month_summary(snap, p), "account_month")
    day1 = materialize(day_one_rows(snap, (prev, M, nxt)).select("dt", *DAY_ONE_COLUMNS).join(
        per_account_inputs(summary, snap, p).withColumnRenamed(ACCOUNT, "sub_acct_no_sbb"), "sub_acct_no_sbb", "left"), "day_one")
    # opening row of month m is its first day; closing row is the first day of m+1
    opening = day1.where(F.col("dt").isin(prev, M)).withColumn("_month", F.col("dt"))
    closing = day1.where(F.col("dt").isin(M, nxt)).withColumn("_month", F.add_months("dt", -1))
    # of M-1 only those count that left the base; repeated day-1 rows count once
    left_prev = (F.col(MONTH) == F.lit(prev)) & (F.col("fix_b_fla_active") == 1) & (F.col("fix_e_fla_active") == 0)
    status_all = materialize(customer_status(opening, closing, p)
                             .where((F.col(MONTH) == F.lit(M)) | left_prev).distinct(), "status")
    status = with_movements(status_all.where(F.col(MONTH) == F.lit(M)))

    return label_months(status, status_all.where(F.col(MONTH) == F.lit(prev)), src.service_orders(), summary, (M,), p)


def label_months(status: DataFrame, leavers: DataFrame, service_orders: DataFrame, summary: DataFrame, months,
                 p: RunParams) -> DataFrame:
    """Churners, overrides and final flags of the base of the given months.

    ``leavers``: (month, account) that left the base in the month before one of
    them. ``summary``: the months of ``account_month_summary`` and those before
    them, whole. Every join is on (account, month), so the months do not meet."""
    months = tuple(months)
    of = F.col("month").isin(*months)
    # churn populations of a month (an account in both keeps two rows)
    orders = disconnect_orders(service_orders, months).where(of)
    before = tuple({add_months(m, -1) for m in months} | set(months))
    vol = voluntary_churners(status, orders, summary.where(of))
    invol = involuntary_churners(summary.where(F.col("month").isin(*before)), p).where(of)
    churners = (vol.unionByName(invol).distinct()
                .select(F.col("month").alias(MONTH), ACCOUNT, "churn_type", F.lit(1).alias("_churner")))
    mv = F.col("fix_s_fla_main_movement")
    flagged = status.join(churners, [ACCOUNT, MONTH], "left").select(
        *status.columns,
        F.when(F.col("_churner").isNotNull() & (mv == L.NULL_LAST_DAY), L.FIX_CHURNER)
         .otherwise(L.FIX_NONCHURNER).alias("fix_s_fla_ChurnFlag"),
        F.when(F.col("_churner").isNotNull(), F.col("churn_type")).alias("fix_s_fla_churn_type"))

    # every single-valued per-account fact of a month, attached with one join:
    # left the base the month before (rejoiners), disconnect-order reason
    # classes, seen with no product (0P) and completed relocation orders
    dx = F.col("dx_type")
    dx_of = lambda cond: orders.where(cond).withColumnRenamed("month", MONTH)
    moved = F.trunc(F.to_date("dt"), "month")
    flagged = with_memberships(flagged, {
        "_left_prev": leavers.withColumn(MONTH, F.add_months(MONTH, 1)),
        "_inv": dx_of(dx == L.DX_INVOLUNTARY),
        "_mig": dx_of(dx == L.DX_MIGRATION),
        "_oth": dx_of(~dx.isin(L.DX_INVOLUNTARY, L.DX_MIGRATION)),
        "_0p": summary.where(of & (F.col("seen_0p") == 1)).withColumnRenamed("month", MONTH),
        "_transfer": service_orders.where((F.trim("order_type") == L.RELOCATION) & (F.col("account_type") == "RES")
                                          & (F.col("order_status") == "COMPLETE")
                                          & (F.to_date("dt") >= F.lit(min(months)))
                                          & (F.to_date("dt") < F.lit(add_months(max(months), 1))))
                                   .select(F.col("account_id").alias(ACCOUNT), moved.alias(MONTH)),
    }, [ACCOUNT, MONTH])
    flagged = flagged.withColumn("fix_s_fla_Rejoiner", C.flag(F.col("_left_prev") & (mv == L.COME_BACK)))

    # early-disconnect / migration flags: one row per distinct flag pair over
    # the account's disconnect orders of M (one (0, 0) row when it has none)
    churned_now = (F.col("fix_s_fla_ChurnFlag") == L.FIX_CHURNER) & (F.col("fix_e_fla_active") == 0)
    inv, mig, oth = F.col("_inv"), F.col("_mig"), F.col("_oth")
    pair = lambda e, m: F.struct(F.lit(e).alias("early_dx_flag"), F.lit(m).alias("migrt_flag"))
    pairs = F.filter(F.array(
        F.when(churned_now & inv, pair(1, 0)),
        F.when(churned_now & mig, pair(0, 1)),
        F.when(oth | ~(inv | mig | oth) | (~churned_now & (inv | mig)), pair(0, 0)),
    ), lambda x: x.isNotNull())
    flagged = (flagged.withColumn("_pair", F.explode(pairs))
               .withColumn("Gap", F.when((F.col("fix_s_fla_ChurnFlag") == L.FIX_NONCHURNER)
                                         & (F.col("fix_e_fla_active") == 0), L.CHURNER_GAP))
               .withColumn("early_dx_flag", F.col("_pair.early_dx_flag"))
               .withColumn("migrt_flag", F.col("_pair.migrt_flag"))
               .withColumn("churn0p", F.when(F.col("fix_b_dim_mix_code_adj").isNotNull() & F.col("_0p"),
                                             L.CHURNER_0P)))
    return final_flags(flagged).where(F.col("fix_b_fla_active") + F.col("fix_e_fla_active") >= 1)


def per_account_inputs(summary: DataFrame, snapshot: DataFrame, p: RunParams) -> DataFrame:
    """Connect date on the latest record and the two subsidy flags, one row
    per account (two sources collapsed by one aggregation, joined once)."""
    acct = account_facts(summary).select(ACCOUNT, "max_start", F.lit(None).cast("int").alias("_sub_b"),
                                         F.lit(None).cast("int").alias("_sub_e"))
    subs = subsidized_flags(snapshot, p).select(ACCOUNT, F.lit(None).cast("date").alias("max_start"),
                                                "_sub_b", "_sub_e")
    return acct.unionByName(subs).groupBy(ACCOUNT).agg(
        F.max("max_start").alias("max_start"), F.max("_sub_b").alias("_sub_b"), F.max("_sub_e").alias("_sub_e"))


def final_flags(df: DataFrame) -> DataFrame:
    """Last overrides; every expression reads the *input* columns."""
    c = F.col
    invol = c("fix_s_fla_churn_type") == L.FIX_INVOLUNTARY
    mv, ctype, cflag = c("fix_s_fla_main_movement"), c("fix_s_fla_churn_type"), c("fix_s_fla_ChurnFlag")
    b_on, e_off = c("fix_b_fla_active") == 1, c("fix_e_fla_active") == 0
    early, migr = c("early_dx_flag") == 1, c("migrt_flag") == 1
    zero_p = c("churn0p") == L.CHURNER_0P
    out = {
        "fix_e_fla_active": F.when(invol, 0).otherwise(c("fix_e_fla_active")),
        "fix_s_att_contact_phone2": F.when(c("fix_s_att_contact_phone2") > 100, c("fix_s_att_contact_phone2")),
        "fix_e_mes_num_rgus": F.when(invol, 0).otherwise(c("fix_e_mes_num_rgus")),
        "fix_s_fla_main_movement": F.when(invol, L.NULL_LAST_DAY)
                                    .when(c("_transfer") & mv.isin(L.NEW_CUSTOMER, L.COME_BACK), L.TRANSFER_ADDS)
                                    .otherwise(mv),
        "fix_s_fla_spin_movement": F.when(ctype.isNotNull(), L.FIXED_SPIN[2]).otherwise(c("fix_s_fla_spin_movement")),
        "fix_s_fla_ChurnFlag": F.when(c("early_dx_flag") + c("migrt_flag") >= 1, L.FIX_CHURNER)
                                .when((cflag == L.FIX_NONCHURNER) & b_on & e_off, L.FIX_CHURNER)
                                .when(ctype.isNotNull(), L.FIX_CHURNER).otherwise(cflag),
        "fix_s_fla_churn_type": F.when((mv == L.NULL_LAST_DAY) & ctype.isNull(), L.FIX_TRANSFER)
                                 .when(early, L.FIX_INVOLUNTARY).when(migr, L.FIX_VOLUNTARY)
                                 .when((cflag == L.FIX_CHURNER) & b_on & e_off & zero_p, L.FIX_0P)
                                 .otherwise(ctype),
        "fix_s_fla_final_churn": F.when((mv == L.NULL_LAST_DAY) & ctype.isNull(), L.FIX_FINAL[0])
                                  .when(early, L.FIX_FINAL[1]).when(migr, L.FIX_FINAL[2])
                                  .when(ctype == L.FIX_VOLUNTARY, L.FIX_FINAL[3])
                                  .when(ctype == L.FIX_INVOLUNTARY, L.FIX_FINAL[4])
                                  .when((cflag == L.FIX_NONCHURNER) & b_on & e_off & zero_p, L.FIX_FINAL[5]),
    }
    return df.select([out[n].alias(n) if n in out else c(n) for n in FIXED_COLUMNS])


def fixed_movement_counts(fixed_status: DataFrame) -> DataFrame:
    """Minimum slice: accounts per main movement."""
    return (fixed_status.groupBy("fix_s_fla_main_movement")
            .agg(F.count(F.lit(1)).alias("accounts"),
                 F.sum("fix_b_fla_active").cast("long").alias("opening_active"),
                 F.sum("fix_e_fla_active").cast("long").alias("closing_active")))


def fixed_status_month(src, p: RunParams) -> DataFrame:
    """Opening/closing base of month M with movement and spin."""
    snap = src.daily_snapshot()
    summary = account_month_summary(snap, p)
    day1 = day_one_rows(snap, (p.month, p.next_month)).join(
        per_account_inputs(summary, snap, p).withColumnRenamed(ACCOUNT, "sub_acct_no_sbb"), "sub_acct_no_sbb", "left")
    opening = day1.where(F.col("dt") == F.lit(p.month)).withColumn("_month", F.col("dt"))
    closing = day1.where(F.col("dt") == F.lit(p.next_month)).withColumn("_month", F.add_months("dt", -1))
    return with_movements(customer_status(opening, closing, p))
