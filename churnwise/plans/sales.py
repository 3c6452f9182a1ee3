"""Sales operational drivers: new customers of the month and, for them,
never-paid flags over the first bill cycle, early tech tickets and slow
installs, rolled up by closing segment (OP-16 .. OP-20).

Plan shape: every per-account fact is one ``groupBy(account)`` over the rows
that feed it (snapshot rows of new customers, payments in the bill window,
de-duplicated interactions), so fan-out joins of the source logic (each
snapshot day times each interaction) never materialise; the final report is
a two-level distinct-count rollup.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnwise.functions import columns as C
from churnwise.functions import labels as L
from churnwise.operators.bands import band_join
from churnwise.operators.dictionary import label_texts
from churnwise.operators.existence import with_memberships
from churnwise.operators.materialize import materialize
from churnwise.operators.rollup import distinct_flag_rollup
from churnwise.operators.state import KeptState
from churnwise.params import RunParams

ACCOUNT = "fix_s_att_account"


def _ts(d: _dt.date):
    """Midnight of ``d`` as a timestamp in the session time zone (the same
    conversion Spark applies to the data, whatever the zone)."""
    return F.lit(d).cast("timestamp")


def _residential(snapshot: DataFrame) -> DataFrame:
    return snapshot.where((F.col("play_type") != L.PLAY_NONE) & (F.col("cust_typ_sbb") == "RES"))


#: What is kept of an account, for each connect date that its rows name: the bill
#: on the first of them, and the first and last day.
CUSTOMER_STATE = KeptState(keys=("account", "connected"), order="dt",
                           first={"first_bill": "bill_from_dte_sbb"}, last={"last_overdue": "delinquency_days"})


def customer_days(snapshot: DataFrame) -> DataFrame:
    """The residential snapshot rows that CUSTOMER_STATE folds."""
    return _residential(snapshot).select(
        F.col("sub_acct_no_sbb").alias("account"), F.to_date("connect_dte_sbb").alias("connected"), "dt",
        "bill_from_dte_sbb", "delinquency_days")


def new_customers(state: DataFrame, p: RunParams) -> DataFrame:
    """Accounts whose connect date, as of their latest row, lies in month M,
    from CUSTOMER_STATE: their first bill, and the first day they were seen."""
    lo, hi = p.shift(-3), p.next_month
    rows = state.where((F.col("connected") >= F.lit(lo)) & (F.col("connected") < F.lit(hi)))
    per_acct = rows.groupBy(F.col("account").alias(ACCOUNT)).agg(
        F.max_by("connected", "last_dt").alias("fix_b_att_maxstart"),
        F.min_by("first_bill", "first_dt").alias("first_bill_created"), F.min("first_dt").alias("first_seen"))
    start = F.col("fix_b_att_maxstart")
    return (per_acct.where((start >= F.lit(p.month)) & (start < F.lit(hi)))
            .withColumn("install_month", F.trunc(start, "month")))


def new_customer_rows(snapshot: DataFrame, p: RunParams, state: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Snapshot rows (any day) of residential accounts installed in month M
    (the connect date on the account's latest such row falls in M), and one
    row per such new customer.

    The source bounds these rows by connect date only, so every snapshot day
    counts. The accounts are found first: from the kept ``state`` (then no
    history is read), else by one aggregation over four narrow columns. Their
    rows are then read from the first day any of them was seen, a bound that
    Spark takes from the written accounts when the scan starts, and written
    for the branches that read them."""
    lo, hi = p.shift(-3), p.next_month
    connect = F.col("connect_dte_sbb")
    in_window = (connect >= _ts(lo)) & (connect < _ts(hi))
    if state is None:
        state = CUSTOMER_STATE.collapse(customer_days(snapshot.where(in_window)))
    new = materialize(new_customers(state, p), "new_customers")
    rows = _residential(snapshot).where(in_window & (F.col("dt") >= new.agg(F.min("first_seen")).scalar()))
    rows = rows.select(F.col("sub_acct_no_sbb").alias(ACCOUNT), "dt", "bill_from_dte_sbb", "delinquency_days",
                       (F.col("video_chrg") + F.col("hsd_chrg") + F.col("voice_chrg")).alias("fi_tot_mrc_amt"))
    new = new.drop("first_seen")
    return materialize(rows.join(new, ACCOUNT), "new_customer_rows"), new


def first_cycle(nc_rows: DataFrame) -> DataFrame:
    """First bill cycle per new customer: first bill date, the highest MRC
    within three months of it, the highest overdue on first-bill rows. Written,
    since the bounds of the payments scan are read from it."""
    fb = F.col("first_bill_created")
    in_window = F.col("dt").between(fb, F.add_months(fb, 3))
    on_first = F.col("bill_from_dte_sbb") == fb
    agg = nc_rows.groupBy(ACCOUNT, "fix_b_att_maxstart", "first_bill_created").agg(
        F.max(F.when(in_window, F.col("fi_tot_mrc_amt"))).alias("max_mrc_first_bill"),
        F.max(F.when(in_window, 1)).alias("_in_window"),
        F.max(F.when(on_first, F.col("delinquency_days"))).alias("max_delinquency_days_first_bill"),
        F.max(F.when(on_first, 1)).alias("_on_first"))
    return materialize(agg.where((F.col("_in_window") == 1) & (F.col("_on_first") == 1)).select(
        ACCOUNT, F.col("fix_b_att_maxstart").alias("first_installation_date"), "first_bill_created",
        "max_delinquency_days_first_bill", "max_mrc_first_bill",
        F.when(F.col("max_mrc_first_bill").isNotNull(), 1).otherwise(0).cast("long").alias("diff_mrc")), "first_cycle")


def payments_in_cycle(fc: DataFrame, payments: DataFrame, p: RunParams) -> DataFrame:
    """Each new customer's payments from ``payment_lookback_days`` before the
    first bill to the end of the longest payment window after it, with
    ``days`` since the bill.

    No payment outside the windows of the least and the greatest first bill
    can qualify. Both are scalar subqueries over the written first cycles:
    where payments are partitioned by ``dt``, Spark lists only the days between
    them, and nothing passes through the driver's Python."""
    fb = F.col("first_bill_created")
    earliest = fc.agg(F.date_sub(F.min("first_bill_created"), p.payment_lookback_days)).scalar()
    latest = fc.agg(F.date_add(F.max("first_bill_created"), p.payment_days)).scalar()
    in_range = F.col("dt") >= earliest
    # a dt that is a timestamp holds times of its last day
    in_range = in_range & (F.col("dt") < F.date_add(latest, 1) if payments.schema["dt"].dataType.simpleString() != "date" else F.col("dt") <= latest)
    payments = payments.where(in_range)
    pay = payments.select(F.col("account_id").alias(ACCOUNT), F.to_date("dt").alias("pay_dt"),
                          F.col("payment_amt_usd").cast("double").alias("amt"))
    cycle = fc.select(ACCOUNT, "first_bill_created", "max_mrc_first_bill")
    both = band_join(pay, cycle, ACCOUNT, "pay_dt", F.date_sub(fb, p.payment_lookback_days), F.date_add(fb, p.payment_days))
    return both.withColumn("days", F.datediff("pay_dt", fb))


def first_cycle_payments(fc: DataFrame, payments: DataFrame, p: RunParams) -> DataFrame:
    """First and last payment of the cycle, first payment covering the MRC,
    and running totals below 30/60/85 days after the bill (payments before it
    included). Ties on a date are broken by the smaller amount."""
    covers = F.col("amt") >= F.col("max_mrc_first_bill")
    # one row per payment day first: its smallest amounts, and the day's totals
    day = payments_in_cycle(fc, payments, p).groupBy(ACCOUNT, "pay_dt", "days").agg(
        F.min("amt").alias("least"), F.min(F.when(covers, F.col("amt"))).alias("least_above"), F.sum("amt").alias("amt"))
    above = F.when(F.col("least_above").isNotNull(), F.col("pay_dt"))
    totals = [F.round(F.sum(F.when(F.col("days") < n, F.col("amt"))), 2).alias(f"total_payments_{n}_days")
              for n in p.payment_windows]
    return day.groupBy(ACCOUNT).agg(
        F.min("pay_dt").alias("first_payment_date"),
        F.min_by("least", "pay_dt").alias("first_payment_amt"),
        F.min(above).alias("first_payment_above_date"),
        F.min_by("least_above", above).alias("first_payment_above"),
        F.max("pay_dt").alias("last_pay_date"),
        *totals)


def first_cycle_mrc_values(nc_rows: DataFrame) -> DataFrame:
    """The distinct MRC values of each new customer within three months of the
    first bill (the content of the source's ordered distinct array), as rows:
    no group is collected into one value."""
    fb = F.col("first_bill_created")
    return (nc_rows.where(F.col("dt").between(fb, F.add_months(fb, 3)))
            .select(ACCOUNT, F.col("fi_tot_mrc_amt").alias("mrc")).distinct())


def first_cycle_payment_rows(fc: DataFrame, payments: DataFrame, p: RunParams) -> DataFrame:
    """Every payment of the first bill window with its day offset from the
    bill (the content of the source's date-ordered payment arrays), as rows."""
    return payments_in_cycle(fc, payments, p).select(ACCOUNT, "pay_dt", "amt", F.col("days").alias("days_from_bill"))


def never_paid(fc: DataFrame, pb: DataFrame, p: RunParams) -> DataFrame:
    """Never-paid flags: the account when nothing, or less than the first
    bill's MRC, was paid within 30/60/85 days."""
    out = fc.join(pb, ACCOUNT, "left")
    gap = F.datediff("first_payment_above_date", "first_bill_created")
    flags = []
    for n in p.payment_windows:
        t = F.col(f"total_payments_{n}_days")
        flags.append(F.when(t.isNull(), F.col(ACCOUNT)).when(t < F.col("max_mrc_first_bill"), F.col(ACCOUNT))
                     .alias(f"npn_{n}_flag"))
    return out.select("*", gap.alias("days_between_payment"),
                      F.when(F.col("first_payment_above_date").isNull(), p.payment_days + 1).otherwise(gap)
                       .alias("fixed_days_unpaid_bill"), *flags)


def _one_per_key(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, customer_id) of the row with the lowest interaction id of each
    key tuple.

    Nearly every key names one customer, which a hash aggregation of numbers
    shows; the ids, which are text, are ordered only for the keys that name
    several (written, so that Spark knows how few they are)."""
    customer = F.col("customer_id")
    per_key = rows.groupBy(*keys).agg(F.min(customer).alias("customer_id"), F.max(customer).alias("_most"),
                                      F.count(customer).alias("_named"), F.count(F.lit(1)).alias("_rows"))
    per_key = materialize(per_key, "interaction_keys")
    same = (F.col("_named") == 0) | ((F.col("_named") == F.col("_rows")) & (F.col("customer_id") == F.col("_most")))
    several = per_key.where(~same).select(*[F.col(k).alias(f"_{k}") for k in keys])
    on = None
    for k in keys:
        this = F.col(k).eqNullSafe(F.col(f"_{k}"))
        on = this if on is None else on & this
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("interaction_id").asc_nulls_last()))
    lowest = rows.join(several, on, "left_semi").withColumn("_nth", nth).where(F.col("_nth") == 1)
    return per_key.where(same).select(*keys, "customer_id").unionByName(lowest.select(*keys, "customer_id"))


def interactions_in_window(interactions: DataFrame, truckrolls: DataFrame, p: RunParams) -> DataFrame:
    """Residential interactions of months M..M+2, one per (account, date,
    channel, agent, purpose) (the lowest id is kept), typed as truck roll
    (a roll the same day), tech call (purpose patterns) or NULL."""
    lo, hi = p.month, p.shift(3)
    st = F.col("interaction_start_time")
    # a blank start time is NULL since ingest, so the range also drops it
    inter = interactions.where((st >= _ts(lo)) & (st < _ts(hi))
                               & (F.col("account_type") == "RES"))
    keys = ["account_id", "interaction_date", "interaction_channel", "interaction_agent_id",
            "interaction_purpose_descrip"]
    one = _one_per_key(inter.withColumn("interaction_date", F.to_date(st)).select(*keys, "interaction_id", "customer_id"), keys)
    ct = F.col("create_dte_ojb")
    rolls = (truckrolls.where((ct >= _ts(lo)) & (ct < _ts(hi)))
             .select(F.to_date(ct).alias("interaction_date"), F.col("sub_acct_no_sbb").alias("account_id"))
             .distinct().withColumn("_roll", F.lit(True)))
    purpose = F.col("interaction_purpose_descrip")
    kept = one.where(~purpose.isin(*L.DROPPED_PURPOSES)).join(rolls, ["interaction_date", "account_id"], "left")
    # the patterns run once a purpose
    tech = lambda t: C.lower_like_any(t, L.TECH_CALL_INCLUDE) & ~C.lower_like_any(t, L.TECH_CALL_EXCLUDE)
    kept = label_texts(kept, "interaction_purpose_descrip", {"_tech": tech})
    return kept.withColumn("interaction_type",
                           F.when(F.col("_roll"), L.TRUCKROLL).when(F.col("_tech"), L.TECH_CALL)).drop("_roll", "_tech")


def early_tickets(new: DataFrame, typed: DataFrame, p: RunParams) -> DataFrame:
    """New customers with a tech call or truck roll, and the flag for one
    within ``early_ticket_weeks`` whole weeks of the install (earlier ones
    count too)."""
    first = (typed.where(F.col("interaction_type").isin(L.TECH_CALL, L.TRUCKROLL))
             .groupBy(F.col("customer_id").alias(ACCOUNT)).agg(F.min("interaction_date").alias("first_ticket_date")))
    weeks = F.expr("timestampdiff(WEEK, fix_b_att_maxstart, first_ticket_date)")
    return (new.select(ACCOUNT, "install_month", "fix_b_att_maxstart").join(first, ACCOUNT)
            .withColumn("early_ticket_flag", F.when(weeks <= p.early_ticket_weeks, F.col(ACCOUNT))))


def slow_installs(new: DataFrame, order_lines: DataFrame, p: RunParams) -> DataFrame:
    """New customers with their completed connect orders; the flag marks an
    install that took more than ``slow_install_days`` days."""
    if p.install_org is None:
        raise ValueError("RunParams.install_org: the organisation code of install orders is required")
    inst = order_lines.where((F.col("org_id") == p.install_org) & (F.col("org_cntry") == p.install_country)
                             & (F.col("order_status") == "COMPLETE") & (F.col("command_id") == L.INSTALL_COMMAND))
    inst = inst.select(F.col("account_id").alias(ACCOUNT), F.to_date("order_start_date").alias("order_start_date"),
                       F.to_date("completed_date").alias("completed_date"))
    out = new.select(ACCOUNT, "fix_b_att_maxstart", F.col(ACCOUNT).alias("new_sales_flag"), "install_month")
    # the result is distinct, so equal (start, completed) days of one account count
    # once before the join: an account with very many order lines is no hot key
    out = out.join(inst.distinct(), ACCOUNT, "left")
    slow = F.datediff("completed_date", "order_start_date") > p.slow_install_days
    return out.withColumn("outlier_install_flag", F.when(slow, F.col(ACCOUNT))).distinct()


def sales_drivers(fmc: DataFrame, snapshot: DataFrame, interactions: DataFrame, truckrolls: DataFrame,
                  payments: DataFrame, p: RunParams) -> DataFrame:
    """Report by closing tech, segment, FMC type and tenure: active base,
    accounts, sales, never-paid at 30/60/85 days, early tickets."""
    M = F.lit(p.month)
    base = fmc.where((F.col("fmc_s_dim_month") == M) & (F.col("dt") == M) & F.col(ACCOUNT).isNotNull())
    nc_rows, new = new_customer_rows(snapshot, p)
    fc = materialize(first_cycle(nc_rows), "first_cycle")
    npn = never_paid(fc, first_cycle_payments(fc, payments, p), p)
    early = early_tickets(new, interactions_in_window(interactions, truckrolls, p), p)
    # every flag is the account or NULL: attach them as set memberships, one join
    acct = F.col(ACCOUNT)
    sets = {"_new": new.select(ACCOUNT),
            "_early": early.where(F.col("early_ticket_flag").isNotNull()).select(ACCOUNT)}
    # one never-paid branch for all windows: its rows name the windows they fail
    unpaid = F.filter(F.array(*[F.when(F.col(f"npn_{n}_flag").isNotNull(), F.lit(f"_npn{n}"))
                                for n in p.payment_windows]), lambda x: x.isNotNull())
    windows = [f"_npn{n}" for n in p.payment_windows]
    rows = with_memberships(
        base.where((F.col("fmc_s_fla_churnflag") != "Fixed Churner")
                   & ~F.col("fmc_s_fla_waterfall").isin(*L.SALES_EXCLUDED_WATERFALL)
                   & (F.col("fix_s_fla_mainmovement") != L.NULL_LAST_DAY)), sets, ACCOUNT,
        tagged=(npn.select(ACCOUNT, F.explode(unpaid).alias("_set")), windows))
    dims = {"opd_s_dim_month": "fmc_s_dim_month", "opd_e_fla_final_tech": "fmc_e_fla_tech",
            "opd_e_fla_opd_segment": "fmc_e_fla_fmcsegment", "opd_e_fla_opd_type": "fmc_e_fla_fmc",
            "opd_e_fla_final_tenure": "fmc_e_fla_tenure"}
    rows = rows.select(*[F.col(v).alias(k) for k, v in dims.items()], ACCOUNT, "fix_e_att_active", *sets, *windows)
    counts = {
        "opd_s_mes_active_base": F.when(F.col("fix_e_att_active") == 1, acct),
        "opd_s_mes_soft_dx": acct,
        "opd_s_mes_sales": F.when(F.col("_new"), acct),
        **{f"opd_s_mes_never_paid_{n}_days": F.when(F.col(f"_npn{n}"), acct) for n in p.payment_windows},
        "opd_s_mes_uni_early_tickets": F.when(F.col("_early"), acct),
    }
    out = distinct_flag_rollup(rows, list(dims), ACCOUNT, counts)
    return out.orderBy(*[F.col(k).asc_nulls_last() for k in dims])
