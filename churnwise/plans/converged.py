"""Converged (fixed + mobile) customer base with FMC type, segment, churn
labels and the month-over-month waterfall (OP-13 .. OP-15).

Plan shape: links are found with one equi-join of narrow phone rows, ranked
with one ``WindowGroupLimit`` top-k window, and written once. The prepaid test
is collapsed to two flags an account on narrow rows. The wide rows are then
joined once, by a full outer join on the link; fixed accounts without a link
carry a key of their own in it, so they spread over all partitions, and the
duplicate rank reuses the join's partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnwise.functions import columns as C
from churnwise.functions import labels as L
from churnwise.operators.links import best_links, candidate_links
from churnwise.operators.materialize import materialize
from churnwise.params import RunParams
from churnwise.plans.fixed import FIXED_COLUMNS
from churnwise.plans.contracts import MOBILE_TO_CONVERGED

MOBILE_CONVERGED_COLUMNS = [v for k, v in MOBILE_TO_CONVERGED.items() if k != "mob_s_dim_month"]

CONVERGED_COLUMNS = (
    ["fmc_s_dim_month", "fmc_s_att_account", "fmc_b_att_active", "fmc_e_att_active"]
    + [c for c in FIXED_COLUMNS if c != "fix_s_dim_month"][:1] + FIXED_COLUMNS[2:]
    + MOBILE_CONVERGED_COLUMNS
    + ["mob_s_att_duplicates", "fmc_b_fla_final_tenure", "fmc_e_fla_final_tenure", "fmc_b_mes_total_rgus",
       "fmc_e_mes_total_rgus", "fmc_b_mes_total_mrc", "fmc_e_mes_total_mrc", "fmc_b_fla_fmc_type",
       "fmc_e_fla_fmc_type", "fmc_b_fla_fmc_typesegment", "fmc_e_fla_fmc_typesegment", "fmc_b_fla_final_tech",
       "fmc_e_fla_final_tech", "fmc_s_fla_Rejoiner", "fmc_s_fla_final_churn", "fmc_s_fla_final_churn_type",
       "fmc_s_fla_partial_churn", "fmc_s_fla_waterfall"]
)


# Columns that can differ between two rows of one fixed account (the fixed
# table keeps one row per churn population and per early-disconnect flag set);
# they order such rows deterministically when one must be chosen.
FIXED_TIE_BREAK = ["fix_e_fla_active", "fix_e_mes_num_rgus", "fix_s_fla_main_movement", "fix_s_fla_spin_movement",
                   "fix_s_fla_ChurnFlag", "fix_s_fla_churn_type", "fix_s_fla_final_churn",
                   # a mobile subscriber has one row per cancellation of the month
                   "mob_s_fla_churntype"]


# Churn type by the reasons of the fixed and the mobile side.
CHURN_REASONS = {
    **{f"{f}/{m}": L.CHURN_TYPES[0] for f, m in (("V", "V"), ("V", ""), ("", "V"), ("T", "V"))},
    **{f"{f}/{m}": L.CHURN_TYPES[1] for f, m in (("I", "I"), ("I", ""), ("", "I"), ("T", "I"))},
    **{f"{f}/{m}": L.CHURN_TYPES[2] for f, m in (("V", "I"), ("I", "V"))},
    "0/": L.CHURN_TYPES[3], "T/": L.CHURN_TYPES[4],
}


def fixed_mobile_links(fixed: DataFrame, mobile: DataFrame, top_right: int = 2) -> DataFrame:
    """Kept (fixed account, mobile account) links: each fixed account keeps
    its highest linked mobile, if one of the pair's rows is among the first
    ``top_right`` candidate rows of that mobile."""
    cand = candidate_links(fixed, "fix_s_att_account", ["fix_s_att_contact_phone1", "fix_s_att_contact_phone2"],
                           mobile, "mob_s_att_account")
    return best_links(cand, "fix_s_att_account", "mob_s_att_account", top_right)


def _prepaid_accounts(fixed: DataFrame, prepaid: DataFrame, p: RunParams) -> DataFrame:
    """(account, _pre_b, _pre_e): whether one of the account's phones is an
    active prepaid subscriber at opening or closing. Narrow rows without NULL
    phones, collapsed to one row an account before anything wide is joined."""
    act = ((F.col("cust_sts") == "O") & (F.col("acct_type_cd") == "I") & (F.col("ba_rgn_nm") != "VI")
           & (F.col("subsrptn_sts") == "A"))
    rows = prepaid.where(F.col("dt").isin(p.prev_month, p.month) & act)
    active = rows.groupBy(F.col("subsrptn_id").alias("_phone")).agg(
        F.max(F.col("dt") == F.lit(p.prev_month)).alias("_pre_b"),
        F.max(F.col("dt") == F.lit(p.month)).alias("_pre_e"))
    phones = F.array("fix_s_att_contact_phone1", "fix_s_att_contact_phone2")
    phones = fixed.select("fix_s_att_account", F.explode(phones).alias("_phone")).where(F.col("_phone").isNotNull())
    return (phones.distinct().join(active, "_phone").groupBy("fix_s_att_account")
            .agg(F.max("_pre_b").alias("_pre_b"), F.max("_pre_e").alias("_pre_e")))


def _tenure_merge(f: Column, m: Column) -> Column:
    """The earlier of two tenure bands; a missing one doesn't count."""
    earlier = F.lit(None).cast("string")
    for band in reversed(L.TENURES):
        earlier = F.when((f == band) | (m == band), band).otherwise(earlier)
    return earlier


def _fmc_type(fix_on: Column, mob_on: Column, prepaid: Column, fmc_code: Column) -> Column:
    z = lambda x: F.coalesce(x, F.lit(0))
    t = L.FMC_TYPES
    return (F.when((fix_on == 1) & (z(mob_on) == 0),
                   F.when(prepaid, F.when(fmc_code, t[0]).otherwise(t[1])).otherwise(t[2]))
            .when((z(fix_on) == 0) & (mob_on == 1), t[3])
            .when(fix_on + mob_on == 2,
                  F.when(prepaid, F.when(fmc_code, t[4]).otherwise(t[5]))
                  .otherwise(F.when(fmc_code, t[6]).otherwise(t[7]))))


def _segment(fmc_type: Column, mix_code: Column) -> Column:
    return (F.when(fmc_type == L.FMC_TYPES[2], F.concat(mix_code, F.lit(" Fixed")))
            .when(fmc_type == L.FMC_TYPES[3], F.lit(L.MOBILE_SEGMENT))
            .otherwise(F.concat((F.substring(mix_code, 1, 1).cast("int") + 1).cast("string"), F.lit("P "), fmc_type)))


def converged_base(fixed: DataFrame, mobile: DataFrame, prepaid: DataFrame, bill_codes: DataFrame,
                   p: RunParams) -> DataFrame:
    """FMC base rows (before the final activity/duplicate filter)."""
    M = p.month
    fixed = fixed.where(F.col("fix_s_dim_month") == F.lit(M))
    mobile = mobile.where(F.col("mob_s_dim_month") == F.lit(M)).drop("mob_s_dim_month")
    # the narrow tables first, written once: links, and the fixed rows' prepaid flags
    links = materialize(fixed_mobile_links(fixed, mobile).select(
        "fix_s_att_account", F.col("mob_s_att_account").alias("_mobile")), "links")
    pre = _prepaid_accounts(fixed, prepaid, p)
    fx = (fixed.where(F.col("fix_s_att_account").isNotNull())
          .join(links, "fix_s_att_account", "left").join(pre, "fix_s_att_account", "left"))
    # a mobile subscriber keeps the rows of one fixed row: the first by account, then
    # by the columns in which rows of one account differ. Accounts without a link have
    # no mobile to share, so their key is spread over the accounts.
    key = F.coalesce(F.col("_mobile"), -F.col("fix_s_att_account") - 1)
    fx = fx.withColumn("_key", key)
    joined = fx.join(mobile.withColumn("_key", F.col("mob_s_att_account")), "_key", "full_outer")
    order = [F.col("fix_s_att_account").desc()] + [F.col(c).asc_nulls_first() for c in FIXED_TIE_BREAK]
    # the rows are partitioned by this key already
    rank = F.row_number().over(Window.partitionBy("_key").orderBy(*order))
    base = joined.withColumn("mob_s_att_duplicates", F.when(F.col("mob_s_att_account").isNotNull(), rank).otherwise(1))
    base = base.drop("_mobile", "_key")

    codes = bill_codes.select(F.col("bill_code").alias("_code")).distinct()  # AQE broadcasts it if it is small
    base = (base.join(codes.withColumnRenamed("_code", "_cb"), F.col("fix_b_att_BillCode") == F.col("_cb"), "left")
                .join(codes.withColumnRenamed("_code", "_ce"), F.col("fix_e_att_BillCode") == F.col("_ce"), "left"))
    has = lambda c: F.coalesce(F.col(c), F.lit(False))

    c = F.col
    z = lambda x: F.coalesce(c(x), F.lit(0))
    fix_acct, mob_acct = c("fix_s_att_account"), c("mob_s_att_account")
    # VARCHAR(10) holds no longer id: the source's cast fails on one, and so does this
    mob_text = mob_acct.cast("string")
    mob_text = F.when(F.coalesce(F.length(mob_text) <= 10, F.lit(True)), mob_text).otherwise(
        F.raise_error(F.concat(F.lit("mobile id of more than 10 digits: "), mob_text)).cast("string"))
    b_type = _fmc_type(c("fix_b_fla_active"), c("mob_b_att_active"), has("_pre_b"), c("_cb").isNotNull())
    e_type = _fmc_type(c("fix_e_fla_active"), c("mob_e_att_active"), has("_pre_e"), c("_ce").isNotNull())
    base = base.select(
        "*",
        F.coalesce(c("fix_s_dim_month"), F.lit(M)).alias("fmc_s_dim_month"),
        F.when(fix_acct.isNotNull() & mob_acct.isNotNull(),
               F.concat(fix_acct.cast("string"), F.lit(" - "), mob_text))
         .when(mob_acct.isNull(), fix_acct.cast("string")).otherwise(mob_text).alias("fmc_s_att_account"),
        C.flag(z("fix_b_fla_active") + z("mob_b_att_active") >= 1).alias("fmc_b_att_active"),
        C.flag(z("fix_e_fla_active") + z("mob_e_att_active") >= 1).alias("fmc_e_att_active"),
        _tenure_merge(c("fix_b_fla_tenure"), c("mob_b_fla_tenure")).alias("fmc_b_fla_final_tenure"),
        _tenure_merge(c("fix_e_fla_tenure"), c("mob_e_fla_tenure")).alias("fmc_e_fla_final_tenure"),
        (z("fix_b_mes_num_rgus") + z("mob_b_mes_numrgus")).alias("fmc_b_mes_total_rgus"),
        (z("fix_e_mes_num_rgus") + z("mob_e_mes_numrgus")).alias("fmc_e_mes_total_rgus"),
        (F.coalesce(c("fix_b_mes_mrc"), F.lit(0.0)) + F.coalesce(c("mob_b_mes_mrc"), F.lit(0.0))).alias("fmc_b_mes_total_mrc"),
        (F.coalesce(c("fix_e_mes_mrc"), F.lit(0.0)) + F.coalesce(c("mob_e_mes_mrc"), F.lit(0.0))).alias("fmc_e_mes_total_mrc"),
        b_type.alias("fmc_b_fla_fmc_type"), e_type.alias("fmc_e_fla_fmc_type"),
    )
    return with_labels(base)


def with_labels(base: DataFrame) -> DataFrame:
    c = F.col
    fix_flag, mob_flag = c("fix_s_fla_ChurnFlag"), c("mob_s_fla_churnflag")
    fix_type, mob_type = c("fix_s_fla_churn_type"), c("mob_s_fla_churntype")
    fv, fi, ft, f0 = L.FIX_VOLUNTARY, L.FIX_INVOLUNTARY, L.FIX_TRANSFER, L.FIX_0P_EXPECTED
    mv, mi = L.MOB_VOLUNTARY, L.MOB_INVOLUNTARY
    fix_rej, mob_rej = c("fix_s_fla_Rejoiner"), c("mob_s_fla_Rejoiner")
    rej = F.element_at(F.array(*map(F.lit, (None, L.REJOINER_LABELS[1], L.REJOINER_LABELS[2], L.REJOINER_LABELS[0]))),
                       1 + C.flag(fix_rej == 1) + 2 * C.flag(mob_rej == 1))
    # which side churned: a fixed churner of a known type other than a transfer, and a mobile churner
    fix_gone = (fix_flag == L.FIX_CHURNER) & (fix_type != ft)
    mob_gone = mob_flag == L.MOB_CHURNER
    # a fixed churner without a type is none of the labelled cases
    untyped = (fix_flag == L.FIX_CHURNER) & fix_type.isNull()
    yes = lambda x: F.coalesce(x, F.lit(False))
    final_churn = (F.when(yes(untyped), L.FINAL_CHURN[3])
                   .when(yes(fix_gone) & yes(mob_gone), L.FINAL_CHURN[0]).when(yes(fix_gone), L.FINAL_CHURN[1])
                   .when(yes(mob_gone), L.FINAL_CHURN[2]).otherwise(L.FINAL_CHURN[3]))
    # the reason of each side: V(oluntary), I(nvoluntary), none; other fixed types count
    # only on their own, and a transfer leaves the mobile side's reason standing
    fix_why = (F.when(fix_type == fv, "V").when(fix_type == fi, "I").when(fix_type == f0, "0")
               .when(fix_type == ft, "T").when(fix_type.isNull(), "").otherwise("?"))
    mob_why = F.when(mob_type == mv, "V").when(mob_type == mi, "I").when(mob_type.isNull(), "").otherwise("?")
    why = F.create_map(*[F.lit(x) for pair in CHURN_REASONS.items() for x in pair])
    churn_type = F.coalesce(F.element_at(why, F.concat(fix_why, F.lit("/"), mob_why)), F.lit(L.CHURN_TYPES[5]))
    return base.select(
        "*",
        _segment(c("fmc_b_fla_fmc_type"), c("fix_b_dim_mix_code_adj")).alias("fmc_b_fla_fmc_typesegment"),
        _segment(c("fmc_e_fla_fmc_type"), c("fix_e_fla_MixCodeAdj")).alias("fmc_e_fla_fmc_typesegment"),
        F.when(c("fmc_b_fla_fmc_type") == L.FMC_TYPES[3], L.WIRELESS).otherwise(c("fix_b_fla_tech_type"))
         .alias("fmc_b_fla_final_tech"),
        F.when(c("fmc_e_fla_fmc_type") == L.FMC_TYPES[3], L.WIRELESS).otherwise(c("fix_e_fla_tech_type"))
         .alias("fmc_e_fla_final_tech"),
        rej.alias("_rejoiner"), final_churn.alias("fmc_s_fla_final_churn"),
        churn_type.alias("fmc_s_fla_final_churn_type"))


def final_flags(df: DataFrame) -> DataFrame:
    """Rejoiner override, total/partial churn and the waterfall (first
    matching branch wins; every expression reads the input columns)."""
    c = F.col
    b, e = c("fmc_b_att_active"), c("fmc_e_att_active")
    fb, fe = c("fix_b_fla_active"), c("fix_e_fla_active")
    fmv, mmv = c("fix_s_fla_main_movement"), c("mob_s_fla_mainmovement")
    rej, seg_b, seg_e = c("_rejoiner"), c("fmc_b_fla_fmc_typesegment"), c("fmc_e_fla_fmc_typesegment")
    churn, ctype = c("fmc_s_fla_final_churn"), c("fmc_s_fla_final_churn_type")
    rb, re_ = c("fmc_b_mes_total_rgus"), c("fmc_e_mes_total_rgus")
    mb, me = C.ieee("fmc_b_mes_total_mrc"), C.ieee("fmc_e_mes_total_mrc")
    fmc_seg = seg_e.isin(*L.FMC_SEGMENTS_REJOIN)
    gained, kept, lost = (b == 0) & (e == 1), (b == 1) & (e == 1), (b == 1) & (e == 0)
    new_fix = fmv.isin(L.NEW_CUSTOMER, L.GROSS_ADD_GAP)
    come_back = (fmv == L.COME_BACK) | (mmv == L.COME_BACK)
    churned = churn != L.FINAL_CHURN[3]
    w = L.WATERFALL
    waterfall = (
        F.when(gained & ((new_fix & (mmv == L.NEW_CUSTOMER)) | (new_fix & mmv.isNull())
                         | (fmv.isNull() & (mmv == L.NEW_CUSTOMER))), w[0])
        .when((fb == 0) & (fe == 1) & fmv.isNull() & c("fix_e_dim_max_start").isNull(), w[1])
        .when(gained & come_back & churned, w[2])
        .when(gained & (rej == L.REJOINER_LABELS[0]) & fmc_seg, w[3])
        .when(gained & (rej == L.REJOINER_LABELS[1]) & ~fmc_seg, w[4])
        .when(gained & (rej == L.REJOINER_LABELS[2]) & ~fmc_seg, w[5])
        .when(kept & rej.isNotNull(), w[6])
        .when(gained & come_back & rej.isNull(), w[0])
        .when(gained & (ctype == L.CHURN_TYPES[5]) & (fmv == L.TRANSFER_ADDS), w[7])
        .when(ctype == L.CHURN_TYPES[4], w[8])
        .when(kept & (rb < re_), w[9])
        .when(kept & (rb > re_), w[10])
        .when(kept & (rb == re_) & (mb == me), w[11])
        .when(kept & (rb == re_) & (mb < me), w[12])
        .when(kept & (rb == re_) & (mb > me), w[13])
        .when(lost & churned & (ctype == L.CHURN_TYPES[0]), w[14])
        .when(lost & churned & (ctype == L.CHURN_TYPES[1]), w[15])
        .when(lost & churned & (ctype == L.CHURN_TYPES[2]), w[16])
        .when(lost & (fmv == L.NULL_LAST_DAY) & ~churned, w[17]))
    # total: both sides left, or the side that left was all the customer had
    alone = seg_e.isNull() & (ctype != L.CHURN_TYPES[4])
    total = (churn == L.FINAL_CHURN[0]) | (alone & ((churn == L.FINAL_CHURN[1])
                                                    | ((churn == L.FINAL_CHURN[2]) & (seg_b == L.MOBILE_SEGMENT))))
    partial = (F.when(churn == L.FINAL_CHURN[3], F.lit(None)).when(total, L.PARTIAL_CHURN[0])
               .otherwise(L.PARTIAL_CHURN[1]))
    out = {
        "fmc_s_fla_Rejoiner": F.when(((rej == L.REJOINER_LABELS[1]) | (rej == L.REJOINER_LABELS[2])) & fmc_seg,
                                     L.REJOINER_LABELS[3]).otherwise(rej),
        "fmc_s_fla_partial_churn": partial,
        "fmc_s_fla_waterfall": waterfall,
    }
    return df.select([out[n].alias(n) if n in out else c(n) for n in CONVERGED_COLUMNS])


def converged_table(fixed: DataFrame, mobile: DataFrame, prepaid: DataFrame, bill_codes: DataFrame,
                    p: RunParams) -> DataFrame:
    """Converged table of month M: active at opening or closing, and only the
    first fixed account linked to a mobile subscriber."""
    out = final_flags(converged_base(fixed, mobile, prepaid, bill_codes, p))
    return out.where((F.col("fmc_b_att_active") + F.col("fmc_e_att_active") >= 1)
                     & (F.col("mob_s_att_duplicates") == 1))
