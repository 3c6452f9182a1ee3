"""Properties of the rewrites on the smallest data."""

import os

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from churnwise.catalog import P, converged_stage, stage_tables
from churnwise.plans import converged

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")


def _sorted(df):
    key = lambda r: tuple((v is None, str(v)) for v in r)
    return sorted((tuple(r) for r in df.collect()), key=key)


def test_null_key_split_equals_plain_full_outer_join(spark):
    _, t1, t2 = stage_tables(spark, SF)
    mobile = t2.drop("mob_s_dim_month")
    links = converged.fixed_mobile_links(t1, mobile).select(
        "fix_s_att_account", F.col("mob_s_att_account").alias("_mobile"))
    fx = t1.join(links, "fix_s_att_account", "left")
    plain = fx.join(mobile, fx["_mobile"] == mobile["mob_s_att_account"], "full_outer")
    linked, alone = fx.where(F.col("_mobile").isNotNull()), fx.where(F.col("_mobile").isNull())
    split = linked.join(mobile, linked["_mobile"] == mobile["mob_s_att_account"], "full_outer").unionByName(
        alone.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in mobile.schema.fields]))
    cols = ["fix_s_att_account", "mob_s_att_account", "fix_s_fla_churn_type", "mob_s_fla_churntype"]
    assert _sorted(split.select(cols)) == _sorted(plain.select(cols))


def test_report_base_filter_equals_numbered_join(spark):
    """The sales report keeps each converged row whose fixed account is set;
    the source's numbered self-join (row 1 per account) keeps the same rows."""
    _, t3 = converged_stage(spark, SF)
    f = t3.where(F.col("fmc_s_dim_month") == F.lit(P.month))
    numbered = (f.where(F.col("fix_s_att_account").isNotNull())
                .select("fmc_s_dim_month", "fix_s_att_account",
                        F.row_number().over(Window.partitionBy("fmc_s_dim_month", "fix_s_att_account")
                                            .orderBy(F.lit(1))).alias("records_per_user")))
    joined = f.join(numbered, ["fmc_s_dim_month", "fix_s_att_account"], "left").where("records_per_user = 1")
    cols = ["fmc_s_att_account", "fix_s_att_account", "fmc_s_fla_waterfall", "fix_s_fla_churn_type"]
    assert _sorted(joined.select(cols)) == _sorted(f.where(F.col("fix_s_att_account").isNotNull()).select(cols))


def test_opening_and_closing_totals_equal_base_counts(spark):
    _, t1, _ = stage_tables(spark, SF)
    from churnwise.plans import fixed
    from churnwise.sources.fixtures import FixtureSources
    status = fixed.fixed_status_month(FixtureSources(spark, SF), P)
    opening = status.where("fix_b_fla_active = 1").count()
    closing = status.where("fix_e_fla_active = 1").count()
    snap = FixtureSources(spark, SF).daily_snapshot()
    day = lambda d, cond: snap.where((F.col("dt") == F.lit(d)) & (F.col("play_type") != "0P")
                                     & (F.col("cust_typ_sbb") == "RES") & cond).count()
    ovd = F.col("delinquency_days")
    assert opening == day(P.month, (ovd <= 85) | ovd.isNull())
    assert closing == day(P.next_month, (ovd < 85) | ovd.isNull())
