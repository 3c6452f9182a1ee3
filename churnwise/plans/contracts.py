"""Column contracts between the monthly stage tables.

The mobile table's producer names differ from the names the converged base
reads, and the converged table's names differ from what the sales-driver and
involuntary-funnel reports read. These adapters state the mapping once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# mobile table (producer) -> converged base (consumer)
MOBILE_TO_CONVERGED = {
    "mob_s_dim_month": "mob_s_dim_month", "mob_s_att_account": "mob_s_att_account",
    "mob_s_att_ParentAccount": "mob_s_att_parentaccount",
    "mob_b_fla_active": "mob_b_att_active", "mob_e_fla_active": "mob_e_att_active",
    "mob_b_dim_date": "mob_b_dim_date", "mob_b_mes_tenure_days": "mob_b_mes_tenuredays",
    "mob_b_dim_max_start": "mob_b_att_maxstart", "mob_b_fla_Tenure": "mob_b_fla_tenure",
    "mob_b_mes_MRC": "mob_b_mes_mrc", "mob_b_mes_rgus": "mob_b_mes_numrgus",
    "mob_e_dim_date": "mob_e_dim_date", "mob_e_mes_tenure_days": "mob_e_mes_tenuredays",
    "mob_e_dim_max_start": "mob_e_att_maxstart", "mob_e_fla_Tenure": "mob_e_fla_tenure",
    "mob_e_mes_MRC": "mob_e_mes_mrc", "mob_e_mes_rgus": "mob_e_mes_numrgus",
    "mob_s_fla_movement": "mob_s_fla_mainmovement", "mob_s_mes_mrc_diff": "mob_s_mes_mrcdiff",
    "mob_s_fla_SpinMovement": "mob_s_fla_spinmovement", "mob_s_fla_churn": "mob_s_fla_churnflag",
    "mob_s_dim_churn_type": "mob_s_fla_churntype", "mob_s_fla_rejoiner_month": "mob_s_fla_Rejoiner",
}

# converged table (producer) -> reports (consumer); consumers also read the
# producer names that did not change.
CONVERGED_TO_REPORTS = {
    "fmc_e_fla_final_tech": "fmc_e_fla_tech", "fmc_b_fla_final_tech": "fmc_b_fla_tech",
    "fmc_e_fla_fmc_typesegment": "fmc_e_fla_fmcsegment", "fmc_b_fla_fmc_typesegment": "fmc_b_fla_fmcsegment",
    "fmc_e_fla_fmc_type": "fmc_e_fla_fmc", "fmc_b_fla_fmc_type": "fmc_b_fla_fmc",
    "fmc_e_fla_final_tenure": "fmc_e_fla_tenure",
    "fix_e_fla_active": "fix_e_att_active",
    "fmc_s_fla_final_churn": "fmc_s_fla_churnflag",
    "fmc_s_fla_final_churn_type": "fmc_s_fla_churntype",
    "fix_s_fla_churn_type": "fix_s_fla_churntype",
    "fix_s_fla_main_movement": "fix_s_fla_mainmovement",
    "fix_e_dim_bb_rgu": "fix_e_fla_bb", "fix_e_dim_tv_rgu": "fix_e_fla_tv", "fix_e_dim_vo_rgu": "fix_e_fla_vo",
    "fix_b_fla_bb_rgu": "fix_b_fla_bb", "fix_b_fla_tv_rgu": "fix_b_fla_tv", "fix_b_fla_vo_rgu": "fix_b_fla_vo",
}


def mobile_for_converged(mobile: DataFrame) -> DataFrame:
    return mobile.select([F.col(k).alias(v) for k, v in MOBILE_TO_CONVERGED.items()])


def converged_for_reports(converged: DataFrame) -> DataFrame:
    """Keep every converged column and add the report names plus ``dt``."""
    extra = [F.col(k).alias(v) for k, v in CONVERGED_TO_REPORTS.items()]
    return converged.select("*", *extra, F.col("fmc_s_dim_month").alias("dt"))
