"""The converged table on random stage tables that reach every label, and the smaller rules of the round."""

import datetime as dt
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from churnwise.operators.links import best_links, candidate_links
from churnwise.operators.rollup import distinct_flag_rollup
from churnwise.oracle.converged_sql import WATERFALL, converged_ctes
from churnwise.params import RunParams
from churnwise.plans import contracts, converged, fixed, mobile
from churnwise.plans.fixed import FIXED_COLUMNS
from scripts.oracle_check import digest

M = dt.date(1998, 5, 1)
P = RunParams(M)
TENURES = ["Early-Tenure", "Mid-Tenure", "Late-Tenure", None]


def _kind(column: str) -> str:
    if column.endswith(("_mrc", "_MRC", "_mrc_diff")):
        return "double"
    if "_dim_date" in column or "max_start" in column or column.endswith("dim_month"):
        return "date"
    if column.endswith(("_rgu", "_att_account", "phone1", "phone2", "ParentAccount")):
        return "long"
    if column.endswith(("fla_active", "num_rgus", "outstage", "_code", "subsidized", "Rejoiner", "tenure_days", "_rgus", "rejoiner_month")):
        return "int"
    return "string"


def _stage_tables(rng):
    fixed_rows, mobile_rows = [], []
    for k in range(1, 1500):
        on = rng.choice([(0, 1), (1, 1), (1, 0), (0, 0)])
        v = {
            "fix_s_dim_month": M, "fix_s_att_account": k // 2 * 2 if rng.random() < 0.3 else k,  # some accounts have several rows
            "fix_b_fla_active": on[0], "fix_e_fla_active": on[1],
            "fix_s_att_contact_phone1": rng.choice([None, 10_000 + rng.randrange(1200)]), "fix_s_att_contact_phone2": rng.choice([None, 10_000 + rng.randrange(1200)]),
            "fix_b_mes_num_rgus": rng.choice([None, 0, 1, 2, 3]), "fix_e_mes_num_rgus": rng.choice([None, 1, 2, 3]),
            "fix_b_mes_mrc": rng.choice([None, 10.0, 20.0, float("nan")]), "fix_e_mes_mrc": rng.choice([None, 10.0, 20.0]),
            "fix_b_fla_tenure": rng.choice(TENURES), "fix_e_fla_tenure": rng.choice(TENURES),
            "fix_b_dim_mix_code_adj": f"{rng.randrange(1, 4)}P" if on[0] else None, "fix_e_fla_MixCodeAdj": f"{rng.randrange(1, 4)}P" if on[1] else None,
            "fix_b_att_BillCode": rng.choice(["B0", "B9", None]), "fix_e_att_BillCode": rng.choice(["B0", "B9", None]),
            "fix_b_fla_tech_type": "HFC", "fix_e_fla_tech_type": rng.choice(["FTTH", None]),
            "fix_s_fla_main_movement": rng.choice(["4.New Customer", "8.Rejoiner-GrossAdd Gap", "5.Come Back to Life", "6.Null last day", "7.Transfer Adds", "1.SameRGUs", None]),
            "fix_s_fla_ChurnFlag": rng.choice(["1. Fixed Churner", "2. Fixed NonChurner", None]),
            "fix_s_fla_churn_type": rng.choice(["1. Fixed Voluntary Churner", "2. Fixed Involuntary Churner", "3. Fixed Transfer", "4. Fixed 0P Churner", None]),
            "fix_s_fla_Rejoiner": rng.choice([0, 0, 1, None]), "fix_e_dim_max_start": rng.choice([None, M]), "fix_s_fla_spin_movement": f"spin{k}",
        }
        fixed_rows.append(tuple(v.get(c) for c in FIXED_COLUMNS))
    for k in range(1000):
        v = {
            "mob_s_dim_month": M, "mob_s_att_account": 10_000 + (k if rng.random() < 0.8 else k // 2 * 2), "mob_s_att_MobileType": "Postpaid",
            "mob_b_fla_active": rng.randrange(2), "mob_e_fla_active": rng.randrange(2), "mob_b_fla_Tenure": rng.choice(TENURES), "mob_e_fla_Tenure": rng.choice(TENURES),
            "mob_b_mes_MRC": rng.choice([None, 5.0]), "mob_e_mes_MRC": rng.choice([None, 5.0, 7.0]), "mob_b_mes_rgus": rng.choice([None, 1]), "mob_e_mes_rgus": rng.choice([None, 0, 1]),
            "mob_s_fla_movement": rng.choice(["4.New Customer", "5.Come Back to Life", "6.Null last day", "1.SameRGUs", None]),
            "mob_s_fla_churn": rng.choice(["1. Mobile Churner", "2. Mobile NonChurner"]),
            # rows of one subscriber differ in their churn type only in the source; here they must differ in it too
            "mob_s_dim_churn_type": rng.choice(["1. Mobile Voluntary Churner", "2. Mobile Involuntary Churner", None]), "mob_s_fla_rejoiner_month": rng.choice([0, 1, None]),
        }
        mobile_rows.append(v)
    seen, unique = set(), []
    for v in mobile_rows:  # equal tie-break columns would leave the pick open
        if (key := (v["mob_s_att_account"], v["mob_s_dim_churn_type"])) not in seen:
            seen.add(key)
            unique.append(tuple(v.get(c) for c in mobile.MOBILE_COLUMNS))
    return fixed_rows, unique


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_every_label(spark, seed):
    rng = random.Random(seed)
    fixed_rows, mobile_rows = _stage_tables(rng)
    schema = lambda names: ", ".join(f"`{c}` {_kind(c)}" for c in names)
    t1 = spark.createDataFrame(fixed_rows, schema(FIXED_COLUMNS))
    t2 = spark.createDataFrame(mobile_rows, schema(mobile.MOBILE_COLUMNS))
    prepaid = [(10_000 + k, d, "O", "I", rng.choice(["PR", "VI"]), "A") for k in range(0, 1200, 3) for d in (P.prev_month, M) if rng.random() < 0.7]
    names = "subsrptn_id long, dt date, cust_sts string, acct_type_cd string, ba_rgn_nm string, subsrptn_sts string"
    codes = spark.createDataFrame([("B0",), ("B0",)], "bill_code string")
    got = converged.converged_table(t1, contracts.mobile_for_converged(t2), spark.createDataFrame(prepaid, names), codes, P)
    con = duckdb.connect()
    for name, df in (("fixed_table", t1), ("mobile_table", t2), ("fx_prepaid", spark.createDataFrame(prepaid, names)), ("fx_billcodes", codes)):
        arrow = df.toArrow()
        con.register(name, arrow)
    sql = "WITH " + converged_ctes(P).strip() + "\nSELECT * FROM converged_table"
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    want, rows = result.fetchall(), [tuple(r) for r in got.collect()]
    assert len(rows) == len(want) and digest(got.columns, rows)[0] == digest(columns, want)[0]
    at = {c: k for k, c in enumerate(columns)}
    labels = lambda c: {r[at[c]] for r in want}
    for side in "be":
        assert labels(f"fmc_{side}_fla_fmc_type") >= {"Prepaid Real FMC", "Prepaid Near FMC", "Fixed Only", "Mobile Only", "Real FMC", "Near FMC", "Postpaid Real FMC", "Postpaid Near FMC"}
    # no segment is ever '2P FMC', '3P FMC' or '4P FMC': the number always comes before a longer type
    never = {"5.1. FMC Rejoiner"}
    assert labels("fmc_s_fla_waterfall") >= {label for _, label in WATERFALL} - never


def test_mobile_ids_of_more_than_ten_digits_fail(spark):
    row = {"mob_s_dim_month": M, "mob_b_fla_active": 1, "mob_e_fla_active": 1}
    schema = lambda names: ", ".join(f"`{c}` {_kind(c)}" for c in names)
    none = spark.createDataFrame([], schema(FIXED_COLUMNS))
    prepaid = spark.createDataFrame([], "subsrptn_id long, dt date, cust_sts string, acct_type_cd string, ba_rgn_nm string, subsrptn_sts string")
    for account, fails in ((7_870_000_001, False), (17_870_000_001, True)):
        t2 = spark.createDataFrame([tuple((row | {"mob_s_att_account": account}).get(c) for c in mobile.MOBILE_COLUMNS)], schema(mobile.MOBILE_COLUMNS))
        out = converged.converged_table(none, contracts.mobile_for_converged(t2), prepaid, spark.createDataFrame([("B0",)], "bill_code string"), P)
        if fails:
            with pytest.raises(Exception, match="more than 10 digits"):
                out.collect()
        else:
            assert [r["fmc_s_att_account"] for r in out.collect()] == [str(account)]


def test_candidate_rows_are_ranked_with_their_multiplicity(spark):
    left = spark.createDataFrame([(1, 100, None), (2, 100, None), (3, 7, 7), (4, 7, None)], "f long, p1 long, p2 long")
    kept = lambda right: {(r.f, r.m, r.src) for r in best_links(candidate_links(left, "f", ["p1", "p2"], right, "m"), "f", "m").collect()}
    once = spark.createDataFrame([(100,), (7,), (None,)], "m long")
    assert kept(once) == {(1, 100, 1), (2, 100, 1), (4, 7, 1), (3, 7, 1)}
    # two rows of the mobile: both rows of account 2 come before account 1
    twice = spark.createDataFrame([(100,), (100,), (7,)], "m long")
    assert kept(twice) == {(2, 100, 1), (4, 7, 1), (3, 7, 1)}


def test_count_of_nothing_is_zero(spark):
    empty = spark.createDataFrame([], "g string, id long")
    assert distinct_flag_rollup(empty, [], "id", {"n": F.col("id")}).collect()[0]["n"] == 0
    assert distinct_flag_rollup(empty, ["g"], "id", {"n": F.col("id")}).collect() == []


def test_ingest_blanks_and_null_keys(spark, tmp_path):
    from churnwise.sources.catalog import TableSources

    text = spark.createDataFrame([(1, " "), (2, None), (3, "1998-05-02 10:00:00"), (4, "")], "account_id long, interaction_start_time string")
    text.write.parquet(f"{tmp_path}/i")
    spark.createDataFrame([("5", "1998-04-01"), (None, "1998-04-01")], "subsrptn_id string, dt string").write.parquet(f"{tmp_path}/c")
    src = TableSources(spark, {"interactions": f"{tmp_path}/i", "postpaid_cancellations": f"{tmp_path}/c"})
    got = {r["account_id"]: r["interaction_start_time"] for r in src.interactions().collect()}
    assert got[1] is None and got[2] is None and got[4] is None and got[3] == dt.datetime(1998, 5, 2, 10)
    # NULL keys pass: the plans' NOT IN tests decide what they mean
    assert {r["subsrptn_id"] for r in src.postpaid_cancellations().collect()} == {5, None}
    spark.createDataFrame([(1, "soon")], text.schema).write.parquet(f"{tmp_path}/bad")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        TableSources(spark, {"interactions": f"{tmp_path}/bad"}).interactions().collect()


def test_closing_rates_follow_the_switch(spark):
    """The MRC month of the closing side: the run month from the switch on, the month before until then."""
    status = spark.createDataFrame([(M, 1, 9, "Postpaid", 1, 1)], "mob_s_dim_month date, mob_s_att_account long, mob_s_att_ParentAccount long, mob_s_att_MobileType string, mob_b_fla_active int, mob_e_fla_active int")
    status = status.select("*", F.lit(None).cast("double").alias("mob_b_mes_MRC"), F.lit(None).cast("double").alias("mob_e_mes_MRC"))
    bills = spark.createDataFrame([(P.prev_month, 9, 10.0), (M, 9, 30.0)], "dt date, acct_nbr long, `mrc/account` double")
    for switch, closing in ((M, 30.0), (P.next_month, 10.0)):
        row = mobile.with_mrc(status, bills, RunParams(M, mrc_rate_switch=switch)).first()
        assert (row["mob_b_mes_MRC"], row["mob_e_mes_MRC"]) == (10.0, closing)


def test_deduplicated_cancellations_keep_the_latest_then_the_last_type(spark):
    rows = [(1, "1998-05-03", "no pay"), (1, "1998-05-09", "moved"), (2, "1998-05-09", "moved"), (2, "1998-05-09", "fraud")]
    cancels = spark.createDataFrame([(M, i, "I", "PR", d, r, "") for i, d, r in rows],
                                    "dt date, subsrptn_id long, acct_type_cd string, rgn_nm string, subsrptn_sts_dt string, acct_sts_rsn_desc string, lst_susp_rsn_desc string")
    types = lambda p: sorted(tuple(r) for r in mobile.disconnections(cancels, p).collect())
    assert len(types(P)) == 4
    assert types(RunParams(M, dedupe_mobile_churners=True)) == [(1, "Voluntary"), (2, "Voluntary")]


def test_existing_stage_tables_can_be_left_alone(spark, tmp_path):
    from churnwise.plans.monthly import MonthlyRun

    for absent, value in ((False, 1), (True, 2)):
        run = MonthlyRun(spark, None, P, str(tmp_path), create_if_absent=absent)
        kept = run._step("t", lambda v=value: spark.createDataFrame([(M, v)], "m date, x int"), "m")
        assert [r["x"] for r in kept.collect()] == [1]


def test_later_months_use_their_own_rates():
    assert RunParams("2023-04-01").mrc_rate_switch <= RunParams("2023-04-01").month
    assert RunParams("2023-03-01").mrc_rate_switch > RunParams("2023-03-01").month


def test_snapshot_is_aggregated_without_sorting(spark):
    from tests.helpers import SNAPSHOT_SCHEMA

    plan = fixed.account_month_summary(spark.createDataFrame([], SNAPSHOT_SCHEMA), P)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_repeated_day_rows_count_once(spark):
    from tests.helpers import ORDERS_SCHEMA, SNAPSHOT_SCHEMA, days, snap_row

    rows = [snap_row(d, 1) for d in days(dt.date(1998, 3, 31), dt.date(1998, 6, 1))]

    class Src:
        def daily_snapshot(self):
            return spark.createDataFrame(rows + [r for r in rows if r[0].day == 1], SNAPSHOT_SCHEMA)

        def service_orders(self):
            return spark.createDataFrame([], ORDERS_SCHEMA)

    assert fixed.fixed_table(Src(), P).count() == 1


def test_install_code_is_required():
    from churnwise.plans import sales

    with pytest.raises(ValueError, match="install_org"):
        sales.slow_installs(None, None, P)


def test_longest_window_bounds_the_payments():
    assert RunParams(M).payment_days == 85 and RunParams(M, payment_windows=[30, 120]).payment_days == 120


def test_every_parameter_can_be_set_from_the_command_line():
    from churnwise import __main__ as cli

    names = {f.name for f in cli.OPTIONS}
    assert {"install_org", "mrc_rate_switch", "tenure_early", "payment_windows", "funnel_day1", "overdue_days"} <= names
