"""Registry of the queries this package answers, with their SQL oracles.

Every query reads the provided tables through the fixture source views of
``churnwise.sources.fixtures`` (month 1998-05-01), so its work grows with the
scale factor. ``ORACLE`` holds, for the same keys, DuckDB SQL computing the
same result independently from the same tables.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnwise.oracle.fixtures_sql import FIXTURE_CTES
from churnwise.oracle import converged_sql, fixed_sql, mobile_sql, primitives_sql, reports_sql
from churnwise.params import RunParams
from churnwise.operators.materialize import materialize
from churnwise.operators.together import together
from churnwise.plans import contracts, converged, fixed, involuntary, mobile, months, primitives, sales
from churnwise.sources.fixtures import FIXTURE_MONTH, INSTALL_ORG, FixtureSources

P = RunParams(FIXTURE_MONTH, install_org=INSTALL_ORG)
#: The same month as a run from the rates switch on (the closing MRC is the run month's own).
P_CURRENT_RATES = RunParams(FIXTURE_MONTH, install_org=INSTALL_ORG, mrc_rate_switch=FIXTURE_MONTH)


def _src(spark: SparkSession, sf_dir: str) -> FixtureSources:
    return FixtureSources(spark, sf_dir)


def q_fixed_movement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixed.fixed_movement_counts(fixed.fixed_status_month(_src(spark, sf_dir), P))


def q_fixed_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixed.fixed_table(_src(spark, sf_dir), P)


def q_mobile_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mobile.mobile_table(_src(spark, sf_dir), P)


def q_mobile_table_current_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PAR-4: the mobile table of a month that reads its own closing rates."""
    return mobile.mobile_table(_src(spark, sf_dir), P_CURRENT_RATES)


def q_mobile_quick_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mobile.quick_check(mobile.mobile_table(_src(spark, sf_dir), P))


_STAGES: dict = {}


def _app(spark: SparkSession):
    try:
        return spark.sparkContext.applicationId
    except Exception:  # Spark Connect
        return id(spark)


def stage_tables(spark: SparkSession, sf_dir: str, p: RunParams = P):
    """T1 (fixed) and T2 (mobile, converged names) of month ``p.month``: the
    stage tables the converged base reads. As in the monthly chain they are
    written once (per session and data folder) and scanned by later steps. They
    read no table of each other, so they are made at once."""
    src = _src(spark, sf_dir)
    key = ("t1t2", _app(spark), sf_dir, p.month)
    if key not in _STAGES:
        _STAGES[key] = tuple(together(
            spark, lambda: materialize(fixed.fixed_table(src, p), "fixed_table"),
            lambda: materialize(contracts.mobile_for_converged(mobile.mobile_table(src, p)), "mobile_table")))
    return (src, *_STAGES[key])


def q_converged_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    src, t1, t2 = stage_tables(spark, sf_dir)
    return converged.converged_table(t1, t2, src.prepaid_master(), src.fmc_bill_codes(), P)


def q_fixed_mobile_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    src, t1, t2 = stage_tables(spark, sf_dir)
    return converged.fixed_mobile_links(t1, t2.drop("mob_s_dim_month"))


def converged_stage(spark: SparkSession, sf_dir: str, p: RunParams = P):
    """The converged table under the report column names, written once
    (per session and data folder) and scanned by the reports."""
    src, t1, t2 = stage_tables(spark, sf_dir, p)
    key = ("t3", _app(spark), sf_dir, p.month)
    if key not in _STAGES:
        t3 = converged.converged_table(t1, t2, src.prepaid_master(), src.fmc_bill_codes(), p)
        _STAGES[key] = materialize(contracts.converged_for_reports(t3), "converged_table")
    return src, _STAGES[key]


def q_sales_drivers(spark: SparkSession, sf_dir: str) -> DataFrame:
    src, t3 = converged_stage(spark, sf_dir)
    return sales.sales_drivers(t3, src.daily_snapshot(), src.interactions(), src.truckrolls(), src.payments(), P)


NEVER_PAID_COLUMNS = ["fix_s_att_account", "first_installation_date", "first_bill_created",
                      "max_delinquency_days_first_bill", "max_mrc_first_bill", "diff_mrc", "first_payment_date",
                      "first_payment_amt", "first_payment_above_date", "first_payment_above", "last_pay_date",
                      "total_payments_30_days", "total_payments_60_days", "total_payments_85_days",
                      "days_between_payment", "fixed_days_unpaid_bill", "npn_30_flag", "npn_60_flag", "npn_85_flag"]


def q_never_paid(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = _src(spark, sf_dir)
    nc_rows, _ = sales.new_customer_rows(src.daily_snapshot(), P)
    fc = sales.first_cycle(nc_rows)
    return sales.never_paid(fc, sales.first_cycle_payments(fc, src.payments(), P), P).select(*NEVER_PAID_COLUMNS)


def q_first_cycle_mrc_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = _src(spark, sf_dir)
    nc_rows, _ = sales.new_customer_rows(src.daily_snapshot(), P)
    return sales.first_cycle_mrc_values(nc_rows)


def q_first_cycle_payment_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = _src(spark, sf_dir)
    nc_rows, _ = sales.new_customer_rows(src.daily_snapshot(), P)
    return sales.first_cycle_payment_rows(sales.first_cycle(nc_rows), src.payments(), P)


def q_early_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = _src(spark, sf_dir)
    _, new = sales.new_customer_rows(src.daily_snapshot(), P)
    typed = sales.interactions_in_window(src.interactions(), src.truckrolls(), P)
    return sales.early_tickets(new, typed, P)


def q_slow_installs(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = _src(spark, sf_dir)
    _, new = sales.new_customer_rows(src.daily_snapshot(), P)
    return sales.slow_installs(new, src.order_lines(), P)


def q_involuntary_equation(spark: SparkSession, sf_dir: str) -> DataFrame:
    src, t3 = converged_stage(spark, sf_dir)
    return involuntary.involuntary_equation(t3, src.daily_snapshot(), P)


def q_involuntary_fast_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    src, t3 = converged_stage(spark, sf_dir)
    return involuntary.fast_check(t3, src.daily_snapshot(), P)


def q_involuntary_churn_type_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    src, t3 = converged_stage(spark, sf_dir)
    return involuntary.churn_type_check(t3, src.daily_snapshot(), P)


def q_fixed_table_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-1 / SRC-2: T1 written as a month-partitioned stage table (dynamic
    partition overwrite) and read back for month M (partition-pruned)."""
    from churnwise import sinks
    from churnwise.session import stage_root
    _, t1, _ = stage_tables(spark, sf_dir)
    key = ("stage", _app(spark), sf_dir, P.month)
    if key not in _STAGES:  # one folder a session and data folder, written again by each call
        _STAGES[key] = f"{stage_root(spark).rstrip('/')}/registry-{uuid.uuid4().hex[:8]}/fixed_table"
    sinks.write_month(t1, _STAGES[key], "fix_s_dim_month")
    return sinks.read_month(spark, _STAGES[key], "fix_s_dim_month", P.month)


def q_fixed_table_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-1: T1 written aside with saveAsTable, published by one change in
    the catalog, and read back through it."""
    from churnwise.session import stage_root
    from churnwise.sinks import published
    _, t1, _ = stage_tables(spark, sf_dir)
    key = ("published", _app(spark), sf_dir, P.month)
    if key not in _STAGES:  # one table a session and data folder, published again by each call
        _STAGES[key] = f"fixed_table_{uuid.uuid4().hex[:8]}"
    return published.publish(t1, _STAGES[key], "fix_s_dim_month", P.month, f"{stage_root(spark).rstrip('/')}/published")


#: Months that the daily snapshot of the fixtures covers at least in part.
MONTHS = (dt.date(1998, 4, 1), dt.date(1998, 5, 1), dt.date(1998, 6, 1))


def q_fixed_table_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PAR-1, SRC-2: T1 of three months from one pass over the snapshot."""
    return months.fixed_tables(_src(spark, sf_dir), P, MONTHS)


def q_new_customers_kept_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W-14: the new customers of month M from the kept state: the one of the
    day before M, brought up to the snapshot's last day by the days since."""
    from churnwise.session import stage_root
    rows = sales.customer_days(_src(spark, sf_dir).daily_snapshot())
    root = f"{stage_root(spark).rstrip('/')}/state-{uuid.uuid4().hex[:8]}/customers"
    sales.CUSTOMER_STATE.advance(rows, root, P.month - dt.timedelta(days=1))
    state = sales.CUSTOMER_STATE.advance(rows, root, P.next_month)
    return sales.new_customers(state, P).drop("first_seen")


# ---- operator-level queries (one reusable operator each, month M) ----------

STATUS_COLUMNS = ["fix_s_dim_month", "fix_s_att_account", "fix_b_fla_active", "fix_e_fla_active",
                  "fix_s_att_contact_phone1", "fix_s_att_contact_phone2", "fix_b_mes_num_rgus", "fix_e_mes_num_rgus",
                  "fix_b_fla_tenure", "fix_e_fla_tenure", "fix_b_fla_subsidized", "fix_e_fla_subsidized",
                  "fix_b_mes_mrc", "fix_e_mes_mrc", "fix_s_fla_main_movement", "fix_s_fla_spin_movement"]


def q_fixed_customer_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OP-01..OP-05: opening/closing base with tenure, mix units, movement, spin."""
    return fixed.fixed_status_month(_src(spark, sf_dir), P).select(*STATUS_COLUMNS)


def _fixed_month_inputs(spark: SparkSession, sf_dir: str):
    src = _src(spark, sf_dir)
    summary = fixed.account_month_summary(src.daily_snapshot(), P)
    return src, summary


def q_fixed_voluntary_churners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OP-08: voluntary churners of month M."""
    src, summary = _fixed_month_inputs(spark, sf_dir)
    status = fixed.fixed_status_month(src, P)
    orders = fixed.disconnect_orders(src.service_orders(), (P.month,))
    return fixed.voluntary_churners(status, orders, summary.where(F.col("month") == F.lit(P.month)))


def q_fixed_involuntary_churners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OP-09: involuntary churners of month M."""
    _, summary = _fixed_month_inputs(spark, sf_dir)
    return (fixed.involuntary_churners(summary.where(F.col("month").isin(P.prev_month, P.month)), P)
            .where(F.col("month") == F.lit(P.month)))


def q_mobile_reinstated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OP-12: subscribers whose latest cancellation reason is not a real churn."""
    return mobile.false_churns(_src(spark, sf_dir).postpaid_cancellations(), P)


def q_mobile_mrc_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OP-11: parent MRC split over active subscribers, opening and closing."""
    src = _src(spark, sf_dir)
    fake = mobile.false_churns(src.postpaid_cancellations(), P)
    adj = materialize(mobile.adjusted_master(src.postpaid_master(), fake, P), "adjusted_master")
    st = mobile.with_mrc(mobile.customer_status(adj, P), src.postpaid_mrc(), P)
    return st.select("mob_s_att_account", "mob_s_att_ParentAccount", "mob_b_fla_active", "mob_e_fla_active",
                     "mob_b_mes_MRC", "mob_e_mes_MRC", "mob_b_mes_tenure_days", "mob_e_mes_tenure_days")


def q_mobile_disconnections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cancellations of month M that are churn, typed by reason patterns."""
    return mobile.disconnections(_src(spark, sf_dir).postpaid_cancellations(), P)


def q_new_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounts installed in month M with their first bill date."""
    _, new = sales.new_customer_rows(_src(spark, sf_dir).daily_snapshot(), P)
    return new


def q_interaction_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OP-17, S07-S12: one interaction per key tuple, typed truck roll / tech call."""
    src = _src(spark, sf_dir)
    return sales.interactions_in_window(src.interactions(), src.truckrolls(), P)


QUERIES = {
    "fixed_movement": q_fixed_movement,
    "fixed_table": q_fixed_table,
    "fixed_table_stage": q_fixed_table_stage,
    "fixed_table_published": q_fixed_table_published,
    "fixed_table_months": q_fixed_table_months,
    "mobile_table": q_mobile_table,
    "mobile_table_current_rates": q_mobile_table_current_rates,
    "mobile_quick_check": q_mobile_quick_check,
    "converged_table": q_converged_table,
    "fixed_mobile_links": q_fixed_mobile_links,
    "sales_drivers": q_sales_drivers,
    "never_paid": q_never_paid,
    "first_cycle_mrc_values": q_first_cycle_mrc_values,
    "first_cycle_payment_rows": q_first_cycle_payment_rows,
    "early_tickets": q_early_tickets,
    "slow_installs": q_slow_installs,
    "involuntary_equation": q_involuntary_equation,
    "involuntary_fast_check": q_involuntary_fast_check,
    "involuntary_churn_type_check": q_involuntary_churn_type_check,
    "fixed_customer_status": q_fixed_customer_status,
    "fixed_voluntary_churners": q_fixed_voluntary_churners,
    "fixed_involuntary_churners": q_fixed_involuntary_churners,
    "mobile_reinstated": q_mobile_reinstated,
    "mobile_mrc_split": q_mobile_mrc_split,
    "mobile_disconnections": q_mobile_disconnections,
    "new_customers": q_new_customers,
    "new_customers_kept_state": q_new_customers_kept_state,
    "interaction_types": q_interaction_types,
    "orders_last_in_month": primitives.orders_last_in_month,
    "orders_top2_per_customer": primitives.orders_top2_per_customer,
    "customer_first_orders": primitives.customer_first_orders,
    "customer_orders_open_close": primitives.customer_orders_open_close,
    "lineitem_ship_window": primitives.lineitem_ship_window,
    "orders_distinct_rollup": primitives.orders_distinct_rollup,
    "orders_in_sets": primitives.orders_in_sets,
    "orders_not_in_set": primitives.orders_not_in_set,
    "customer_order_state": primitives.customer_order_state,
    "orders_distinct_totals": primitives.orders_distinct_totals,
    "orders_soon_after": primitives.orders_soon_after,
}


def _with(*ctes: str, body: str) -> str:
    return "WITH " + ",\n".join([FIXTURE_CTES.strip()] + [c.strip() for c in ctes]) + "\n" + body


_FIXED = fixed_sql.fixed_ctes(P)
_MOBILE = mobile_sql.mobile_ctes(P)
_CONVERGED = converged_sql.converged_ctes(P)
_SALES = reports_sql.sales_ctes(P)
_INVOL = reports_sql.involuntary_ctes(P)
_CHAIN = (_FIXED, _MOBILE, _CONVERGED)
_M = f"DATE '{P.month.isoformat()}'"

ORACLE = {
    "fixed_movement": _with(_FIXED, body=fixed_sql.fixed_movement_sql(P)),
    "fixed_table": _with(_FIXED, body="SELECT * FROM fixed_table"),
    "fixed_table_stage": _with(_FIXED, body="SELECT * FROM fixed_table"),
    "fixed_table_published": _with(_FIXED, body="SELECT * FROM fixed_table"),
    "fixed_table_months": "\nUNION ALL\n".join(
        "SELECT * FROM (" + _with(fixed_sql.fixed_ctes(P.at(m)), body="SELECT * FROM fixed_table") + ")" for m in MONTHS),
    "mobile_table": _with(_MOBILE, body="SELECT * FROM mobile_table"),
    "mobile_table_current_rates": _with(mobile_sql.mobile_ctes(P_CURRENT_RATES), body="SELECT * FROM mobile_table"),
    "mobile_quick_check": _with(_MOBILE, body=mobile_sql.QUICK_CHECK),
    "converged_table": _with(_FIXED, _MOBILE, _CONVERGED, body="SELECT * FROM converged_table"),
    "fixed_mobile_links": _with(_FIXED, _MOBILE, _CONVERGED, body=(
        "SELECT fixed_account AS fix_s_att_account, mobile_account AS mob_s_att_account, src FROM cv_links")),
    "sales_drivers": _with(*_CHAIN, _SALES, body="SELECT * FROM sales_drivers"),
    "never_paid": _with(*_CHAIN, _SALES, body=reports_sql.NEVER_PAID),
    "first_cycle_mrc_values": _with(*_CHAIN, _SALES, body=reports_sql.FIRST_CYCLE_MRC_VALUES),
    "first_cycle_payment_rows": _with(*_CHAIN, _SALES, body=reports_sql.FIRST_CYCLE_PAYMENT_ROWS),
    "early_tickets": _with(*_CHAIN, _SALES, body=reports_sql.EARLY_TICKETS),
    "slow_installs": _with(*_CHAIN, _SALES, body=reports_sql.SLOW_INSTALLS),
    "involuntary_equation": _with(*_CHAIN, _INVOL, body="SELECT * FROM involuntary_equation"),
    "involuntary_fast_check": _with(*_CHAIN, _INVOL, body=reports_sql.fast_check_sql()),
    "involuntary_churn_type_check": _with(*_CHAIN, _INVOL, body=reports_sql.CHURN_TYPE_CHECK),
    "fixed_customer_status": _with(_FIXED, body=fixed_sql.status_sql(P)),
    "fixed_voluntary_churners": _with(_FIXED, body=(
        f"SELECT month, account AS fix_s_att_account, kind AS churn_type FROM fd_voluntary WHERE month = {_M}")),
    "fixed_involuntary_churners": _with(_FIXED, body=(
        f"SELECT month, account AS fix_s_att_account, kind AS churn_type FROM fd_involuntary WHERE month = {_M}")),
    "mobile_reinstated": _with(_MOBILE, body="SELECT id AS subsrptn_id FROM mb_back"),
    "mobile_mrc_split": _with(_MOBILE, body=(
        "SELECT account AS mob_s_att_account, parent AS mob_s_att_ParentAccount, on_b AS mob_b_fla_active, "
        "on_e AS mob_e_fla_active, b_mrc AS mob_b_mes_MRC, e_mrc AS mob_e_mes_MRC, "
        "b_days AS mob_b_mes_tenure_days, e_days AS mob_e_mes_tenure_days FROM mb_priced")),
    "mobile_disconnections": _with(_MOBILE, body="SELECT account AS mob_s_att_account, why AS churn_type FROM mb_dx"),
    "new_customers": _with(*_CHAIN, _SALES, body=reports_sql.NEW_CUSTOMERS),
    "new_customers_kept_state": _with(*_CHAIN, _SALES, body=reports_sql.NEW_CUSTOMERS),
    "interaction_types": _with(*_CHAIN, _SALES, body=reports_sql.INTERACTION_TYPES),
    "orders_last_in_month": primitives_sql.ORDERS_LAST_IN_MONTH,
    "orders_top2_per_customer": primitives_sql.ORDERS_TOP2,
    "customer_first_orders": primitives_sql.CUSTOMER_FIRST_ORDERS,
    "customer_orders_open_close": primitives_sql.CUSTOMER_OPEN_CLOSE,
    "lineitem_ship_window": primitives_sql.LINEITEM_SHIP_WINDOW,
    "orders_distinct_rollup": primitives_sql.ORDERS_DISTINCT_ROLLUP,
    "orders_in_sets": primitives_sql.ORDERS_IN_SETS,
    "orders_not_in_set": primitives_sql.ORDERS_NOT_IN_SET,
    "customer_order_state": primitives_sql.CUSTOMER_ORDER_STATE,
    "orders_distinct_totals": primitives_sql.ORDERS_DISTINCT_TOTALS,
    "orders_soon_after": primitives_sql.ORDERS_SOON_AFTER,
}
