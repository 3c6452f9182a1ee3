"""Oracles for the sales-driver and involuntary-funnel reports, in DuckDB SQL over the converged_table CTE.

Facts are gathered per account (its first bill, what it paid by when, its first ticket, the overdue
stages it passed), each by its own rule; a report then counts the accounts for which a fact holds.
"""

from churnwise.oracle.rules import any_like, day, month_of
from churnwise.params import RunParams

# Report name of a converged column.
RENAMED = """
fmc_e_fla_tech fmc_e_fla_final_tech
fmc_b_fla_tech fmc_b_fla_final_tech
fmc_e_fla_fmcsegment fmc_e_fla_fmc_typesegment
fmc_b_fla_fmcsegment fmc_b_fla_fmc_typesegment
fmc_e_fla_fmc fmc_e_fla_fmc_type
fmc_b_fla_fmc fmc_b_fla_fmc_type
fmc_e_fla_tenure fmc_e_fla_final_tenure
fix_e_att_active fix_e_fla_active
fmc_s_fla_churnflag fmc_s_fla_final_churn
fmc_s_fla_churntype fmc_s_fla_final_churn_type
fix_s_fla_churntype fix_s_fla_churn_type
fix_s_fla_mainmovement fix_s_fla_main_movement
fix_e_fla_bb fix_e_dim_bb_rgu
fix_e_fla_tv fix_e_dim_tv_rgu
fix_e_fla_vo fix_e_dim_vo_rgu
fix_b_fla_bb fix_b_fla_bb_rgu
fix_b_fla_tv fix_b_fla_tv_rgu
fix_b_fla_vo fix_b_fla_vo_rgu
"""

# Purposes of technical calls, those that are none of them, and purposes that are dropped.
TECH = [
    "%ppv%problem%", "%hsd%problem%", "%cable%problem%", "%tv%problem%", "%video%problem%", "%tel%problem%", "%phone%problem%",
    "%int%problem%", "%line%problem%", "%hsd%issue%", "%ppv%issue%", "%video%issue%", "%tel%issue%", "%phone%issue%", "%int%issue%",
    "%line%issue%", "%cable%issue%", "%tv%issue%", "%bloq%", "%slow%", "%slow%service%", "%service%tech%", "%tech%service%",
    "%no%service%", "%hsd%no%", "%hsd%slow%", "%hsd%intermit%", "%no%brows%", "%phone%cant%", "%phone%no%", "%no%connect%",
    "%no%conect%", "%no%start%", "%equip%", "%intermit%", "%no%dat%", "%dat%serv%", "%int%data%", "%tech%", "%supp%", "%outage%",
    "%mass%", "%discon%warn%",
]
NOT_TECH = ["%work%order%status%", "%default%call%wrapup%", "%bound%call%", "%cust%first%", "%audit%", "%eq%code%", "%downg%", "%upg%", "%vol%discon%", "%discon%serv%", "%serv%call%"]
DROPPED = ["Work Order Status", "Default Call Wrapup", "G:outbound Calls", "Eq: Cust. First", "Eq: Audit", "Eq: Code Error", "Downgrade Service", "Disconnect Service", "Rt: Dowgrde Service", "Cust Service Calls"]
NOT_IN_BASE = ["Downsell-Fixed Customer Gap", "Fixed Base Exception", "Churn Exception"]

# Dimensions of the funnel.
FUNNEL_DIMS = """
fmc_s_dim_month fmc_b_fla_fmcsegment fmc_b_fla_fmc fmc_b_fla_tech fix_b_fla_tenure fmc_e_fla_fmcsegment fmc_e_fla_fmc
fmc_e_fla_tech fix_e_fla_tenure fix_s_fla_churnflag fix_s_fla_churntype fix_s_fla_mainmovement fmc_s_fla_waterfall
"""
# Stages of the funnel, the side whose products count, and the report's name for it.
STAGES = [("overdueday1", "e", "day1", "overdue1day"), ("softdx", "e", "softdx", "softdx"), ("backlog", "b", "backlog", "backlog"), ("harddx", "b", "harddx", "harddx")]
PRODUCTS = ("bb", "tv", "vo")


def report_base_cte() -> str:
    more = ", ".join(" AS ".join(reversed(line.split())) for line in RENAMED.strip().splitlines())
    return f"t3 AS (SELECT *, {more}, fmc_s_dim_month AS dt FROM converged_table)"


def sales_ctes(p: RunParams) -> str:
    M, ahead, back, end = (day(d) for d in (p.month, p.shift(2), p.shift(-3), p.next_month))
    unpaid = ", ".join(f"CASE WHEN coalesce(total_payments_{n}_days < max_mrc_first_bill, total_payments_{n}_days IS NULL) THEN account END AS npn_{n}_flag" for n in p.payment_windows)
    paid = ", ".join(f"round(sum(amount) FILTER (WHERE after < {n}), 2) AS total_payments_{n}_days" for n in p.payment_windows)
    never = ", ".join(f"count(DISTINCT account) FILTER (WHERE account IN (SELECT npn_{n}_flag FROM sl_paid)) AS opd_s_mes_never_paid_{n}_days" for n in p.payment_windows)
    return f"""
{report_base_cte()},
sl_days AS (
    SELECT sub_acct_no_sbb AS account, dt, CAST(connect_dte_sbb AS DATE) AS connected, bill_from_dte_sbb AS billed,
           video_chrg + hsd_chrg + voice_chrg AS mrc, delinquency_days AS overdue
    FROM fx_snapshot WHERE play_type <> '0P' AND cust_typ_sbb = 'RES' AND CAST(connect_dte_sbb AS DATE) >= {back} AND CAST(connect_dte_sbb AS DATE) < {end}),
-- new: on the latest such day, the account was connected in the month
sl_new AS (
    SELECT account, arg_max_null(connected, dt) AS start, arg_min_null(billed, dt) AS first_bill FROM sl_days
    GROUP BY account HAVING start >= {M} AND start < {end}),
sl_cycle AS (
    SELECT account, any_value(start) AS first_installation_date, any_value(first_bill) AS first_bill_created,
           max(overdue) FILTER (WHERE billed = first_bill) AS max_delinquency_days_first_bill,
           max(mrc) FILTER (WHERE in_cycle) AS max_mrc_first_bill, (max(mrc) FILTER (WHERE in_cycle) IS NOT NULL)::BIGINT AS diff_mrc
    FROM (SELECT *, dt >= first_bill AND dt <= first_bill + INTERVAL 3 MONTH AS in_cycle FROM sl_days JOIN sl_new USING (account))
    GROUP BY account HAVING bool_or(in_cycle) AND bool_or(billed = first_bill)),
sl_payments AS (
    SELECT account, CAST(x.dt AS DATE) AS paid_on, x.payment_amt_usd AS amount, CAST(x.dt AS DATE) - first_bill_created AS after,
           x.payment_amt_usd >= max_mrc_first_bill AS covers
    FROM sl_cycle JOIN fx_payments x ON x.account_id = account
    WHERE after BETWEEN -{p.payment_lookback_days} AND {max(p.payment_windows)}),
sl_paid AS (
    SELECT *, after_above::INT AS days_between_payment, coalesce(after_above, {max(p.payment_windows) + 1})::INT AS fixed_days_unpaid_bill, {unpaid}
    FROM sl_cycle LEFT JOIN (
        SELECT account, min(paid_on) AS first_payment_date, arg_min(amount, (paid_on, amount)) AS first_payment_amt,
               min(paid_on) FILTER (WHERE covers) AS first_payment_above_date, arg_min(amount, (paid_on, amount)) FILTER (WHERE covers) AS first_payment_above,
               min(after) FILTER (WHERE covers) AS after_above, max(paid_on) AS last_pay_date, {paid}
        FROM sl_payments GROUP BY account) USING (account)),
-- one interaction of those that agree in all but their number: the one of the lowest number
sl_contacts AS (
    SELECT * FROM (
        SELECT *, CAST(interaction_start_time AS DATE) AS interaction_date FROM fx_interactions
        WHERE account_type = 'RES' AND {month_of('interaction_start_time')} BETWEEN {M} AND {ahead}) a
    WHERE interaction_purpose_descrip NOT IN (SELECT unnest({DROPPED!r}))
      AND interaction_id = (SELECT min(b.interaction_id) FROM fx_interactions b
        WHERE b.account_type = 'RES' AND b.account_id IS NOT DISTINCT FROM a.account_id AND CAST(b.interaction_start_time AS DATE) = a.interaction_date
          AND b.interaction_channel IS NOT DISTINCT FROM a.interaction_channel AND b.interaction_agent_id IS NOT DISTINCT FROM a.interaction_agent_id
          AND b.interaction_purpose_descrip IS NOT DISTINCT FROM a.interaction_purpose_descrip)),
sl_typed AS (
    SELECT *, CASE WHEN EXISTS (SELECT 1 FROM fx_truckrolls t WHERE t.sub_acct_no_sbb = c.account_id AND CAST(t.create_dte_ojb AS DATE) = c.interaction_date) THEN 'truckroll'
                   WHEN {any_like('interaction_purpose_descrip', TECH)} AND NOT {any_like('interaction_purpose_descrip', NOT_TECH)} THEN 'tech_call' END AS interaction_type
    FROM sl_contacts c),
sl_tickets AS (
    SELECT n.account, start, min(interaction_date) AS first_ticket,
           CASE WHEN datesub('week', start, min(interaction_date)) <= {p.early_ticket_weeks} THEN n.account END AS early
    FROM sl_new n JOIN sl_typed t ON t.customer_id = n.account WHERE interaction_type IS NOT NULL GROUP BY n.account, start),
sl_installs AS (
    SELECT DISTINCT n.account AS fix_s_att_account, start AS fix_b_att_maxstart, n.account AS new_sales_flag, {month_of('start')} AS install_month,
           CAST(x.order_start_date AS DATE) AS order_start_date, CAST(x.completed_date AS DATE) AS completed_date,
           CASE WHEN CAST(x.completed_date AS DATE) - CAST(x.order_start_date AS DATE) > {p.slow_install_days} THEN n.account END AS outlier_install_flag
    FROM sl_new n LEFT JOIN (FROM fx_orderlines WHERE (org_id, org_cntry, order_status, command_id) = ('{p.install_org}', '{p.install_country}', 'COMPLETE', 'CONNECT')) x
      ON x.account_id = n.account),
sales_drivers AS (
    SELECT fmc_s_dim_month AS opd_s_dim_month, fmc_e_fla_tech AS opd_e_fla_final_tech, fmc_e_fla_fmcsegment AS opd_e_fla_opd_segment,
           fmc_e_fla_fmc AS opd_e_fla_opd_type, fmc_e_fla_tenure AS opd_e_fla_final_tenure,
           count(DISTINCT account) FILTER (WHERE fix_e_att_active = 1) AS opd_s_mes_active_base, count(DISTINCT account) AS opd_s_mes_soft_dx,
           count(DISTINCT account) FILTER (WHERE account IN (SELECT account FROM sl_new)) AS opd_s_mes_sales, {never},
           count(DISTINCT account) FILTER (WHERE account IN (SELECT early FROM sl_tickets)) AS opd_s_mes_uni_early_tickets
    FROM (SELECT *, fix_s_att_account AS account FROM t3)
    WHERE fmc_s_dim_month = {M} AND account IS NOT NULL AND fmc_s_fla_churnflag <> 'Fixed Churner' AND fix_s_fla_mainmovement <> '6.Null last day'
      AND fmc_s_fla_waterfall NOT IN (SELECT unnest({NOT_IN_BASE!r}))
    GROUP BY 1, 2, 3, 4, 5)"""


NEVER_PAID = """
SELECT account AS fix_s_att_account, * EXCLUDE (account, after_above) FROM sl_paid"""

FIRST_CYCLE_MRC_VALUES = """
SELECT DISTINCT account AS fix_s_att_account, mrc FROM sl_days JOIN sl_new USING (account)
WHERE dt >= first_bill AND dt <= first_bill + INTERVAL 3 MONTH"""

FIRST_CYCLE_PAYMENT_ROWS = """
SELECT account AS fix_s_att_account, paid_on AS pay_dt, amount AS amt, after::INT AS days_from_bill FROM sl_payments"""

EARLY_TICKETS = f"""
SELECT account AS fix_s_att_account, {month_of('start')} AS install_month, start AS fix_b_att_maxstart, first_ticket AS first_ticket_date,
       early AS early_ticket_flag FROM sl_tickets"""

NEW_CUSTOMERS = f"""
SELECT account AS fix_s_att_account, start AS fix_b_att_maxstart, first_bill AS first_bill_created, {month_of('start')} AS install_month FROM sl_new"""

SLOW_INSTALLS = """
SELECT * FROM sl_installs"""

INTERACTION_TYPES = """
SELECT interaction_date, account_id, interaction_channel, interaction_agent_id, interaction_purpose_descrip, customer_id, interaction_type FROM sl_typed"""


def involuntary_ctes(p: RunParams) -> str:
    M, limit = day(p.month), p.overdue_days
    first, last = (day(d) for d in p.snapshot_window)
    counts = ["count(DISTINCT fix_s_att_account) AS che_s_mes_active_base"]
    counts += [f"count(DISTINCT fix_e_fla_{x}) AS che_s_mes_total_{x}" for x in PRODUCTS]
    counts += [f"count(DISTINCT fix_s_att_account) FILTER (WHERE {stage}) AS che_s_mes_{name}" for stage, _, name, _ in STAGES]
    counts += [f"count(DISTINCT fix_s_att_account) FILTER (WHERE {stage} AND fix_{side}_fla_{x} IS NOT NULL) AS che_s_mes_{name}_{x}" for x in PRODUCTS for stage, side, _, name in STAGES]
    dims = ", ".join(FUNNEL_DIMS.split())
    return f"""
{report_base_cte()},
-- the overdue days an account showed in the month, as a set
iv_days AS (
    SELECT sub_acct_no_sbb AS account, list(DISTINCT delinquency_days) FILTER (WHERE delinquency_days IS NOT NULL) AS days
    FROM fx_snapshot
    WHERE play_type <> '0P' AND cust_typ_sbb = 'RES' AND dt BETWEEN {first} AND {last} AND {month_of('dt')} = {M} GROUP BY ALL),
iv_rows AS (
    SELECT t3.*, coalesce(list_contains(days, {p.funnel_day1}), false) AS overdueday1, coalesce(list_contains(days, {p.funnel_soft}), false) AS softdx,
           -- reaches the limit by the end of the month
           coalesce(len([d FOR d IN days IF d BETWEEN {limit - (p.month_end - p.month).days} AND {limit}]) > 0, false) AS backlog,
           coalesce(list_max(days) >= {limit} AND fmc_s_fla_churntype = 'Involuntary Churner', false) AS harddx
    FROM t3 LEFT JOIN iv_days ON account = fix_s_att_account WHERE fmc_s_dim_month = {M}),
involuntary_equation AS (SELECT {dims}, {", ".join(counts)} FROM iv_rows GROUP BY {dims})"""


def fast_check_sql() -> str:
    held = "count(DISTINCT fix_s_att_account) FILTER (WHERE {})"
    counts = [held.format(stage) + f" AS {stage}_clients" for stage, *_ in STAGES]
    counts += [held.format(f"{stage} AND fix_{side}_fla_{x} IS NOT NULL") + f" AS {stage}_{x}" for stage, side, _, _ in STAGES for x in PRODUCTS]
    return f"SELECT {', '.join(counts)}, count(DISTINCT fix_s_att_account) AS che_s_mes_active_base FROM iv_rows"


CHURN_TYPE_CHECK = f"""
SELECT fmc_s_fla_churntype, count(DISTINCT fix_s_att_account) FILTER (WHERE harddx) AS harddx_clients,
       {", ".join(f"count(DISTINCT fix_s_att_account) FILTER (WHERE harddx AND fix_b_fla_{x} IS NOT NULL) AS harddx_{x}" for x in PRODUCTS)}
FROM iv_rows GROUP BY 1"""
