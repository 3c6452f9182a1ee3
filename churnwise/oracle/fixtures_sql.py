"""The fixture source views of ``churnwise.sources.fixtures`` stated as DuckDB
SQL common table expressions over the pre-registered provided tables.

Each name is a CTE usable in any oracle query: prefix a query with
``WITH`` + ``FIXTURE_CTES`` + ``,`` and then the query's own CTEs.
"""

FIXTURE_CTES = r"""
fx_snapshot AS (
    SELECT dt, dt AS as_of, k AS sub_acct_no_sbb,
        CASE WHEN k % 4 = 0 THEN 7870000000 + k WHEN k % 4 = 1 THEN CAST(0 AS BIGINT) END AS home_phone_sbb,
        CASE WHEN k % 6 = 0 THEN 7870000000 + k WHEN k % 5 = 0 THEN 7870000000 + k - 1 END AS bus_phone_sbb,
        CAST(CASE WHEN k % 10 = 9 THEN NULL
                  WHEN k % 10 = 7 THEN (CASE WHEN k % 3 = 1 THEN 5 WHEN k % 3 = 2 THEN 30 ELSE 60 END)
                                       + date_diff('day', DATE '1998-04-30', dt)
                  ELSE (k * 3) % 40 END AS INTEGER) AS delinquency_days,
        CAST(CASE WHEN k % 10 = 3 THEN (CASE WHEN k % 50 = 23 THEN NULL ELSE DATE '1998-05-05' END)
                  ELSE DATE '1998-05-01' - CAST(20 + (k * 7) % 700 AS INTEGER) END AS TIMESTAMP) AS connect_dte_sbb,
        CAST(0 AS DOUBLE) AS video_chrg,
        CASE WHEN k % 10 = 6 AND dt >= DATE '1998-05-15'
             THEN CAST(30 + (k % 7) * 5 AS DOUBLE) + (CASE WHEN k % 20 = 6 THEN 5.0 ELSE -5.0 END)
             ELSE CAST(30 + (k % 7) * 5 AS DOUBLE) END AS hsd_chrg,
        CAST(0 AS DOUBLE) AS voice_chrg,
        CASE k % 4 WHEN 0 THEN 'FIBER' WHEN 1 THEN 'FIBCO ' WHEN 2 THEN 'COAX' ELSE 'DSL' END AS drop_type,
        CAST(CASE WHEN k % 100 = 50 THEN NULL ELSE 1 END AS INTEGER) AS hsd,
        CAST(CASE WHEN k % 10 = 4 THEN (CASE WHEN dt >= DATE '1998-05-15' THEN 1 ELSE 0 END)
                  WHEN k % 10 = 5 THEN (CASE WHEN dt >= DATE '1998-05-15' THEN 0 ELSE 1 END)
                  ELSE 0 END AS INTEGER) AS video,
        CAST((k // 10) % 2 AS INTEGER) AS voice,
        CASE WHEN k % 5 = 0 THEN 'X' ELSE 'N' END AS joint_customer,
        CASE WHEN k % 7 = 0 THEN 'X' ELSE 'N' END AS welcome_offer,
        'B' || CAST(k % 6 AS VARCHAR) AS bill_code,
        CASE WHEN k % 30 = 1 AND dt > DATE '1998-05-15' THEN '0P' ELSE '1P' END AS play_type,
        CASE WHEN k % 100 = 99 THEN 'COM' ELSE 'RES' END AS cust_typ_sbb,
        CASE WHEN k % 4 = 0 THEN 'X' ELSE 'N' END AS acp,
        CAST(date_trunc('month', dt) AS DATE) + CAST(k % 5 AS INTEGER) AS bill_from_dte_sbb
    FROM (SELECT c_custkey AS k,
                 CAST(unnest(generate_series(TIMESTAMP '1998-03-31', TIMESTAMP '1998-06-01', INTERVAL 1 DAY)) AS DATE) AS dt
          FROM customer) spine
    WHERE CASE k % 10 WHEN 1 THEN dt <= DATE '1998-05-20'
                      WHEN 2 THEN NOT (dt BETWEEN DATE '1998-04-15' AND DATE '1998-05-09')
                      WHEN 3 THEN dt >= DATE '1998-05-05'
                      WHEN 8 THEN dt <= DATE '1998-05-18'
                      ELSE TRUE END
),
fx_orders AS (
    SELECT k AS account_id, cdate AS dt, cdate AS completed_date, cdate - 2 AS order_start_date,
           substr(reason, 1, 3) AS cease_reason_code, reason AS cease_reason_desc,
           CASE WHEN k % 10 = 3 THEN 'RELOCATION/TRAN ' ELSE 'V_DISCO' END AS order_type,
           'RES' AS account_type, 'COMPLETE' AS order_status,
           CAST(CASE WHEN k % 10 = 3 THEN 0 ELSE (k // 10) % 2 END AS INTEGER) AS lob_vo_count,
           CAST(CASE WHEN k % 10 = 3 THEN 0 ELSE 1 END AS INTEGER) AS lob_bb_count,
           CAST(0 AS INTEGER) AS lob_tv_count
    FROM (SELECT c_custkey AS k,
                 CASE c_custkey % 10 WHEN 1 THEN DATE '1998-05-21' WHEN 8 THEN DATE '1998-05-19'
                      ELSE DATE '1998-05-05' END AS cdate,
                 CASE WHEN c_custkey % 10 = 8 THEN 'NON-PAY'
                      WHEN c_custkey % 10 = 1 THEN (CASE WHEN c_custkey % 3 = 0 THEN 'MIG COAX TO FIB'
                                                        ELSE 'CUSTOMER REQUEST' END) END AS reason
          FROM customer
          WHERE c_custkey % 10 = 1 OR (c_custkey % 10 = 8 AND c_custkey % 20 <> 18)
             OR (c_custkey % 10 = 3 AND c_custkey % 20 = 3)) s
    UNION ALL
    SELECT o_custkey, CAST(o_orderdate AS DATE), CAST(o_orderdate AS DATE), CAST(o_orderdate AS DATE) - 3,
           substr(reason, 1, 3), reason, 'V_DISCO', 'RES',
           CASE WHEN o_orderstatus = 'P' THEN 'PENDING' ELSE 'COMPLETE' END,
           CAST((o_orderkey // 2) % 2 AS INTEGER), CAST(1 AS INTEGER), CAST(o_orderkey % 2 AS INTEGER)
    FROM (SELECT *, CASE o_orderkey % 3 WHEN 0 THEN 'MIG COAX TO FIB' WHEN 1 THEN 'NON-PAY'
                         ELSE 'CUSTOMER REQUEST' END AS reason FROM orders) o
),
fx_master AS (
    SELECT dt, 7870000000 + k AS subsrptn_id, CAST(k // 3 AS BIGINT) AS cust_id,
           DATE '1998-04-20' - CAST(20 + (k * 11) % 900 AS INTEGER)
               + CAST(CASE WHEN k % 7 = 0 THEN date_diff('month', DATE '1997-11-01', dt) * 10 ELSE 0 END AS INTEGER)
               AS subsrptn_actvtn_dt,
           'O' AS cust_sts, 'I' AS acct_type_cd,
           CASE WHEN k % 8 = 7 THEN 'VI' ELSE 'PR' END AS rgn_nm, 'A' AS subsrptn_sts,
           CAST(CASE WHEN k % 13 = 0 AND dt = DATE '1998-04-01' THEN 1 ELSE 0 END AS INTEGER) AS flg_susp_curr_mo,
           CASE WHEN k % 8 = 6 AND dt = DATE '1998-04-01' THEN '1998-04-15'
                WHEN k % 9 = 0 THEN ' ' WHEN k % 9 = 3 THEN NULL ELSE '1997-10-01' END AS lst_susp_dt
    FROM (SELECT c_custkey AS k,
                 CAST(unnest(generate_series(TIMESTAMP '1997-11-01', TIMESTAMP '1998-05-01', INTERVAL 1 MONTH)) AS DATE) AS dt
          FROM customer) m
    WHERE CASE k % 8 WHEN 2 THEN dt <> DATE '1998-05-01'
                     WHEN 3 THEN dt = DATE '1998-05-01'
                     WHEN 4 THEN CASE WHEN k % 16 = 4 THEN dt <> DATE '1998-04-01'
                                      ELSE dt NOT IN (DATE '1998-04-01', DATE '1998-03-01') END
                     WHEN 5 THEN dt NOT IN (DATE '1998-05-01', DATE '1998-04-01')
                     WHEN 6 THEN dt <> DATE '1998-05-01'
                     ELSE TRUE END
),
fx_cancels AS (
    SELECT DATE '1998-04-01' AS dt, 7870000000 + c_custkey AS subsrptn_id, '1998-04-10 08:00:00' AS subsrptn_sts_dt,
           'Contract - Accepted' AS acct_sts_rsn_desc, 'none' AS lst_susp_rsn_desc,
           'I' AS acct_type_cd, 'PR' AS rgn_nm, 'O' AS cust_sts,
           CASE WHEN c_custkey % 16 = 5 THEN 'A' ELSE 'C' END AS subsrptn_sts
    FROM customer WHERE c_custkey % 8 = 5
    UNION ALL
    SELECT DATE '1998-05-01', 7870000000 + c_custkey,
           '1998-05-' || lpad(CAST(c_custkey % 28 + 1 AS VARCHAR), 2, '0') || ' 10:00:00',
           CASE c_custkey % 3 WHEN 0 THEN 'Non Payment' WHEN 1 THEN 'Customer moved' END,
           CASE WHEN c_custkey % 5 = 1 THEN 'FRAUD' WHEN c_custkey % 5 <> 0 THEN 'none' END,
           'I', 'PR', 'O', 'C'
    FROM customer WHERE c_custkey % 8 = 2
    UNION ALL
    SELECT DATE '1998-05-01', 7870000000 + c_custkey, '1998-05-02 09:00:00', 'Lost Equipment', 'none',
           'I', 'PR', 'O', 'C'
    FROM customer WHERE c_custkey % 40 = 2
),
fx_mrc AS (
    SELECT dt, acct_nbr,
           CASE WHEN acct_nbr % 50 = 7 THEN CAST('NaN' AS DOUBLE)
                ELSE CAST(20 + acct_nbr % 30 AS DOUBLE) END AS "mrc/account"
    FROM (SELECT unnest([DATE '1998-04-01', DATE '1998-05-01']) AS dt, acct_nbr
          FROM (SELECT DISTINCT CAST(c_custkey // 3 AS BIGINT) AS acct_nbr FROM customer) p) x
),
fx_prepaid AS (
    SELECT 7870000000 + c_custkey AS subsrptn_id, unnest([DATE '1998-04-01', DATE '1998-05-01']) AS dt,
           'O' AS cust_sts, 'I' AS acct_type_cd, 'PR' AS ba_rgn_nm, 'A' AS subsrptn_sts
    FROM customer WHERE c_custkey % 9 = 4
),
fx_billcodes AS (
    SELECT unnest(['B0', 'B1', 'B4']) AS bill_code
),
fx_events AS (
    SELECT event_id, user_id, event_type, value, ts - INTERVAL 9376 DAY AS ts FROM events
),
fx_interactions AS (
    SELECT CAST(event_id AS VARCHAR) AS interaction_id, user_id AS account_id, user_id AS customer_id,
           'RES' AS account_type, ts AS interaction_start_time,
           CASE WHEN event_id % 2 = 0 THEN 'PHONE' ELSE 'CHAT' END AS interaction_channel,
           'AG' || CAST(event_id % 4 AS VARCHAR) AS interaction_agent_id,
           CASE event_type WHEN 'error' THEN 'HSD Problem' WHEN 'view' THEN 'Cust Service Calls'
                WHEN 'click' THEN 'Upgrade tech' WHEN 'signup' THEN 'Tech Support' END AS interaction_purpose_descrip
    FROM fx_events
),
fx_truckrolls AS (
    SELECT ts AS create_dte_ojb, 'J' || CAST(event_id AS VARCHAR) AS job_no_ojb, user_id AS sub_acct_no_sbb
    FROM fx_events WHERE event_type = 'error' AND event_id % 5 = 0
),
fx_payments AS (
    SELECT user_id AS account_id, CAST(ts AS DATE) AS dt, value AS payment_amt_usd
    FROM fx_events WHERE event_type = 'purchase'
),
fx_orderlines AS (
    SELECT o_custkey AS account_id, 'OPCO' AS org_id, 'PR' AS org_cntry, 'COMPLETE' AS order_status,
           CASE WHEN l_linenumber % 2 = 1 THEN 'CONNECT' ELSE 'CHANGE' END AS command_id,
           o_orderdate AS order_start_date, l_shipdate AS completed_date
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey
)
"""
