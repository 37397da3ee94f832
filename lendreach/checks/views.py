"""The driver's tables seen as domain tables.

Each view is a plain SELECT, given once and rendered for Spark and for DuckDB, so both sides
start from the same rows; operators and oracles never see the raw names. Where the two differ
(date arithmetic, generated rows) a :class:`Dialect` supplies the words.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from lendreach.operators import calendar as cal_ops
from lendreach.operators.ranking import sequence_number
from lendreach.session import cut_lean

RUN_DATE = dt.date(1998, 3, 2)          # a Monday
EVENT_RUN = dt.datetime(1998, 1, 20, 12, 0)  # events shifted into the orders' years
EVENT_SHIFT = 9496                       # days from 1998-01-01 to 2024-01-01
FIRST_DAY, LAST_DAY = dt.date(1995, 1, 1), dt.date(2001, 12, 31)

INTERNAL_DOMAINS = ("internal.example.com",)
INTERNAL_PREFIXES = ("seed",)
PLACEHOLDERS = ("9999999999", "0000000000", "(999)999-9999")
REMAP = (("NATION_5", "MACHINERY", "BAS", "MACHINERY-BAS"),
         ("NATION_5", "MACHINERY", "NCP", "MACHINERY-NCP"))
FLAT = ("FURNITURE",)

RAW = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


class Dialect:
    def __init__(self, spark: bool):
        self.spark = spark

    def addmin(self, ts: str, n: str) -> str:
        return f"timestampadd(MINUTE, {n}, {ts})" if self.spark else f"({ts} + to_minutes({n}))"

    def adddays(self, d: str, n: str) -> str:
        return f"date_add({d}, {n})" if self.spark else f"({d} + CAST({n} AS INTEGER))"

    def rows(self, values: str) -> str:
        return f"explode(array({values}))" if self.spark else f"unnest([{values}])"

    def back(self, ts: str) -> str:
        return (f"timestampadd(DAY, -{EVENT_SHIFT}, {ts})" if self.spark
                else f"({ts} - INTERVAL {EVENT_SHIFT} DAY)")


def _dec(c: str) -> str:
    return f"CAST({c} AS DECIMAL(18,2))"


def _texts(d: Dialect) -> dict[str, tuple[str, str]]:
    """name -> (views it reads, SELECT)."""
    price = "o_totalprice"
    digit = "CAST(substr(o_orderpriority, 1, 1) AS BIGINT)"
    minutes = f"least(CAST(floor({price} / 350) AS INT), 1439)"
    received = d.addmin("o_orderdate", minutes)
    origin = d.addmin(received, f"CAST(floor({price} / 60) AS INT)")
    withdrawn = d.addmin(received, f"CAST(floor({price} / 40) AS INT)")
    money = _dec(price)
    approved = _dec(f"{money} * 0.01")
    email = ("replace(lower(c_name), '#', '.') || '@' || CASE WHEN n_nationkey = 24 THEN "
             "'internal.example.com' WHEN n_nationkey = 23 THEN 'seed.example.com' "
             "WHEN n_regionkey = 0 THEN 'mail.example.com' WHEN n_regionkey = 1 THEN 'example.org' "
             "WHEN n_regionkey = 2 THEN 'example.net' WHEN n_regionkey = 3 THEN 'example.co.uk' "
             "ELSE 'example.xyz' END")
    loan_status = (f"CASE WHEN o_orderstatus = 'P' THEN 'pending' WHEN o_orderstatus = 'O' THEN "
                   f"'withdrawn' WHEN {price} < 200000 THEN 'paid off' WHEN {price} < 300000 THEN "
                   f"'originated' WHEN {price} < 360000 THEN 'pending paid off' WHEN {price} < "
                   f"400000 THEN 'default' WHEN {price} < 430000 THEN 'charged off' "
                   f"ELSE 'returned item' END")
    freq = ("CASE WHEN c_acctbal < 2000 THEN 'B' WHEN c_acctbal < 5000 THEN 'S' "
            "WHEN c_acctbal < 8000 THEN 'W' ELSE 'M' END")
    cell = ("CASE WHEN c_acctbal < 500 THEN '9999999999' WHEN c_acctbal < 1000 THEN '0000000000' "
            "WHEN c_acctbal < 1500 THEN ' ' WHEN c_acctbal < 2000 THEN NULL "
            "ELSE '556' || lpad(CAST(c_custkey AS STRING), 7, '0') END")
    home = "'555' || lpad(CAST(c_custkey AS STRING), 7, '0')"
    last_pay = d.adddays("CAST(o_orderdate AS DATE)", f"CAST(floor({price} / 4000) AS INT)")
    signed = f"(CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END * {_dec('l_extendedprice')})"
    total = _dec(signed)
    fee = _dec(f"{total} * {_dec('l_discount')}")
    interest = _dec(f"{total} * {_dec('l_tax')}")
    ship = "CAST(l_shipdate AS DATE)"
    legacy_id = f"o_orderkey + CASE WHEN {price} < 250000 THEN 0 ELSE 1000000000 END"
    t = {}
    lead_columns = f"""
      CASE WHEN {digit} <= 2 THEN 'INST' WHEN {digit} <= 4 THEN 'LEGACY' ELSE 'LOC' END AS lms_code,
      o_custkey * 10 + {digit} AS lms_customer_id, o_orderkey AS lms_application_id,
      o_orderkey AS lead_sequence_id, o_orderkey AS original_lead_id,
      CAST(o_orderkey AS STRING) AS loan_number,
      CASE WHEN o_orderstatus = 'F' THEN o_orderkey END AS origination_loan_id,
      {received} AS received_time,
      CASE WHEN o_orderstatus = 'F' THEN {origin} END AS origination_time,
      CASE WHEN o_orderstatus = 'O' THEN {withdrawn} END AS withdrawn_time,
      CASE WHEN o_orderstatus = 'F' THEN {last_pay} END AS last_paymentdate,
      CASE WHEN o_orderstatus = 'F' THEN {d.adddays(f"CAST({origin} AS DATE)", '1')} END AS effective_date,
      n_name AS state, c_mktsegment AS product, n_nationkey AS lms_entity_id,
      CASE WHEN c_acctbal > 4500 THEN 'STORE BAS' ELSE 'STORE NCP' END AS storename,
      CASE WHEN {price} BETWEEN 440000 AND 470000 THEN 1 ELSE 0 END AS isexpress,
      CASE WHEN {price} > 470000 THEN 0 ELSE 1 END AS isuniqueaccept,
      CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS isoriginated,
      CASE WHEN {price} < 3000 THEN 1 ELSE 0 END AS isapplicationtest,
      CASE o_orderstatus WHEN 'P' THEN 'pending' WHEN 'F' THEN 'originated' ELSE 'withdrawn' END AS application_status,
      {loan_status} AS loan_status,
      CASE WHEN o_orderstatus = 'O' THEN CAST(floor({price} / 16000) AS INT) END AS withdrawn_reason_code,
      CASE WHEN o_orderstatus = 'O' THEN 'reason ' || CAST(CAST(floor({price} / 16000) AS INT) AS STRING) END AS withdrawn_reason,
      {email} AS emailaddress,
      CASE WHEN c_acctbal > 9800 THEN NULL WHEN c_acctbal < 0 THEN 0 ELSE 1 END AS email_marketingoptin,
      lower(c_name) AS customer_firstname, c_mktsegment AS customer_lastname,
      CASE WHEN {price} < 60000 THEN NULL ELSE {_dec(f'{money} * 0.02')} END AS requested_amount,
      {approved} AS approved_amount, {_dec('c_acctbal')} AS paycheck,
      {_dec(f'{money} * 0.015')} AS maxloanlimit, {freq} AS pay_frequency,
      CASE {digit} WHEN 2 THEN 'WEB-DM' WHEN 4 THEN 'MOB-#TAG#' WHEN 1 THEN 'WEB' END AS campaign_name,
      CASE WHEN n_regionkey = 0 THEN 'Own Web' ELSE 'Provider ' || CAST(n_regionkey AS STRING) END AS provider_name,
      n_regionkey AS lead_provider_id,
      upper(substr(c_mktsegment, 1, 4)) || lpad(CAST(c_custkey AS STRING), 7, '0') AS affid,
      's' || CAST(n_nationkey AS STRING) AS subid,
      {_dec(f'{money} * 0.0001')} AS lead_cost,
      o_custkey AS person_id"""
    placed = "orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"
    t["leads0"] = ("", f"""SELECT{lead_columns}
      FROM {placed}""")
    # Spark numbers the applications before their columns are made of the raw ones, which are fewer to move
    t["lead_rows"] = ("", f"""SELECT o_custkey * 10 + {digit} AS lms_customer_id, o_orderkey AS lms_application_id,
      {received} AS received_time, o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
      c_name, c_nationkey, c_acctbal, c_mktsegment, c_custkey, n_name, n_nationkey, n_regionkey FROM {placed}""")
    t["numbered"] = ("", f"""SELECT{lead_columns}, loan_sequence, CASE WHEN loan_sequence > 1 THEN 1 ELSE 0 END AS isreturning
      FROM lead_numbers""")
    t["loans"] = ("", f"""SELECT o_orderkey AS base_loan_id, o_orderkey AS loan_header_id,
      o_custkey * 10 + {digit} AS customer_id, {loan_status} AS loan_status,
      CASE WHEN {price} < 360000 THEN 1 ELSE 0 END AS is_paying,
      CASE WHEN {price} < 200000 THEN {last_pay} END AS paid_off_date,
      {d.adddays("CAST(o_orderdate AS DATE)", '30')} AS due_date
      FROM orders WHERE o_orderstatus = 'F'""")
    t["schedules"] = ("", f"""SELECT o_orderkey AS payment_schedule_id, o_orderkey AS base_loan_id,
      o_custkey * 10 + {digit} AS customer_id,
      CASE WHEN {price} < 430000 THEN 1 ELSE 0 END AS is_active,
      CASE WHEN {price} BETWEEN 360000 AND 400000 THEN 1 ELSE 0 END AS is_collections
      FROM orders WHERE o_orderstatus = 'F'""")
    t["items"] = ("", f"""SELECT l_linenumber * CAST(10000000 AS BIGINT) + l_partkey AS payment_schedule_item_id,
      l_orderkey AS payment_schedule_id, {ship} AS item_date,
      CASE WHEN l_linestatus = 'F' AND l_returnflag <> 'N' THEN 'cleared'
           WHEN l_linestatus = 'F' AND l_tax >= 0.06 THEN 'missed' WHEN l_linestatus = 'F' THEN 'return'
           WHEN l_returnflag = 'N' THEN 'scheduled' WHEN l_returnflag = 'A' THEN 'bypass' ELSE 'sent' END AS status,
      CASE WHEN l_quantity < 25 THEN 'NON-ACH' ELSE 'ACH' END AS payment_mode,
      CASE WHEN l_returnflag = 'R' THEN 'C' ELSE 'D' END AS item_type,
      {total} AS total_amount, {_dec(f'{total} - {fee} - {interest}')} AS amount_prin,
      {fee} AS amount_fee, {interest} AS amount_int, l_suppkey FROM lineitem""")
    t["transactions"] = ("items", f"""SELECT payment_schedule_id AS base_loan_id,
      item_date AS trans_date, CASE WHEN item_type = 'D' THEN 'Debit' ELSE 'Credit' END AS trans_type,
      total_amount AS amount, amount_prin AS principal_amount, amount_fee AS fee_amount
      FROM items WHERE status = 'cleared' AND item_type = 'D'
      UNION ALL
      SELECT o_orderkey, CAST(o_orderdate AS DATE), 'Origination', {_dec('-pay')}, {_dec('-pay')},
      CAST(0 AS DECIMAL(18,2)) FROM (SELECT o_orderkey, o_orderdate,
        CASE WHEN o_totalprice < 150000 THEN coalesce(sum(amount_prin), 0) ELSE max({approved}) END AS pay
        FROM orders LEFT JOIN (SELECT payment_schedule_id, amount_prin FROM items
          WHERE status = 'cleared' AND item_type = 'D') p ON o_orderkey = payment_schedule_id
        GROUP BY o_orderkey, o_orderdate, o_totalprice) z""")
    t["legacy_loans"] = ("", f"""SELECT {legacy_id} AS id,
      CASE WHEN {price} < 250000 THEN CAST(0 AS BIGINT) ELSE o_orderkey END AS original_loan_id,
      o_custkey * 10 + {digit} AS debtor_client_id,
      CASE WHEN {price} < 200000 THEN 'paid off loan' WHEN {price} < 330000 THEN 'new loan'
           WHEN {price} < 420000 THEN 'pending paid off' ELSE 'returned item' END AS loan_status,
      n_name AS state, {d.adddays("CAST(o_orderdate AS DATE)", '900')} AS due_date,
      CASE WHEN {price} > 460000 THEN CAST(o_orderdate AS DATE) END AS collection_start_date,
      {approved} AS approved_amount, {_dec(f'{money} * 0.001')} AS approved_fee
      FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
      WHERE substr(o_orderpriority, 1, 1) IN ('3', '4') AND o_orderstatus = 'F'""")
    t["legacy_payments"] = ("", f"""SELECT {legacy_id} AS loan_id, {ship} AS effective_date,
      CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END AS is_debit,
      CASE WHEN l_linestatus = 'F' AND l_returnflag = 'N' THEN 'rejected' WHEN l_linestatus = 'F' THEN 'checked'
           WHEN l_returnflag = 'N' THEN 'pending' WHEN l_returnflag = 'A' THEN 'none' ELSE 'notchecked' END AS payment_status,
      {_dec('l_extendedprice')} AS payment_amount,
      {_dec(f"{_dec('l_extendedprice')} * 0.9")} AS principle
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey
      WHERE substr(o_orderpriority, 1, 1) IN ('3', '4') AND o_orderstatus = 'F'""")
    t["accounts"] = ("", f"""SELECT c_custkey * 10 + 5 AS acct_id,
      lpad(CAST(c_custkey * 10 + 5 AS STRING), 12, '0') AS account_number,
      {_dec('abs(c_acctbal) + 500')} AS credit_limit,
      {_dec(f"CASE WHEN c_nationkey < 12 THEN {_dec('abs(c_acctbal) + 500')} * 0.25 ELSE 4 END")} AS current_balance,
      {_dec(f"CASE WHEN c_nationkey < 12 THEN {_dec('abs(c_acctbal) + 500')} * 0.20 ELSE 3 END")} AS principal,
      {_dec(f"CASE WHEN c_acctbal < 0 THEN 0 ELSE {_dec('abs(c_acctbal)')} * 0.1 END")} AS amount_due,
      {d.adddays("DATE '1998-03-01'", 'c_nationkey')} AS date_of_total_due,
      CAST(floor(abs(c_acctbal) / 300) AS INT) AS days_delinquent,
      CASE WHEN c_acctbal BETWEEN 3000 AND 4300 THEN 3 WHEN c_acctbal < 6500 THEN 2 ELSE 4 END AS system_status,
      CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 1 ELSE 0 END AS is_after_holiday
      FROM customer""")
    t["loc_txns"] = ("", f"""SELECT o_custkey * 10 + {digit} AS account_number,
      CASE WHEN l_returnflag = 'R' THEN 'Credit' ELSE 'Debit' END AS tran_type,
      {_dec('l_extendedprice')} AS amount, {ship} AS effective_date,
      CASE WHEN l_linestatus = 'F' AND l_returnflag = 'N' THEN {d.adddays(ship, '3')} END AS return_date,
      CASE WHEN l_linestatus = 'F' AND l_returnflag = 'N' THEN 'R' END AS payment_status,
      CASE WHEN l_quantity < 3 THEN 1 ELSE 0 END AS is_collection
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE substr(o_orderpriority, 1, 1) = '5'""")
    page = ("CASE WHEN event_type = 'error' AND value >= 150 THEN 'reject' "
            "WHEN event_type = 'purchase' AND value >= 40 THEN 'payment_schedule_submit' "
            "WHEN event_type = 'purchase' THEN 'account_terms_submit' "
            "WHEN event_type = 'signup' AND value < 10 THEN 'create_password_submit' "
            "WHEN event_type = 'signup' THEN 'welcome' WHEN event_type = 'view' AND value < 20 THEN 'loan_docs-CI' "
            "WHEN event_type = 'view' THEN 'loan_docs-TC' WHEN event_type = 'click' AND value < 20 "
            "THEN 'loan_docs_submit-CI' WHEN event_type = 'click' THEN 'loan_docs_submit-TC' "
            "ELSE 'account_terms' END")
    t["tracking"] = ("", f"""SELECT event_id AS id, {d.back('ts')} AS event_ts, {page} AS page,
      {email} AS user_name, CAST(CAST(ts AS DATE) AS STRING) AS session_id, user_id * 10 + 1 AS lms_customer_id,
      CASE WHEN event_type = 'purchase' AND value >= 150 THEN user_id * 10 + 1 END AS known_id, value
      FROM events JOIN customer ON user_id = c_custkey JOIN nation ON c_nationkey = n_nationkey""")
    t["visits"] = ("", f"""SELECT event_id AS id, {d.back('ts')} AS event_ts, {page} AS page,
      user_id * 10 + 1 AS lms_customer_id, CAST(CAST(ts AS DATE) AS STRING) AS session_id, value FROM events""")
    t["user_info"] = ("", f"""SELECT {email} AS email, lower(c_name) AS firstname, n_name AS state,
      {_dec('c_acctbal')} AS amount FROM customer JOIN nation ON c_nationkey = n_nationkey""")
    t["flat0"] = ("", f"SELECT c_custkey, c_acctbal, {d.rows('1, 2, 3, 4, 5')} AS sys FROM customer")
    t["customer_flat"] = ("flat0", f"""SELECT c_custkey * 10 + sys AS customer_id, {home} AS homephone,
      {cell} AS cellphone, {freq} AS payfrequency, {_dec('abs(c_acctbal)')} AS nmi,
      CASE WHEN c_acctbal < 0 THEN 'true' WHEN c_acctbal < 5000 THEN 'false' END AS optout_account_email,
      CASE WHEN c_acctbal < 1000 THEN 'True' WHEN c_acctbal < 7000 THEN 'false' END AS optout_marketing_email,
      CASE WHEN c_acctbal > 9800 THEN NULL WHEN c_acctbal < 0 THEN 0 ELSE 1 END AS email_marketing_optin,
      CASE WHEN c_acctbal > 9500 THEN NULL WHEN c_acctbal < 2000 THEN 0 ELSE 1 END AS email_operational_optin
      FROM flat0""")
    t["names"] = ("", f"""SELECT id AS notification_name_mapping_id, CASE id WHEN 1 THEN 'SMS_TRANSACTIONAL'
      WHEN 2 THEN 'SMS_MARKETING' ELSE 'PHONE_MARKETING' END AS notification_name
      FROM (SELECT {d.rows('1, 2, 3')} AS id) z""")
    t["notif0"] = ("", f"SELECT c_custkey, c_acctbal, c_nationkey, {d.rows('1, 2, 3')} AS ch FROM customer")
    t["notif1"] = ("notif0", f"SELECT *, {d.rows('1, 2')} AS sys FROM notif0")
    t["notifications"] = ("notif1", f"""SELECT c_custkey * 10 + sys AS customer_id, ch AS notification_name_id,
      CASE WHEN c_acctbal > ch * 1500 THEN 1 WHEN c_acctbal < 0 THEN NULL ELSE 0 END AS state,
      CAST({d.adddays("DATE '1995-01-01'", 'c_nationkey * ch')} AS TIMESTAMP{'_NTZ' if d.spark else ''}) AS first_consent_date_time
      FROM notif1""")
    t["sms_log"] = ("", """SELECT event_id, user_id * 10 + 1 AS customer_id,
      CASE WHEN value < 15 THEN 1 WHEN value < 40 THEN 2 ELSE 3 END AS notification_name_id,
      CASE WHEN event_type = 'error' THEN 'Stop' ELSE 'Yes' END AS message, ts AS event_date FROM events""")
    t["flags"] = ("", """SELECT c_custkey * 10 + 5 AS cust_id,
      CASE WHEN c_acctbal < 3000 THEN 2 WHEN c_acctbal < 6000 THEN 6 ELSE 1 END AS flag_id,
      CASE WHEN c_nationkey < 12 THEN 1 ELSE 0 END AS flag_value FROM customer
      UNION ALL SELECT c_custkey * 10 + 5, 6, CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END FROM customer""")
    t["todo"] = ("", """SELECT l_orderkey AS loan_header_id, CASE l_linenumber WHEN 1 THEN 'e-sig'
      WHEN 2 THEN 'Bank Verification' WHEN 3 THEN 'Spouse Info' WHEN 4 THEN 'Read and Agreed to T&C'
      WHEN 5 THEN 'Other loan Amount' WHEN 6 THEN 'References' ELSE 'Employment Verification Info' END AS todo_name,
      CASE WHEN l_linestatus = 'F' THEN l_shipdate END AS completion_time FROM lineitem""")
    t["application"] = ("leads0", f"""SELECT lead_sequence_id, received_time AS insert_date,
      emailaddress AS email, state, affid, subid, lead_provider_id, lms_customer_id, product, campaign_name,
      CASE WHEN application_status = 'withdrawn' THEN 'REJECT' ELSE 'ACCEPT' END AS decision,
      CASE WHEN application_status <> 'withdrawn' THEN 'accepted' WHEN withdrawn_reason_code < 8 THEN 'Internal Underwriting'
           WHEN withdrawn_reason_code < 16 THEN 'Bad Schema fault' WHEN withdrawn_reason_code < 24 THEN 'Duplicate Customer'
           ELSE 'Other' END AS decision_detail,
      CASE WHEN approved_amount < 1000 THEN CAST(0 AS DECIMAL(18,2)) ELSE {_dec('approved_amount * 0.001')} END AS uw_cost,
      lead_cost, '$1,' || CAST(paycheck AS STRING) AS nmi FROM leads0""")
    t["mail_map"] = ("", f"""SELECT * FROM (VALUES
      (1, 'Auto A', 'AUTO%', DATE '1995-02-01', DATE '1996-06-30', 'DataCo', CAST(0.50 AS DECIMAL(18,2)), CAST(1000 AS BIGINT)),
      (2, 'Auto B', 'AUTO0000%', DATE '1996-07-10', DATE '1998-01-31', 'DataCo', CAST(0.45 AS DECIMAL(18,2)), CAST(2000 AS BIGINT)),
      (3, 'Build', 'build_0%', DATE '1995-01-01', DATE '1997-12-31', 'ListCo', CAST(0.40 AS DECIMAL(18,2)), CAST(1500 AS BIGINT)),
      (4, 'Any 1', '%00001%', DATE '1996-01-01', DATE '2000-12-31', 'ListCo', CAST(0.30 AS DECIMAL(18,2)), CAST(500 AS BIGINT)),
      (5, 'Mach', ' MACH% ', DATE '1997-01-01', DATE '2001-12-31', 'DataCo', CAST(0.35 AS DECIMAL(18,2)), CAST(0 AS BIGINT)),
      (6, 'House', 'HOUS%', DATE '1995-01-01', DATE '1995-06-30', 'ListCo', CAST(0.55 AS DECIMAL(18,2)), CAST(800 AS BIGINT)),
      (7, 'House 2', 'HOUS%', DATE '1995-06-15', DATE '1999-03-31', 'DataCo', CAST(0.52 AS DECIMAL(18,2)), CAST(900 AS BIGINT))
      ) AS v(mapping_id, dm_name, pattern, start_date, expire_date, data_provider, unit_cost, total_mail_count)""")
    t["dm_log"] = ("leads0", f"""SELECT emailaddress AS email, state,
      substr(affid, 1, 4) || substr(affid, 10, 2) AS promo_code, received_time AS validation_date,
      {d.addmin('received_time', '60')} AS create_datetime,
      CASE WHEN application_status = 'withdrawn' THEN 0 ELSE 1 END AS application_status,
      lms_application_id AS log_id FROM leads0""")
    t["pieces"] = ("", """SELECT c_custkey AS piece_id,
      upper(substr(c_mktsegment, 1, 4)) || lpad(CAST(c_custkey AS STRING), 7, '0') AS promotion_code,
      n_name AS state, CASE WHEN c_acctbal > 4000 THEN 1 ELSE 0 END AS is_remail, c_acctbal
      FROM customer JOIN nation ON c_nationkey = n_nationkey""")
    t["entity_params"] = ("", """SELECT n_nationkey AS lms_entity_id, 'entity_name' AS parameter_name,
      CASE WHEN n_nationkey < 3 THEN n_name || ' Monthly' WHEN n_nationkey < 5 THEN 'Trust ' || n_name
      ELSE lpad(CAST(n_nationkey AS STRING), 2, '0') || ' Entity' END AS value FROM nation""")
    t["limits"] = ("", f"""SELECT c_nationkey AS entity_id, {freq} AS pay_frequency,
      CAST(o_orderdate AS DATE) AS effective_date, {money} AS maximum_limit
      FROM orders JOIN customer ON o_custkey = c_custkey""")
    t["rate0"] = ("", f"SELECT n_name, n_nationkey, {d.rows(', '.join(repr(x) for x in ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY', 'MACHINERY-BAS', 'MACHINERY-NCP')))} AS product_code FROM nation WHERE n_nationkey < 21")
    t["rate1"] = ("rate0", f"SELECT *, {d.rows('1, 2, 3, 4, 5, 6, 7')} AS loan_sequence FROM rate0")
    t["rate2"] = ("rate1", "SELECT *, " + d.rows("'B', 'S', 'W', 'M'") + " AS pay_frequency FROM rate1")
    t["rates"] = ("rate2", f"""SELECT n_name AS state_code, product_code, loan_sequence, pay_frequency,
      CAST(0.10 + loan_sequence * 0.05 + CASE WHEN product_code LIKE '%BAS' THEN 0.03 ELSE 0 END AS DECIMAL(18,2)) AS rpp,
      CAST(300 + loan_sequence * 200 + n_nationkey * 10 AS DECIMAL(18,2)) AS hardcap,
      CAST(100 AS DECIMAL(18,2)) AS min_amt FROM rate2""")
    t["history"] = ("leads0", f"""SELECT {d.adddays('CAST(received_time AS DATE)', '1')} AS business_date, 'email' AS channel,
      CASE application_status WHEN 'pending' THEN 'PA' WHEN 'withdrawn' THEN 'WAD' ELSE
        CASE WHEN loan_status = 'paid off' THEN 'POL_NEW' ELSE 'DDR' END END AS list_module,
      lms_code, lms_customer_id, lms_application_id, state, product, emailaddress AS email, received_time,
      customer_firstname, approved_amount, withdrawn_time, last_paymentdate AS last_repayment_date,
      {d.addmin('received_time', 'CASE WHEN isexpress = 1 THEN 3000 ELSE 1440 END')} AS list_generation_time,
      CASE WHEN loan_status IN ('originated', 'pending paid off') THEN
        CASE WHEN approved_amount < 2500 THEN 'DDR3' ELSE 'DDR9' END END AS ddr_type,
      CASE WHEN campaign_name LIKE '%DM%' THEN 1 ELSE 0 END AS extra1,
      CASE WHEN paycheck > 3000 THEN 1 ELSE 0 END AS is_transactional_optin,
      CASE WHEN paycheck > 6000 THEN 1 ELSE 0 END AS is_sms_marketing_optin FROM leads0""")
    t["stats"] = ("", f"""SELECT {ship} AS report_date, l_returnflag || '_' || l_linestatus AS category,
      CAST(l_quantity AS BIGINT) * 4 AS requests, CAST(l_quantity AS BIGINT) * 3 - l_linenumber AS delivered,
      CAST(l_quantity AS BIGINT) AS unique_opens, CAST(l_linenumber AS BIGINT) AS unique_clicks,
      CAST(CASE WHEN l_tax > 0.05 THEN 1 ELSE 0 END AS BIGINT) AS unsubscribes,
      CAST(CASE WHEN l_discount > 0.08 THEN 1 ELSE 0 END AS BIGINT) AS bounces FROM lineitem""")
    ten = "lpad(CAST(user_id AS STRING), 7, '0')"
    t["calls"] = ("", f"""SELECT event_id AS id, '(' || CASE WHEN event_type = 'view' THEN '555' ELSE '556' END || ')' ||
      substr({ten}, 1, 3) || '-' || substr({ten}, 4, 4) AS called_ani, {d.back('ts')} AS call_start_time FROM events""")
    t["seeds"] = ("", """SELECT * FROM (VALUES
      ('seed.one@example.com', 'Seed', 'One', CAST(100 AS DECIMAL(18,2)), CAST(100 AS DECIMAL(18,2)), 'check', 1),
      ('seed.two@example.com', 'Seed', 'Two', CAST(200 AS DECIMAL(18,2)), CAST(200 AS DECIMAL(18,2)), 'check', 1),
      ('seed.off@example.com', 'Seed', 'Off', CAST(300 AS DECIMAL(18,2)), CAST(300 AS DECIMAL(18,2)), 'off', 0)
      ) AS v(email_address, first_name, last_name, request_loan_amount, approved_amount, comments, is_active)""")
    t["labels_map"] = ("", """SELECT * FROM (VALUES ('A_F', 'AC'), ('N_F', 'PA'), ('R_F', 'PA'),
      ('N_O', 'WAD'), ('A_O', 'AC')) AS v(name, label)""")
    return t


_SPARK = _texts(Dialect(True))
_DUCK = _texts(Dialect(False))

_DUCK["leads"] = ("leads0", """SELECT *, CASE WHEN loan_sequence > 1 THEN 1 ELSE 0 END AS isreturning
  FROM (SELECT *, CAST(row_number() OVER (PARTITION BY lms_customer_id
        ORDER BY received_time, lms_application_id) AS INT) AS loan_sequence FROM leads0) z""")
_DUCK["days"] = ("", f"""SELECT CAST(d AS DATE) AS ori_date FROM generate_series(
  TIMESTAMP '{FIRST_DAY}', TIMESTAMP '{LAST_DAY}', INTERVAL 1 DAY) g(d)""")
_DUCK["holidays"] = ("days", """SELECT ori_date AS holiday, CASE
  WHEN month(ori_date) = 1 THEN 'New Year''s Day' WHEN month(ori_date) = 7 THEN 'Independence Day'
  WHEN month(ori_date) = 12 THEN 'Christmas' WHEN month(ori_date) = 9 THEN 'Labor Day'
  ELSE 'Thanksgiving Day' END AS description FROM days
  WHERE (month(ori_date) = 1 AND day(ori_date) = 1) OR (month(ori_date) = 7 AND day(ori_date) = 4)
  OR (month(ori_date) = 12 AND day(ori_date) = 25)
  OR (month(ori_date) = 9 AND isodow(ori_date) = 1 AND day(ori_date) <= 7)
  OR (month(ori_date) = 11 AND isodow(ori_date) = 4 AND day(ori_date) BETWEEN 22 AND 28)""")
_DUCK["cal0"] = ("days holidays", """SELECT ori_date, CASE WHEN isodow(ori_date) >= 6 THEN 1 ELSE 0 END AS weekend,
  CASE WHEN holiday IS NOT NULL THEN 1 ELSE 0 END AS holiday FROM days LEFT JOIN holidays ON ori_date = holiday""")
_DUCK["cal"] = ("cal0", """SELECT *, coalesce(max(CASE WHEN weekend + holiday = 0 THEN ori_date END)
  OVER (ORDER BY ori_date ROWS UNBOUNDED PRECEDING), ori_date) AS operation_date,
  coalesce(max(CASE WHEN weekend + holiday = 0 THEN ori_date END)
  OVER (ORDER BY ori_date ROWS UNBOUNDED PRECEDING), ori_date) AS pre_target_date,
  coalesce(min(CASE WHEN weekend + holiday = 0 THEN ori_date END)
  OVER (ORDER BY ori_date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), ori_date) AS post_target_date FROM cal0""")


# Written once per session and folder, then read like any table: the applications (their loan
# sequence needs a shuffle of every row) and the calendar (one row per day).
STORED = ("leads", "cal", "holidays")
_written: dict[tuple[str, str, str], DataFrame] = {}


class Views:
    """Domain views for one data folder on Spark; each is built on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._made: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._made:
            self._made[name] = self._stored(name) if name in STORED else self._build(name)
        return self._made[name]

    def _stored(self, name: str) -> DataFrame:
        key = (self.spark.sparkContext.applicationId, self.sf_dir, name)
        if key not in _written:
            _written[key] = cut_lean(self._build(name), name)
        return _written[key]

    def _build(self, name: str) -> DataFrame:
        if name in RAW:
            return self.raw(name)
        if name == "leads":
            return self.spark.sql(_swap(_SPARK["numbered"][1], "lead_numbers"), lead_numbers=sequence_number(
                self.lead_rows, ["lms_customer_id"], "received_time", ["lms_application_id"], "loan_sequence"))
        if name == "days":
            return cal_ops.days(self.spark, FIRST_DAY, LAST_DAY)
        if name == "holidays":
            m, d, w = "month(ori_date)", "day(ori_date)", "weekday(ori_date)"
            return self.days.selectExpr("ori_date AS holiday", f"""CASE
                WHEN {m} = 1 AND {d} = 1 THEN "New Year's Day"
                WHEN {m} = 7 AND {d} = 4 THEN 'Independence Day'
                WHEN {m} = 12 AND {d} = 25 THEN 'Christmas'
                WHEN {m} = 9 AND {w} = 0 AND {d} <= 7 THEN 'Labor Day'
                WHEN {m} = 11 AND {w} = 3 AND {d} BETWEEN 22 AND 28 THEN 'Thanksgiving Day'
                END AS description""").filter("description is not null")
        if name == "cal":
            return cal_ops.build_calendar(self.days, self.holidays)
        needs, text = _SPARK[name]
        used = [v for v in (*RAW, *_SPARK) if v != name and _mentions(text, v)]
        for v in used:
            text = _swap(text, v)
        return self.spark.sql(text, **{v: getattr(self, v) for v in used})


def _mentions(text: str, view: str) -> bool:
    return any(f"{w} {view}{end}" in text for w in ("FROM", "JOIN") for end in (" ", "\n", ")")) or \
        any(text.endswith(f"{w} {view}") for w in ("FROM", "JOIN"))


def _swap(text: str, view: str) -> str:
    for w in ("FROM", "JOIN"):
        for end in (" ", "\n", ")"):
            text = text.replace(f"{w} {view}{end}", f"{w} {{{view}}}{end}")
        if text.endswith(f"{w} {view}"):
            text = text[: -len(view)] + f"{{{view}}}"
    return text


def duck(views: str, select: str) -> str:
    """A SELECT for DuckDB preceded by the views it names, in order of need."""
    done: dict[str, str] = {}

    def add(name: str) -> None:
        if name in done or name in RAW:
            return
        needs, text = _DUCK[name]
        for n in needs.split():
            add(n)
        done[name] = text
    for v in views.split():
        add(v)
    body = select.strip()
    if body.upper().startswith("WITH "):
        body = body[5:]
        glue = ",\n"
    else:
        glue = "\n"
    ctes = ",\n".join(f"{n} AS ({t})" for n, t in done.items())
    return (f"WITH {ctes}{glue}{body}" if done else (("WITH " + body) if glue == ",\n" else body))
