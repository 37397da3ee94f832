"""Campaign lists, run for every allowed run date the tables span (a back-fill), or, where a
list looks back without limit, for one fixed run date over the whole history."""

import datetime as dt
import re

from pyspark.sql import functions as F

from lendreach.checks.common import (CONSENT, CONSENT_VIEWS, CTX, D, EVENT_CTX, MAX_LIMIT, EVERY,
                                     NAMED, NEXT_LIMIT, OK, OK0, OK01, OK1, OPTIN_COLS, PLACE, REACT,
                                     REASONS, RULES, RUNS, TS, USABLE, VARIANT, head, weekday_runs, nc,
                                     optin, runs)
from lendreach.checks.q_rows import ROTA, ROTA_SQL
from lendreach.checks.registry import dbl, query
from lendreach.checks.views import PLACEHOLDERS
from lendreach.context import RunContext
from lendreach.operators import calendar as cal_ops
from lendreach.operators.limits import limit_by_state
from lendreach.plans import abandoned as ab
from lendreach.plans import credit_line, due, paid_off, pending, service, withdrawn
from lendreach.session import fresh_path

# ---- due reminders ---------------------------------------------------------------------------

TARGETS = """tgt AS (SELECT run_date, unnest([
  CASE WHEN isodow(run_date) <= 2 THEN run_date + 3 ELSE run_date + 5 END,
  CASE WHEN isodow(run_date) = 1 THEN run_date + 11 ELSE run_date + 13 END]) AS target, unnest(['DDR3', 'DDR9']) AS ddr_type, 0 AS late FROM runs
  UNION ALL SELECT run_date, run_date + 7, '', 1 FROM runs)"""
DUE = f"""due AS (SELECT i.*, t.run_date, t.ddr_type, t.late, b.base_loan_id, a.* EXCLUDE (loan_status) FROM items i JOIN tgt t ON i.item_date = t.target
  JOIN schedules s ON s.payment_schedule_id = i.payment_schedule_id AND is_active = 1 AND is_collections = 0
  JOIN loans b ON b.base_loan_id = s.base_loan_id AND is_paying = 1
  JOIN leads a ON b.customer_id = a.lms_customer_id AND b.loan_header_id = a.lms_application_id
  WHERE (i.status = 'scheduled' OR (payment_mode = 'NON-ACH' AND i.status = 'bypass')) AND total_amount > 0
  AND lms_code = 'INST' AND a.loan_status NOT IN ('default', 'paid off') AND {OK0})"""


def ins_job(suffix):
    return (f"CASE WHEN state IN ('NATION_4', 'NATION_6') THEN 'ALOC' ELSE 'INS' END || strftime(run_date, '%m%d%Y') || '{suffix}' AS job_id")


@query("L01_list_due_instalment", "leads items schedules loans cal", f"""WITH {RUNS}, {TARGETS}, {DUE} SELECT DISTINCT {head('DDR', jobs=ins_job('DDR'))}, origination_time,
  CAST(approved_amount AS DOUBLE) AS original_loan_amount, item_date AS ach_date, CAST(total_amount AS DOUBLE) AS ach_debit, CAST(amount_fee AS DOUBLE) AS ach_finance,
  CAST(amount_prin AS DOUBLE) AS ach_principal, ddr_type, base_loan_id AS origination_loan_id FROM due WHERE late = 0""")
def _(v):
    return due.list_due_instalment(v.leads, v.loans, v.schedules, v.items, runs(v), RULES, "INST",
                                   ("NATION_4", "NATION_6"))


LEGACY_BAD = "('pending application', 'deleted', 'denied', 'withdrawn application', 'voided new loan', 'voided renewed loan', 'paid off loan', 'returned item')"


@query("L02_list_due_legacy", "leads legacy_loans legacy_payments cal", f"""WITH {RUNS}, {TARGETS} SELECT DISTINCT {head('DDR', jobs="strftime(run_date, '%m%d%Y') || 'DDR' AS job_id")}, origination_time,
  CAST(a.approved_amount AS DOUBLE) AS original_loan_amount, CASE WHEN late = 1 THEN l_due ELSE p.effective_date END AS ach_date,
  CAST(CASE WHEN late = 1 THEN l_amount + l_fee ELSE payment_amount END AS DOUBLE) AS ach_debit, ddr_type, a.lms_application_id AS origination_loan_id
  FROM legacy_payments p JOIN tgt ON p.effective_date = target
  JOIN (SELECT id, CASE WHEN original_loan_id = 0 THEN id ELSE original_loan_id END AS root, debtor_client_id, due_date AS l_due, approved_amount AS l_amount, approved_fee AS l_fee
    FROM legacy_loans WHERE loan_status NOT IN {LEGACY_BAD} AND collection_start_date IS NULL) l ON p.loan_id = l.id
  JOIN leads a ON a.lms_customer_id = debtor_client_id AND a.lms_application_id = root
  WHERE is_debit = 1 AND payment_status IN ('pending', 'none') AND a.loan_status NOT IN {LEGACY_BAD} AND l_due > run_date
  AND late = CASE WHEN state IN ('NATION_2', 'NATION_8', 'NATION_12') THEN 1 ELSE 0 END AND {OK0}""")
def _(v):
    return due.list_due_legacy(v.leads, v.legacy_loans, v.legacy_payments, runs(v), RULES,
                               ("NATION_2", "NATION_8", "NATION_12"))


@query("L03_list_due_loc", "leads accounts cal", f"""WITH {RUNS}, {TARGETS} SELECT DISTINCT {head('DDR', jobs='''CASE WHEN state = 'NATION_3' AND CAST(origination_time AS DATE) < DATE '1996-05-24' THEN 'BMD'
  WHEN CAST(origination_time AS DATE) < DATE '1996-05-24' THEN 'BLOC' ELSE 'ALOC' END || strftime(run_date, '%m%d%Y') || 'DDR' AS job_id''')}, origination_time, ach_date, CAST(amount_due AS DOUBLE) AS ach_debit, ddr_type,
  lms_application_id AS origination_loan_id FROM (SELECT acct_id, amount_due, CASE WHEN is_after_holiday = 1 THEN post_target_date ELSE pre_target_date END AS ach_date
    FROM accounts LEFT JOIN cal ON ori_date = date_of_total_due WHERE amount_due <> 0) p JOIN tgt ON ach_date = target AND late = 0
  JOIN leads ON acct_id = lms_customer_id WHERE origination_time IS NOT NULL AND state <> 'NATION_20' AND {OK0}""")
def _(v):
    acc = v.accounts.withColumnRenamed("acct_id", "account_id")
    return due.list_due_loc(v.leads, acc, v.cal, runs(v), RULES, "NATION_3",
                            dt.date(1996, 5, 24), "NATION_20")


OWED = "(SELECT base_loan_id AS ol, sum(-principal_amount) AS principal_owed, sum(-fee_amount) AS fee_owed FROM transactions GROUP BY 1)"


@query("L04_list_due_payoff", "leads items schedules loans transactions cal", f"""WITH {RUNS}, {TARGETS}, {DUE},
  z AS (SELECT due.*, CAST(CASE WHEN lms_entity_id = 4 AND cf = 0 THEN approved_amount * 2 WHEN lms_entity_id = 6 AND cf = 0 THEN approved_amount * 1.2 ELSE cf END AS DECIMAL(18,2)) AS original_fee,
    50 + lms_entity_id AS refund_percent, principal_owed, fee_owed FROM due
    LEFT JOIN (SELECT o_orderkey AS fl, CAST(CASE WHEN o_totalprice < 250000 THEN 0 ELSE 150 END AS DECIMAL(18,2)) AS cf FROM orders) f ON fl = base_loan_id
    LEFT JOIN {OWED} o ON ol = base_loan_id
    WHERE late = 1 AND state IN ('NATION_4', 'NATION_6', 'NATION_10', 'NATION_16') AND NOT EXISTS (SELECT 1 FROM items p WHERE p.payment_schedule_id = due.payment_schedule_id
      AND p.total_amount > 0 AND p.status IN ('cleared', 'sent', 'pending', 'return', 'missed', 'correction') AND p.item_date < due.item_date)),
  y AS (SELECT *, CAST(original_fee * refund_percent / 100 AS DECIMAL(18,2)) AS rebate_amount FROM z)
  SELECT DISTINCT {head('DDR', jobs=ins_job('DDR5'))}, item_date AS ach_date, CAST(total_amount AS DOUBLE) AS ach_debit, CAST(original_fee AS DOUBLE) AS original_fee,
  CASE WHEN pay_frequency = 'M' THEN 4 WHEN pay_frequency IN ('S', 'W', 'B') THEN 14 END AS number_of_installment, CAST(rebate_amount AS DOUBLE) AS rebate_amount,
  CAST(amount_int AS DOUBLE) AS ach_interest, CAST(fee_owed - rebate_amount AS DOUBLE) AS fee_outstanding,
  CAST(principal_owed + amount_int + (fee_owed - rebate_amount) AS DOUBLE) AS pif_amount, base_loan_id AS origination_loan_id FROM y""")
def _(v):
    fees = v.orders.selectExpr("o_orderkey AS base_loan_id",
                               "CAST(CASE WHEN o_totalprice < 250000 THEN 0 ELSE 150 END AS DECIMAL(18,2)) AS capitalized_fees")
    refunds = v.nation.selectExpr("n_nationkey AS entity_id", "1 AS timespan",
                                  "CAST(50 + n_nationkey AS DECIMAL(5,0)) AS refund_percent")
    return due.list_due_payoff(v.leads, v.loans, v.schedules, v.items, v.transactions, refunds, fees,
                               runs(v), RULES, "INST",
                               ("NATION_4", "NATION_6", "NATION_10", "NATION_16"), {4: 2.0, 6: 1.2},
                               ("NATION_4", "NATION_6"))


# ---- pending ---------------------------------------------------------------------------------

def still_open(day):
    return f"""NOT EXISTS (SELECT 1 FROM leads la2 WHERE la2.lms_customer_id = la.lms_customer_id
  AND la2.application_status IN ('withdrawn', 'withdraw', 'originated', 'approve') AND CAST(la2.received_time AS DATE) >= CAST({day} AS DATE))"""


def carded(src, cap=True, remap=True, step=0):
    seq = f"least({src}.loan_sequence + {step}, 7)" if cap else f"{src}.loan_sequence + {step}"
    prod = VARIANT if remap else "product"
    return (f"{src} LEFT JOIN (SELECT state_code, product_code, loan_sequence AS rseq, pay_frequency AS rfreq, rpp, hardcap, min_amt FROM rates) r "
            f"ON state = state_code AND {prod} = product_code AND {seq} = rseq")


SEQ_NEW, SEQ_RC = "loan_sequence = 1 AND isreturning = 0", "loan_sequence > 1 AND isreturning = 1"
MIN_EXTRA = f"CAST(coalesce(requested_amount, approved_amount) AS DOUBLE) AS requested_amount, {MAX_LIMIT} AS max_loan_limit"
WIN1 = "win AS (SELECT run_date, operation_date AS std, run_date - 1 AS fin FROM runs JOIN cal ON ori_date = run_date - 1)"
WIN2 = """win AS (SELECT run_date, operation_date AS std, CASE WHEN isodow(run_date) = 1 THEN run_date - 4 ELSE run_date - 2 END AS fin
  FROM runs JOIN cal ON ori_date = CASE WHEN isodow(run_date) IN (3, 4, 5) THEN run_date - 2 ELSE run_date - 4 END)"""
KEY_WORDS = {("INST", "FURNITURE"): "application", ("INST", "BUILDING"): "Installment Loan application", ("LOC", None): "Line of Credit application"}
KEY_WORD_SQL = """CASE WHEN lms_code = 'INST' AND product = 'FURNITURE' THEN 'application' WHEN lms_code = 'INST' AND product = 'BUILDING' THEN 'Installment Loan application'
  WHEN lms_code = 'LOC' THEN 'Line of Credit application' ELSE 'application' END AS key_word"""


def window_sql(win, module_new, module_rc):
    parts = []
    for module, seq in ((module_new, SEQ_NEW), (module_rc, SEQ_RC)):
        parts.append(f"""SELECT DISTINCT {head(module)}, {KEY_WORD_SQL}, {MIN_EXTRA}, CAST(approved_amount AS DOUBLE) AS approved_amount, {OPTIN_COLS}
  FROM (SELECT * FROM {carded('leads')} AND leads.pay_frequency = rfreq) la JOIN win ON CAST(received_time AS DATE) BETWEEN std AND fin
  LEFT JOIN optin ON customer_id = lms_customer_id WHERE application_status = 'pending' AND {seq} AND {OK} AND {still_open('la.received_time')}""")
    return f"WITH {NAMED}, {win}, {CONSENT} " + " UNION ALL ".join(parts)


def _windows(v, *args):
    return cal_ops.received_window(v.cal, runs(v, "named"), *args)


@query("L05_list_pending_today", "leads rates cal holidays", f"""WITH {NAMED} SELECT DISTINCT {head('PA_0')}, {MIN_EXTRA} FROM (SELECT * FROM {carded('leads', False, False)} AND leads.pay_frequency = rfreq) la
  JOIN runs ON run_date = CAST(received_time AS DATE) WHERE application_status = 'pending' AND {SEQ_NEW} AND hour(received_time) < 15 AND {OK} AND {still_open('la.received_time')}
  UNION ALL SELECT DISTINCT {head('PA_0')}, {MIN_EXTRA} FROM (SELECT * FROM {carded('leads')} AND leads.pay_frequency = rfreq) la
  JOIN runs ON run_date = CAST(received_time AS DATE) WHERE application_status = 'pending' AND {SEQ_RC} AND hour(received_time) < 15 AND {OK} AND {still_open('la.received_time')}""")
def _(v):
    r = runs(v, "named")
    return pending.list_pending_today(v.leads, v.rates, r, RULES, "PA_0")


@query("L06_list_pending_esign", f"leads rates todo customer_flat cal holidays {CONSENT_VIEWS}", f"""WITH {NAMED}, {CONSENT}, steps AS (SELECT loan_header_id, count(DISTINCT todo_name) AS todo_item_cnt,
  count(*) FILTER (completion_time IS NULL) AS incomplete_cnt, count(*) FILTER (completion_time IS NULL AND todo_name = 'e-sig') AS is_esig_incomplete FROM todo GROUP BY 1)
  SELECT DISTINCT {head('PA0_no_esig')}, {MIN_EXTRA}, CASE WHEN campaign_name LIKE '%DM%' THEN 1 ELSE 0 END AS is_dm, CASE WHEN origination_loan_id > 0 THEN 1 ELSE 0 END AS is_originated,
  todo_item_cnt, incomplete_cnt, is_esig_incomplete, {USABLE} AS cell_phone, {OPTIN_COLS}
  FROM (SELECT * FROM {carded('leads', False, False)} AND leads.pay_frequency = rfreq) la JOIN runs ON run_date = CAST(received_time AS DATE)
  JOIN steps ON loan_header_id = lms_application_id AND incomplete_cnt = 1 AND is_esig_incomplete = 1
  LEFT JOIN (SELECT customer_id AS fc, homephone, cellphone FROM customer_flat) f ON fc = lms_customer_id LEFT JOIN optin ON customer_id = lms_customer_id
  WHERE application_status = 'pending' AND lms_code = 'INST' AND {OK} AND {still_open('la.received_time')}""")
def _(v):
    return pending.list_pending_esign(v.leads, v.rates, v.todo, optin(v), v.customer_flat,
                                      runs(v, "named"), RULES, "INST")


FLAG_SQL = ", ".join(f"coalesce(count(completion_time) FILTER (todo_name = '{k}'), 0) AS {n}" for k, n in pending.TODO_FLAGS.items())
FLAG_COLS = ", ".join(f"coalesce({n}, 0) AS {n}" for n in pending.TODO_FLAGS.values())
ACCOUNTS = ("lead_sequence_id", "isexpress AS no_bank_call", "sha2(concat('s', pay_frequency), 256) AS lms_routing_hash",
            "sha2(concat('s', CASE WHEN isuniqueaccept = 1 THEN pay_frequency ELSE 'x' END), 256) AS app_routing_hash",
            "sha2(concat('s', state), 256) AS lms_account_hash", "sha2(concat('s', state), 256) AS app_account_hash")


def hashed(v):
    """Account hashes of both sides, as a loan system and an application table would hold them."""
    return v.leads0.withColumn("isexpress", F.when(F.col("approved_amount") > 3000, 1).otherwise(0)).selectExpr(*ACCOUNTS)


@query("L07_list_checklist", "leads todo names notifications cal holidays", f"""WITH {NAMED}, steps AS (SELECT loan_header_id, {FLAG_SQL} FROM todo GROUP BY 1),
  st AS (SELECT customer_id, state AS sms_consent FROM notifications JOIN names ON notification_name_id = notification_name_mapping_id WHERE notification_name = 'SMS_TRANSACTIONAL'),
  z AS (SELECT leads.*, run_date, steps.* EXCLUDE (loan_header_id), sms_consent, CASE WHEN approved_amount > 3000 THEN 1 ELSE 0 END AS no_bank_call, CASE WHEN isuniqueaccept = 1 THEN 0 ELSE 1 END AS routing_changed, 0 AS account_changed
   FROM leads JOIN runs ON run_date = CAST(received_time AS DATE) LEFT JOIN steps ON loan_header_id = lms_application_id LEFT JOIN st ON customer_id = lms_customer_id
   WHERE isreturning = 0 AND isexpress = 0 AND {PLACE})
  SELECT DISTINCT {head('PA0_esig_NBV')}, {FLAG_COLS}, coalesce(sms_consent, 0) AS sms_consent, no_bank_call, routing_changed, account_changed,
  CASE WHEN no_bank_call = 0 THEN 'BV' WHEN routing_changed = 1 OR account_changed = 1 THEN 'BV' ELSE 'NBV' END AS bv_final FROM z""")
def _(v):
    st = v.notifications.join(v.names.filter("notification_name = 'SMS_TRANSACTIONAL'"), F.col(
        "notification_name_id") == F.col("notification_name_mapping_id")).select(
        F.col("customer_id").alias("lms_customer_id"), F.col("state").alias("sms_consent"))
    return pending.list_checklist(v.leads, v.todo, st, hashed(v), runs(v, "named"), RULES)


@query("L08_list_pending_first", f"leads rates cal holidays {CONSENT_VIEWS}", window_sql(WIN1, "PA", "PA_RC"))
def _(v):
    return pending.list_pending_window(v.leads, v.rates, optin(v), _windows(v), RULES, "PA", "PA_RC",
                                       KEY_WORDS)


@query("L09_list_pending_second", f"leads rates cal holidays {CONSENT_VIEWS}", window_sql(WIN2, "PA2", "PA2_RC"))
def _(v):
    return pending.list_pending_window(v.leads, v.rates, optin(v), _windows(v, 2, -2, 4, -4), RULES, "PA2", "PA2_RC",
                                       KEY_WORDS)


# ---- withdrawn -------------------------------------------------------------------------------

LIVE = "(SELECT lms_customer_id FROM leads WHERE application_status = 'pending' OR origination_time IS NOT NULL)"
WBASE = f"application_status = 'withdrawn' AND withdrawn_reason_code IN {REASONS} AND loan_sequence = 1 AND isreturning = 0 AND {OK1}"
WEXTRA = """CAST(coalesce(requested_amount, approved_amount) AS DOUBLE) AS requested_amount, CAST(approved_amount AS DOUBLE) AS approved_amount,
  CAST(maxloanlimit AS DOUBLE) AS max_loan_limit, withdrawn_reason, withdrawn_time, {key} AS key_word, CASE WHEN campaign_name LIKE '%DM%' THEN 1 ELSE 0 END AS extra1"""


def last_of(src, module, key):
    return f"""SELECT DISTINCT {head(module)}, {WEXTRA.format(key=key)} FROM (SELECT *, rank() OVER (PARTITION BY run_date, lms_code, lms_customer_id ORDER BY received_time DESC) AS rk
  FROM {src}) q WHERE rk = 1"""


@query("L10_list_withdrawn_range", "leads days", f"""WITH {EVERY}, z AS (SELECT * FROM leads JOIN runs ON isodow(run_date) <= 5 AND CAST(withdrawn_time AS DATE) BETWEEN run_date - 90 AND run_date - 1
  WHERE {WBASE} AND {PLACE} AND lms_customer_id NOT IN {LIVE}) {last_of('z', 'WAD', "CASE WHEN lms_code = 'INST' AND state NOT IN ('NATION_4') THEN 'Installment Loan application' ELSE 'application' END")}""")
def _(v):
    word = F.when((F.col("lms_code") == "INST") & ~F.col("state").isin("NATION_4"),
                  "Installment Loan application").otherwise("application")
    return withdrawn.list_withdrawn_range(v.leads, weekday_runs(v), RULES, word)


@query("L11_list_withdrawn_on_days", "leads days", f"""WITH z AS (SELECT leads.*, ori_date AS run_date, n FROM leads, (SELECT unnest([2, 10, 25]) AS n) k, days
  WHERE CAST(withdrawn_time AS DATE) = ori_date - n AND {WBASE} AND {PLACE} AND lms_customer_id NOT IN {LIVE}) {last_of('z', 'WAD', "'WA' || n")}""")
def _(v):
    days = v.days.select(F.col("ori_date").alias("run_date"))
    return withdrawn.list_withdrawn_on_days(v.leads, days, RULES)


WED = dt.date(1999, 3, 3)


@query("L12_list_withdrawn_aged", "leads", f"""WITH z AS (SELECT *, DATE '{WED}' AS run_date FROM leads WHERE CAST(withdrawn_time AS DATE) <= DATE '{WED}' - 30 AND maxloanlimit > 0
  AND {WBASE} AND {PLACE} AND lms_customer_id NOT IN {LIVE}) {last_of('z', 'WAB', 'CAST(NULL AS VARCHAR)')}""")
def _(v):
    ctx = RunContext(dt.datetime.combine(WED, dt.time(9)))
    return withdrawn.list_withdrawn_aged(v.leads, ctx, RULES)


WIN_STATES = tuple(f"NATION_{n}" for n in range(0, 25) if n != 9)
STATE_OF = """CASE WHEN contains(value, 'NATION_1') THEN 'NATION_1' WHEN contains(value, 'NATION_2') THEN 'NATION_2' WHEN contains(value, 'Trust') THEN NULL ELSE left(value, 2) END"""
CAPS = f"""caps AS (SELECT st AS cap_state, max(maximum_limit) AS maximum_limit_by_state FROM (SELECT l.*, {STATE_OF} AS st, rank() OVER (PARTITION BY entity_id, pay_frequency ORDER BY effective_date DESC) AS rk
  FROM limits l LEFT JOIN entity_params ON lms_entity_id = entity_id) z WHERE rk = 1 GROUP BY 1)"""


def caps(v):
    return limit_by_state(v.limits, v.entity_params, [("NATION_1", "NATION_1"), ("NATION_2", "NATION_2")], ["Trust"])


WCTX = RunContext(dt.datetime(1999, 3, 1, 9))  # a Monday


@query("L13_list_winback", f"leads limits entity_params customer_flat {CONSENT_VIEWS}", f"""WITH {CAPS}, {CONSENT}, own AS (SELECT * REPLACE (lower(lms_code) || '.' || emailaddress AS emailaddress) FROM leads), a AS (SELECT *, rank() OVER (PARTITION BY lms_code, lms_customer_id ORDER BY withdrawn_time DESC) AS rk FROM own
    WHERE application_status = 'withdrawn' AND withdrawn_reason_code IN (1,2,4,5,8,9,10,12,13,16,19,24,25,26,27,32) AND loan_sequence = 1 AND isreturning = 0 AND {OK1} AND {PLACE}
    AND state <> 'NATION_9' AND CAST(withdrawn_time AS DATE) <= DATE '1999-03-01'),
  b AS (SELECT *, row_number() OVER (PARTITION BY emailaddress ORDER BY withdrawn_time DESC, lms_application_id) AS rn FROM a WHERE rk = 1
    AND emailaddress NOT IN (SELECT emailaddress FROM own WHERE application_status = 'pending' OR origination_time IS NOT NULL)),
  c AS (SELECT *, DATE '1999-03-01' AS run_date, date_diff('day', CAST(withdrawn_time AS DATE), DATE '1999-03-01') AS ds FROM b WHERE rn = 1)
  SELECT DISTINCT {head('WA-PRJ')}, CAST(approved_amount AS DOUBLE) AS approved_amount, CAST(maximum_limit_by_state AS DOUBLE) AS max_loan_limit, withdrawn_reason, withdrawn_time, {USABLE} AS cell_phone, {OPTIN_COLS},
  CAST(ds AS INTEGER) AS extra1, CASE WHEN ds <= 365 THEN 'Group1' ELSE 'Group2' END AS key_word FROM c LEFT JOIN caps ON cap_state = state
  LEFT JOIN (SELECT customer_id AS fc, homephone, cellphone FROM customer_flat) f ON fc = lms_customer_id LEFT JOIN optin ON customer_id = lms_customer_id
  WHERE ds > 30 AND regexp_matches(emailaddress, '(com|ca|net|fr|org|us|edu|info|biz|\\.co\\.uk|\\.cn)$') AND (0, CASE WHEN ds <= 365 THEN 'Group1' ELSE 'Group2' END, state) IN (SELECT w, g, s FROM {ROTA_SQL})""")
def _(v):
    own = v.leads.withColumn("emailaddress", F.concat(F.lower("lms_code"), F.lit("."),
                                                      F.col("emailaddress")))
    return withdrawn.list_winback(own, caps(v), optin(v), v.customer_flat,
                                  cal_ops.rota(ROTA, v.spark), WCTX, RULES, WIN_STATES)


@query("L14_list_cross_brand", "leads days", f"""WITH {EVERY}, z AS (SELECT * FROM leads JOIN runs ON CAST(withdrawn_time AS DATE) BETWEEN run_date - 90 AND run_date - 1
  WHERE {WBASE} AND NOT coalesce(state = 'NATION_7' AND product = 'BUILDING', false) AND lms_code <> 'LOC' AND state IN ('NATION_9', 'NATION_11', 'NATION_7') AND maxloanlimit > 0
  AND lms_customer_id NOT IN (SELECT lms_customer_id FROM leads WHERE lms_code <> 'LOC' AND (application_status = 'pending' OR origination_time IS NOT NULL))
  AND emailaddress NOT IN (SELECT emailaddress FROM leads WHERE lms_code = 'LOC')) {last_of('z', 'WA_X', 'CAST(NULL AS VARCHAR)')}""")
def _(v):
    mine, other = v.leads.filter("lms_code <> 'LOC'"), v.leads.filter("lms_code = 'LOC'")
    return withdrawn.list_cross_brand(mine, other, weekday_runs(v), RULES,
                                      ("NATION_9", "NATION_11", "NATION_7"))


# ---- paid off --------------------------------------------------------------------------------

LIMIT_JOIN = f"""LEFT JOIN (SELECT customer_id AS ic, payfrequency, nmi FROM customer_flat) inc ON ic = lms_customer_id"""


def limited(src):
    """Rows of ``src`` with next limit columns."""
    return f"""(SELECT s.*, inc.*, r.*, {VARIANT} AS rate_product FROM {src} s {LIMIT_JOIN}
  LEFT JOIN (SELECT state_code, product_code, loan_sequence AS rseq, pay_frequency AS rfreq, rpp, hardcap, min_amt FROM rates) r
  ON state = state_code AND {VARIANT} = product_code AND least(loan_sequence + 1, 7) = rseq AND payfrequency = rfreq)"""


@query("L15_list_pays_off", "leads loans transactions legacy_loans legacy_payments rates customer_flat cal", f"""WITH {RUNS},
  a AS (SELECT a.* EXCLUDE (effective_date), run_date, p.effective_date, payment_amount FROM legacy_payments p JOIN runs ON run_date = p.effective_date
    JOIN (SELECT id, CASE WHEN original_loan_id = 0 THEN id ELSE original_loan_id END AS root, debtor_client_id FROM legacy_loans WHERE loan_status = 'pending paid off' AND collection_start_date IS NULL) l ON loan_id = id
    JOIN leads a ON a.lms_customer_id = debtor_client_id AND a.lms_application_id = root WHERE payment_status = 'notchecked' AND is_debit = 1 AND {OK0}),
  b AS (SELECT a.*, run_date, amount FROM leads a JOIN loans ON lms_application_id = loan_header_id JOIN (SELECT base_loan_id AS tl, trans_date, amount FROM transactions WHERE trans_type = 'Debit') t ON tl = base_loan_id
    JOIN runs ON run_date = trans_date WHERE a.loan_status = 'pending paid off' AND run_date >= last_paymentdate AND {OK0} AND base_loan_id NOT IN (SELECT base_loan_id FROM schedules0))
  SELECT DISTINCT {head('PO', jobs="strftime(run_date, '%m%d%Y') || 'PO' AS job_id")}, effective_date AS ach_date, CAST(payment_amount AS DOUBLE) AS ach_debit, {NEXT_LIMIT} AS next_loan_limit FROM {limited('a')} x
  UNION ALL SELECT DISTINCT {head('PO', jobs="strftime(run_date, '%m%d%Y') || CASE WHEN state = 'NATION_14' THEN 'POSDJ' ELSE 'POJ' END AS job_id")}, run_date, CAST(amount AS DOUBLE), {NEXT_LIMIT} FROM {limited('b')} x""".replace(
    "(SELECT base_loan_id FROM schedules0)", "(SELECT o_orderkey FROM orders WHERE o_totalprice BETWEEN 355000 AND 400000)"))
def _(v):
    coll = v.orders.filter("o_totalprice between 355000 and 400000").select(
        F.col("o_orderkey").alias("base_loan_id"))
    r = runs(v)
    a = paid_off.list_pays_off_legacy(v.leads, v.legacy_loans, v.legacy_payments, v.rates,
                                      v.customer_flat, r, RULES)
    b = paid_off.list_pays_off(v.leads, v.loans, v.transactions, v.rates, v.customer_flat, coll, r,
                               RULES, [(F.col("state") == "NATION_14", "POSDJ")])
    return a.unionByName(b)


def react(base, bad, extra=""):
    return REACT.format(base=base, bad=bad, extra=extra)


BAD_POL = "'returned item pending paid off', 'charged off pending paid off', 'returned item', 'charged off', 'charged off paid off'"


@query("L16_list_paid_off", "leads loans transactions cal", f"""WITH {EVERY.replace('FROM days', 'FROM cal')}, x AS (SELECT a.*, paid_off_date, CASE WHEN isodow(paid_off_date) > 5 THEN pre_target_date ELSE paid_off_date END AS paid_day
    FROM leads a JOIN loans b ON a.lms_application_id = b.loan_header_id LEFT JOIN cal ON ori_date = paid_off_date WHERE lms_code = 'INST' AND b.loan_status = 'paid off' AND {OK01} AND {PLACE} AND product NOT IN ('HOUSEHOLD')
    AND (SELECT sum(-principal_amount) FROM transactions t WHERE t.base_loan_id = b.base_loan_id) = 0)
  SELECT DISTINCT {head('POL_NEW', jobs="'' AS job_id")}, paid_off_date AS last_repayment_date FROM x JOIN runs ON paid_day BETWEEN run_date - 91 AND run_date WHERE {react('x.last_paymentdate', BAD_POL)}""")
def _(v):
    return paid_off.list_paid_off(v.leads, v.loans, v.transactions, v.cal, weekday_runs(v), RULES, "INST",
                                  skip_products=("HOUSEHOLD",))


GC_CTX = RunContext(dt.datetime(2001, 11, 30, 9))
BAD_GC = "'returned item', 'charged off', 'default', 'default-sld', 'default-bkc', 'default-sif', 'default-frd'"
GOOD = f"""lastl AS (SELECT CASE WHEN original_loan_id = 0 THEN id ELSE original_loan_id END AS k, max(effective_date) AS last_payment_date FROM legacy_loans JOIN legacy_payments ON loan_id = id
    WHERE loan_status NOT IN ('deleted', 'voided renewed loan') AND payment_status = 'checked' AND is_debit = 1 GROUP BY 1),
  lasti AS (SELECT base_loan_id AS k, max(item_date) AS last_payment_date FROM schedules s JOIN items i ON s.payment_schedule_id = i.payment_schedule_id WHERE status = 'cleared' AND total_amount > 0 GROUP BY 1),
  x AS (SELECT leads.*, last_payment_date FROM leads JOIN lastl ON k = lms_application_id WHERE lms_code = 'LEGACY' AND loan_status IN ('paid off loan', 'paid off') AND isoriginated = 1 AND {OK01} AND {PLACE} AND last_payment_date <= DATE '2001-11-30'
    UNION SELECT leads.*, last_payment_date FROM leads JOIN lasti ON k = lms_application_id WHERE lms_code = 'INST' AND loan_status IN ('paid off loan', 'paid off') AND isoriginated = 1 AND {OK01} AND {PLACE} AND last_payment_date <= DATE '2001-11-30'),
  y AS (SELECT *, DATE '2001-11-30' AS run_date, date_diff('day', last_payment_date, DATE '2001-11-30')::INTEGER AS days_since_paid_off,
    CASE WHEN state = 'NATION_3' AND product = 'BUILDING' THEN 'NATION_3_BUILDING' WHEN state = 'NATION_8' AND product = 'MACHINERY' THEN 'NATION_8_MACHINERY' ELSE 'OTHERS' END AS wait_group FROM x WHERE {react('x.last_payment_date', BAD_GC, 'AND la2.lms_code = x.lms_code')}
    AND NOT EXISTS (SELECT 1 FROM leads b WHERE lower(b.emailaddress) = lower(x.emailaddress) AND b.lms_code <> x.lms_code AND (CAST(b.origination_time AS DATE) >= x.last_payment_date
      OR (b.application_status = 'pending' AND CAST(b.received_time AS DATE) >= x.last_payment_date)))),
  z AS (SELECT * FROM y WHERE (wait_group = 'NATION_3_BUILDING' AND days_since_paid_off >= 65) OR (wait_group = 'NATION_8_MACHINERY' AND days_since_paid_off >= 95) OR (wait_group = 'OTHERS' AND days_since_paid_off >= 80))"""
GC_COLS = f"""last_payment_date, days_since_paid_off, CASE WHEN days_since_paid_off <= 45 THEN 'GC Active' WHEN days_since_paid_off <= 180 THEN 'GC Engaged' ELSE 'GC Dormant' END AS gc_group, wait_group,
  {dbl('min_amt hardcap')}, {USABLE} AS cell_phone, {NEXT_LIMIT} AS next_loan_limit"""
GC_FROM = f"FROM {limited('z')} q LEFT JOIN (SELECT customer_id AS fc, homephone, cellphone FROM customer_flat) f ON fc = lms_customer_id"
GC_VIEWS = "leads schedules items legacy_loans legacy_payments rates customer_flat"


def good(v):
    return paid_off.good_customers(
        v.leads, paid_off.last_payment_legacy(v.legacy_loans, v.legacy_payments),
        paid_off.last_payment(v.schedules, v.items), v.rates, v.customer_flat, GC_CTX, RULES, "LEGACY",
        "INST", [("NATION_3", "BUILDING"), ("NATION_8", "MACHINERY")],
        {"NATION_3_BUILDING": 65, "NATION_8_MACHINERY": 95, "OTHERS": 80})


@query("L17_list_good_customers", GC_VIEWS, f"WITH {GOOD} SELECT DISTINCT {head('GC')}, {GC_COLS} {GC_FROM}")
def _(v):
    return paid_off.list_good_customers(good(v), v.customer_flat, RULES)


STATES18 = ", ".join(f"'NATION_{n}'" for n in range(0, 25) if n not in (9, 13))
LOC_CTX = RunContext(dt.datetime(2001, 9, 28, 9))
LD = "DATE '2001-09-28'"
BANDS = lambda a, l, lo: "CASE WHEN {a} >= {l} THEN '100%' ".format(a=a, l=l) + " ".join(
    f"WHEN {a} >= {p / 100:.1f} * {l} THEN '{p}%-{p + 9}%'" for p in range(90, lo - 1, -10)) + f" ELSE '<{lo}%' END"
LOCSUM = f"""tot AS (SELECT account_number, coalesce(sum(CASE WHEN payment_status IS NULL AND tran_type = 'Credit' THEN amount END), 0) AS total_draw_amount,
    count(*) FILTER (payment_status IS NULL AND tran_type = 'Credit') AS total_draw_count, max(CASE WHEN payment_status IS NULL AND tran_type IN ('Debit', 'Write-Off') THEN effective_date END) AS last_payment_date,
    count(*) FILTER (return_date IS NOT NULL AND tran_type = 'Debit') AS default_count, max(CASE WHEN return_date IS NULL AND tran_type = 'Credit' THEN effective_date END) AS last_topup_date,
    CAST(sum(is_collection) AS BIGINT) AS collection_count FROM loc_txns GROUP BY 1),
  ppl AS (SELECT *, row_number() OVER (PARTITION BY lms_customer_id ORDER BY origination_time DESC, lms_application_id DESC) AS rn FROM leads WHERE lms_code = 'LOC' AND isapplicationtest = 0 AND isoriginated = 1 AND state IN ({STATES18})),
  s AS (SELECT {LD} AS run_date, lms_customer_id, lms_application_id, state, {nc('customer_firstname')} AS first_name, emailaddress AS email, pay_frequency, approved_amount, loan_status,
    CAST(origination_time AS DATE) AS origination_date, total_draw_amount, total_draw_count, last_payment_date, default_count, collection_count, current_balance AS total_balance, principal AS principal_balance,
    current_balance - principal AS fee_balance, credit_limit AS max_loan_limit, credit_limit - current_balance AS available_credit_limit,
    CAST(credit_limit - current_balance AS DOUBLE) / CAST(credit_limit AS DOUBLE) AS avail_credit_rate, {BANDS('(credit_limit - current_balance)', 'credit_limit', 60)} AS available_credit_range,
    date_diff('day', last_payment_date, {LD})::INTEGER AS day_since_last_payment, date_diff('day', last_topup_date, {LD})::INTEGER AS day_since_last_topup
    FROM ppl JOIN tot ON account_number = lms_customer_id JOIN (SELECT acct_id, credit_limit, current_balance, principal FROM accounts WHERE system_status IN (2, 4)) a ON acct_id = lms_customer_id
    WHERE rn = 1 AND lms_customer_id NOT IN (SELECT cust_id FROM flags WHERE flag_id = 6 AND flag_value = 1))"""
LOC_MONEY = dbl("approved_amount total_draw_amount total_balance principal_balance fee_balance max_loan_limit available_credit_limit")
LOC_OUT = f"SELECT s.* EXCLUDE (approved_amount, total_draw_amount, total_balance, principal_balance, fee_balance, max_loan_limit, available_credit_limit), {LOC_MONEY} FROM s WHERE default_count = 0 AND collection_count = 0 AND total_draw_count > 0"


def loc(v):
    acc = v.accounts.withColumnRenamed("acct_id", "account_id")
    return credit_line.loc_summary(v.leads, acc, v.loc_txns, v.flags, LOC_CTX, "LOC",
                                   [f"NATION_{n}" for n in range(0, 25) if n not in (9, 13)])


@query("L18_list_loc_good", "leads accounts loc_txns flags", f"""WITH {LOCSUM} {LOC_OUT} AND (available_credit_limit >= 0.6 * max_loan_limit OR available_credit_limit >= 150) AND loan_status = 'originated' AND day_since_last_topup >= 30
  UNION ALL {LOC_OUT} AND principal_balance <= 5 AND day_since_last_payment >= 15 AND loan_status = 'paid off' AND day_since_last_topup > 15""")
def _(v):
    s = loc(v)
    return credit_line.list_loc_good_active(s, "originated").unionByName(
        credit_line.list_loc_good_inactive(s, "paid off"))


PRODUCTS19 = "('AUTOMOBILE', 'BUILDING', 'HOUSEHOLD', 'MACHINERY')"
ITEMSUM = f"""ppl AS (SELECT *, row_number() OVER (PARTITION BY lms_customer_id ORDER BY origination_time DESC, lms_application_id DESC) AS rn FROM leads WHERE lms_code = 'INST' AND isoriginated = 1 AND product IN {PRODUCTS19} AND loan_status = 'originated' AND isapplicationtest = 0),
  tot AS (SELECT payment_schedule_id AS tl, coalesce(sum(CASE WHEN total_amount < 0 THEN amount_prin END) FILTER (status IN ('cleared', 'sent', 'correction')), 0) AS total_draw_amount,
    count(*) FILTER (total_amount < 0 AND status = 'cleared') AS total_draw_count, coalesce(sum(CASE WHEN total_amount > 0 THEN amount_prin END) FILTER (status IN ('cleared', 'correction')), 0) AS total_prin_paid,
    max(CASE WHEN total_amount < 0 AND status = 'cleared' THEN item_date END) AS last_draw_date, max(CASE WHEN total_amount > 0 AND status IN ('cleared', 'correction') THEN item_date END) AS last_payment_date,
    count(*) FILTER (total_amount > 0 AND status IN ('missed', 'return')) AS total_default_count, count(*) FILTER (total_amount > 0) AS total_payment_count
    FROM items WHERE status IN ('missed', 'return', 'cleared', 'correction') AND item_date <= {LD} GROUP BY 1),
  y AS (SELECT *, approved_amount + coalesce(total_draw_amount, 0) + coalesce(total_prin_paid, 0) AS avail FROM ppl LEFT JOIN tot ON tl = origination_loan_id WHERE rn = 1
    AND lms_customer_id NOT IN (SELECT customer_id FROM customer_flat WHERE lower(optout_marketing_email) = 'true')),
  s AS (SELECT {LD} AS run_date, lms_customer_id, lms_application_id, origination_loan_id, state, product, {nc('customer_firstname')} AS first_name, emailaddress AS email, pay_frequency, CAST(approved_amount AS DOUBLE) AS approved_amount, loan_status,
    CAST(coalesce(total_draw_amount, 0) AS DOUBLE) AS total_draw_amount, coalesce(total_draw_count, 0) AS total_draw_count, CAST(coalesce(total_prin_paid, 0) AS DOUBLE) AS total_prin_paid, last_draw_date, last_payment_date,
    coalesce(total_default_count, 0) AS total_default_count, coalesce(total_payment_count, 0) AS total_payment_count, CAST(avail AS DOUBLE) AS available_credit_limit, CAST(avail AS DOUBLE) / CAST(approved_amount AS DOUBLE) AS avail_credit_rate,
    {BANDS('avail', 'approved_amount', 10)} AS available_credit_range, date_diff('day', last_draw_date, {LD})::INTEGER AS days_since_last_draw, date_diff('day', last_payment_date, {LD})::INTEGER AS days_since_last_payment FROM y)"""
ITEM_RULE = "days_since_last_draw >= 15 AND total_default_count < 3 AND CASE WHEN state = 'NATION_15' THEN available_credit_limit >= 610 ELSE (avail_credit_rate >= 0.4 OR available_credit_limit >= 100) END"


def loc_items(v):
    s = credit_line.loc_items_summary(v.leads, v.items, v.customer_flat, LOC_CTX, "INST",
                                      ("AUTOMOBILE", "BUILDING", "HOUSEHOLD", "MACHINERY"))
    return credit_line.list_loc_good_items(s, {"NATION_15": 610})


@query("L19_list_loc_good_items", "leads items customer_flat", f"WITH {ITEMSUM} SELECT * FROM s WHERE {ITEM_RULE}")
def _(v):
    return loc_items(v)


@query("L20_list_sms_good", f"{GC_VIEWS} {CONSENT_VIEWS}", f"""WITH {GOOD}, {CONSENT} SELECT DISTINCT {head('GCSMS')}, {GC_COLS}, is_transactional_optin, is_sms_marketing_optin {GC_FROM}
  JOIN optin ON optin.customer_id = lms_customer_id AND (transactional_consent = 1 OR marketing_consent = 1)""")
def _(v):
    return paid_off.list_sms_good(good(v), v.customer_flat, optin(v), RULES)


@query("L20_list_sms_loc", f"leads items customer_flat {CONSENT_VIEWS}", f"""WITH {ITEMSUM}, {CONSENT} SELECT s.*, {USABLE} AS cell_phone, is_transactional_optin, is_sms_marketing_optin FROM s
  LEFT JOIN (SELECT customer_id AS fc, homephone, cellphone FROM customer_flat) f ON fc = lms_customer_id
  JOIN optin ON optin.customer_id = lms_customer_id AND (transactional_consent = 1 OR marketing_consent = 1) WHERE {ITEM_RULE}""")
def _(v):
    return credit_line.list_sms_loc(loc_items(v), v.customer_flat, optin(v), PLACEHOLDERS)


# ---- abandoned -------------------------------------------------------------------------------

def gone(since, known=True, states=True):
    return f"""gone AS (SELECT a.*, firstname, state, amount FROM (SELECT user_name, max(event_ts) AS dropoff_time, count(id) AS record_cnt FROM tracking
    WHERE CAST(event_ts AS DATE) >= {since} AND NOT ends_with(lower(user_name), 'internal.example.com') GROUP BY 1) a LEFT JOIN user_info ON email = user_name
    WHERE user_name NOT IN (SELECT user_name FROM tracking WHERE page = 'reject') AND user_name NOT IN (SELECT emailaddress FROM leads0 WHERE lms_code = 'LOC' AND application_status = 'originated')
    {"AND state <> 'NATION_9'" if states else ''} {"AND user_name NOT IN (SELECT user_name FROM tracking WHERE known_id > 0 AND CAST(event_ts AS DATE) >= DATE '1997-11-20')" if known else ''})"""


OFFER = """amt AS (SELECT n_name AS st, CAST(n_nationkey * 10 + 100 AS DECIMAL(18,2)) AS offer FROM nation),
  c1 AS (SELECT *, row_number() OVER (PARTITION BY promo_code ORDER BY create_datetime, log_id) AS r1 FROM dm_log WHERE application_status = 1 AND CAST(create_datetime AS DATE) BETWEEN DATE '1998-01-20' - 60 AND DATE '1998-01-20'),
  c2 AS (SELECT *, row_number() OVER (PARTITION BY email ORDER BY validation_date DESC, log_id) AS r2 FROM c1 WHERE r1 = 1),
  offers AS (SELECT * FROM (SELECT email, promo_code, offer, expire_date, row_number() OVER (PARTITION BY email ORDER BY expire_date DESC, mapping_id) AS r3 FROM c2 JOIN amt ON st = state
    JOIN mail_map ON lower(promo_code) LIKE lower(trim(pattern)) AND expire_date >= DATE '1998-01-20' WHERE r2 = 1) q WHERE r3 = 1)"""


def gone_rows(module, offers=True):
    extra = (", CAST(offer AS DOUBLE) AS approved_amount, CASE WHEN promo_code IS NOT NULL THEN 1 ELSE 0 END AS extra1, promo_code, expire_date AS dm_expire_date" if offers else "")
    join = " LEFT JOIN offers o ON o.email = user_name" if offers else ""
    return f"""SELECT DATE '1998-01-20' AS business_date, '{module}' AS list_module, '01201998{module}' AS job_id, user_name AS email, {nc('firstname')} AS customer_firstname,
  CAST(amount AS DOUBLE) AS requested_amount, dropoff_time AS received_time, record_cnt AS key_word, gone.state{extra} FROM gone{join}"""


def offers(v):
    amounts = v.nation.selectExpr("n_name AS state", "n_nationkey AS id",
                                  "CAST(n_nationkey * 10 + 100 AS DECIMAL(18,2)) AS offer")
    return ab.mail_offers(v.dm_log, amounts, v.mail_map, EVENT_CTX)


def left(v, since, known=True):
    return ab.abandoned(v.tracking.filter(F.col("event_ts") <= EVENT_CTX.ts()), v.user_info,
                        v.leads0.filter("lms_code = 'LOC' and application_status = 'originated'"),
                        since, ("internal.example.com",),
                        [f"NATION_{n}" for n in range(25) if n != 9] if known else None,
                        dt.date(1997, 11, 20) if known else None)


AB_VIEWS = "tracking user_info leads0 dm_log mail_map"


def at_run(sql):
    """Only events up to the run instant exist for the job."""
    return re.sub(r"FROM tracking\b", f"FROM (SELECT * FROM tracking WHERE event_ts <= {TS}) tracking", sql)


ORACLE_21 = at_run(f"WITH {gone('''DATE '1998-01-17' ''')}, {OFFER} {gone_rows('ACH')} WHERE dropoff_time BETWEEN {TS} - INTERVAL 105 MINUTE AND {TS} - INTERVAL 45 MINUTE")


@query("L21_list_abandoned_hourly", AB_VIEWS, ORACLE_21)
def _(v):
    return ab.list_abandoned_hourly(left(v, dt.date(1998, 1, 17)), offers(v), EVENT_CTX)


@query("L21_from_daily_activity", AB_VIEWS, ORACLE_21)
def _(v):
    """Days before the run are stored once; the hourly run reads its own day alone, and can be repeated."""
    events = v.tracking.filter(F.col("event_ts") <= EVENT_CTX.ts())
    days = ab.DailyActivity(v.spark, fresh_path(v.spark, "daily-activity"))
    days.refresh(events, dt.date(1997, 12, 25), dt.date(1998, 1, 19), ("internal.example.com",))
    for _ in range(2):
        days.refresh(events, dt.date(1998, 1, 20), dt.date(1998, 1, 20), ("internal.example.com",))
    seen = days.last_activity(v.user_info, dt.date(1998, 1, 17), dt.date(1998, 1, 20), dt.date(1997, 11, 20))
    leads = v.leads0.filter("lms_code = 'LOC' and application_status = 'originated'")
    seen = ab.unaccepted(seen, leads, [f"NATION_{n}" for n in range(25) if n != 9])
    return ab.list_abandoned_hourly(seen, offers(v), EVENT_CTX)


@query("L22_list_abandoned_daily_aged", AB_VIEWS, at_run(f"""WITH {gone('''DATE '1998-01-17' ''')}, {OFFER} {gone_rows('ACD')} WHERE dropoff_time BETWEEN TIMESTAMP '1998-01-19 00:00:00' AND TIMESTAMP '1998-01-20 00:00:00'""")
       + " UNION ALL SELECT *, NULL, 0, NULL, NULL FROM (" + at_run(f"WITH {gone('''DATE '1997-12-20' ''', False, False)} {gone_rows('ACB', False)} WHERE dropoff_time <= TIMESTAMP '1998-01-18 00:00:00'") + ") aged")
def _(v):
    daily = ab.list_abandoned_daily(left(v, dt.date(1998, 1, 17)), offers(v), EVENT_CTX)
    aged = ab.list_abandoned_aged(left(v, dt.date(1997, 12, 20), False), EVENT_CTX, days=2)
    return daily.unionByName(aged.withColumn("extra1", F.lit(0)), allowMissingColumns=True)


# ---- service ---------------------------------------------------------------------------------

@query("L23_list_right_to_cure", "leads accounts", f"""SELECT {D} AS report_date, lms_customer_id, emailaddress AS email, {nc('customer_firstname')} || ' ' || {nc('customer_lastname')} AS customer_full_name,
  CAST(origination_time AS DATE) AS origination_date, CAST(a.credit_limit AS DOUBLE) AS loc_amount, {D} - a.days_delinquent AS due_date, {D} + 21 AS cure_date, statement_date,
  CAST(minimum_payment_due AS DOUBLE) AS minimum_payment_due, state, lms_application_id, loan_status, a.days_delinquent, 'Monday' AS day_name, 'Monday , March 2 , 1998' AS full_date
  FROM accounts a JOIN leads ON CAST(ltrim(a.account_number, '0') AS BIGINT) = lms_customer_id
  LEFT JOIN (SELECT account_number AS sa, {D} - 12 AS due, {D} - 30 AS statement_date, amount_due AS minimum_payment_due FROM accounts) sh ON sa = a.account_number AND due = {D} - a.days_delinquent
  WHERE system_status = 3 AND a.days_delinquent IN (11, 12, 13) AND lms_code = 'LOC' AND origination_time IS NOT NULL AND state <> 'NATION_9'""")
def _(v):
    sh = v.accounts.select("account_number", F.date_sub(CTX.date(), 12).alias("date_of_total_due"),
                           F.date_sub(CTX.date(), 30).alias("statement_date"),
                           F.col("amount_due").alias("minimum_payment_due"))
    return service.list_right_to_cure(v.leads, v.accounts, sh, CTX, "LOC",
                                      [f"NATION_{n}" for n in range(25) if n != 9])


def survey(name):
    return (f"run_date, '{name}' AS list_name, {nc('customer_firstname')} AS customer_firstname, lms_customer_id, emailaddress, lms_code, product, state, campaign_name, origination_time, loan_sequence, isreturning, "
            "CASE WHEN lead_cost > 1 THEN 1 ELSE 0 END AS is_external, CAST(approved_amount AS DOUBLE) AS approved_amount")


@query("L24_list_survey", "leads loans transactions schedules items cal", f"""WITH {RUNS} SELECT {survey('NEW')} FROM leads JOIN runs ON run_date = effective_date WHERE lms_code = 'INST' AND loan_status <> 'voided'
  UNION SELECT {survey('PAYS_OFF')} FROM leads a JOIN loans ON loan_header_id = lms_application_id JOIN (SELECT base_loan_id AS tl, trans_date FROM transactions WHERE trans_type = 'Debit') t ON tl = base_loan_id
    JOIN runs ON run_date = trans_date WHERE lms_code = 'INST' AND a.loan_status = 'pending paid off' AND run_date >= last_paymentdate
  UNION SELECT {survey('THIRD_DRAW')} FROM leads JOIN (SELECT base_loan_id AS dl, max(item_date) AS ld, count(*) AS n FROM items i JOIN schedules s ON s.payment_schedule_id = i.payment_schedule_id AND is_collections = 0
    WHERE total_amount < 0 AND status IN ('cleared', 'sent') GROUP BY 1) d ON dl = origination_loan_id JOIN runs ON run_date = ld + 1 WHERE lms_code = 'INST' AND isoriginated = 1 AND loan_status = 'originated' AND n >= 3""")
def _(v):
    return service.list_survey(v.leads, v.loans, v.transactions, v.schedules, v.items, runs(v), "INST")


RCTX = RunContext(dt.datetime(1997, 1, 15, 9))


@query("L25_list_repeat_survey", "leads loans items", f"""SELECT 'taken' AS list_name, a.lms_customer_id, a.lms_application_id, a.loan_status, a.campaign_name, CAST(a.origination_time AS DATE) AS day,
  date_diff('day', coalesce(lb.paid_off_date, b.last_paymentdate), CAST(a.origination_time AS DATE))::INTEGER AS days FROM leads a LEFT JOIN leads b ON b.lms_customer_id = a.lms_customer_id AND b.lms_code = a.lms_code AND b.loan_sequence = a.loan_sequence - 1 AND b.isoriginated = 1
  LEFT JOIN loans lb ON lb.base_loan_id = b.lms_application_id WHERE a.lms_code = 'INST' AND a.isoriginated = 1 AND a.loan_sequence = 2 AND a.loan_status IN ('paid off loan', 'paid off', 'originated') AND a.isapplicationtest = 0
  AND CAST(a.origination_time AS DATE) BETWEEN DATE '1997-01-15' - 731 AND DATE '1997-01-14'
  UNION ALL SELECT 'missing', lms_customer_id, lms_application_id, a.loan_status, campaign_name, paid_off_date, date_diff('day', paid_off_date, DATE '1997-01-15')::INTEGER FROM leads a JOIN loans b ON b.base_loan_id = origination_loan_id
  WHERE lms_code = 'INST' AND loan_sequence = 1 AND isoriginated = 1 AND isapplicationtest = 0 AND b.loan_status = 'paid off' AND paid_off_date BETWEEN DATE '1997-01-15' - 600 AND DATE '1997-01-15' - 30
  AND EXISTS (SELECT 1 FROM items i WHERE i.payment_schedule_id = base_loan_id AND status = 'cleared' AND total_amount > 0)
  AND NOT EXISTS (SELECT 1 FROM leads c WHERE c.lms_customer_id = a.lms_customer_id AND c.lms_code = a.lms_code AND c.loan_sequence = 2)""")
def _(v):
    a = service.list_repeat_taken(v.leads, v.loans, RCTX, "INST", 731).join(
        v.leads.select("lms_application_id", "campaign_name"), "lms_application_id")
    b = service.list_repeat_missing(v.leads, v.loans, v.items, RCTX, "INST", 30, 600)
    cols = ["lms_customer_id", "lms_application_id", "loan_status", "campaign_name"]
    return a.select(F.lit("taken").alias("list_name"), *cols, F.to_date("origination_time").alias("day"),
                    F.col("days_funded_since_paid_off").alias("days")).unionByName(
        b.select(F.lit("missing").alias("list_name"), *cols, F.col("paid_off_date").alias("day"),
                 F.col("days_since_paid_off").alias("days")))


@query("L26_list_active", "leads", """SELECT lms_customer_id, max(received_time) AS max_received_time, max(origination_time) AS max_origination_time, arg_max(emailaddress, received_time) AS email, arg_max(state, received_time) AS state, count(*) AS loan_cnt
  FROM leads WHERE lms_code = 'INST' AND application_status = 'originated' AND loan_status = 'originated' AND state <> 'NATION_9' GROUP BY 1 HAVING max(received_time) < TIMESTAMP '2000-01-22 00:00:00'""")
def _(v):
    return service.list_active(v.leads, "INST", [f"NATION_{n}" for n in range(25) if n != 9],
                               F.lit(dt.datetime(2000, 1, 22)).cast("timestamp_ntz"))


@query("L26_list_active_legacy", "leads legacy_loans legacy_payments", """WITH z AS (SELECT CASE WHEN original_loan_id = 0 THEN id ELSE original_loan_id END AS root,
    sum(CASE WHEN is_debit = 1 AND payment_status = 'checked' THEN -principle WHEN is_debit = 0 AND payment_status = 'checked' THEN principle END) AS principal_balance,
    max(CASE WHEN is_debit = 1 AND payment_status = 'checked' THEN effective_date END) AS last_payment_date, count(*) FILTER (is_debit = 1 AND payment_status = 'rejected') AS default_cnt,
    max(CASE WHEN collection_start_date IS NOT NULL THEN 1 ELSE 0 END) AS coll FROM legacy_loans LEFT JOIN legacy_payments ON loan_id = id AND payment_status IN ('checked', 'rejected') WHERE loan_status NOT IN ('deleted', 'voided renewed loan') GROUP BY 1),
  y AS (SELECT leads.*, z.*, row_number() OVER (PARTITION BY lms_customer_id ORDER BY received_time DESC, lms_application_id DESC) AS rn, count(*) OVER (PARTITION BY lms_customer_id) AS loan_cnt FROM leads JOIN z ON root = lms_application_id
    WHERE lms_code = 'LEGACY' AND isoriginated = 1 AND isapplicationtest = 0 AND state <> 'NATION_9' AND principal_balance > 0 AND coll = 0)
  SELECT lms_customer_id, lms_application_id, state, product, CAST(principal_balance AS DOUBLE) AS principal_balance, last_payment_date, default_cnt, loan_cnt FROM y WHERE rn = 1""")
def _(v):
    return service.list_active_legacy(v.leads, v.legacy_loans, v.legacy_payments, "LEGACY",
                                      [f"NATION_{n}" for n in range(25) if n != 9])


SPEC = [("WA3", "WAD", 3, None, None, None), ("WA7_DM", "WAD", 7, None, None, 1), ("WA5_NODM", "WAD", 5, None, None, 0)] + [
    (f"POL{n}", "POL_NEW", n, None, 0, None) for n in (3, 7, 10, 13, 15, 19, 23, 26, 30)] + [
    (f"POL{n}_X", "POL_NEW", -n, None, 1, None) for n in (10, 20, 30, 40)] + [
    ("PA_AUTO", "PA", None, "AUTOMOBILE", None, None), ("PA_ALL", "PA", None, None, None, None)]
SPEC_SQL = "(VALUES " + ", ".join(
    "(" + ", ".join("NULL" if x is None else repr(x) for x in r) + ")" for r in SPEC) + ") AS s(segment, m, d, p, c, x)"


@query("L27_segments", "history", f"""SELECT DISTINCT segment, CAST(list_generation_time AS DATE) AS run_date, customer_firstname, email, CAST(approved_amount AS DOUBLE) AS approved_amount FROM (SELECT *,
  date_diff('day', coalesce(CAST(withdrawn_time AS DATE), last_repayment_date), CAST(list_generation_time AS DATE)) AS ds, CASE WHEN state IN ('NATION_3', 'NATION_8') AND product = 'BUILDING' THEN 1 ELSE 0 END AS inc FROM history) h
  JOIN {SPEC_SQL} ON list_module = m AND (d IS NULL OR d = ds) AND (p IS NULL OR p = product) AND (c IS NULL OR c = inc) AND (x IS NULL OR x = extra1)""")
def _(v):
    spec = v.spark.createDataFrame(SPEC, "segment string, list_module string, days_since int, product string, in_carve int, extra1 int")
    return service.segment(v.history, spec, carve=[(("NATION_3", "NATION_8"), ("BUILDING",))])


@query("L28_list_pending_by_hour", "leads rates days", f"""WITH h AS (SELECT o_orderkey AS loan_header_id, o_orderdate + to_minutes(CAST(floor(o_totalprice / 348) AS INT)) AS created_date FROM orders WHERE o_orderstatus = 'P'),
  z AS (SELECT * FROM (SELECT * FROM {carded('leads', False, False)} AND leads.pay_frequency = rfreq) a JOIN h ON loan_header_id = lms_application_id WHERE loan_sequence = 1 AND {OK})
  SELECT DISTINCT {head('PA0_NIGHT')}, created_date, CAST(hour(received_time) AS INTEGER) AS hour_received, {MAX_LIMIT} AS max_loan_limit FROM (SELECT *, CAST(created_date AS DATE) + 1 AS run_date FROM z) la WHERE hour(created_date) BETWEEN 20 AND 23 AND {still_open('la.created_date')}
  UNION ALL SELECT DISTINCT {head('PA0_EARLY')}, created_date, CAST(hour(received_time) AS INTEGER), {MAX_LIMIT} FROM (SELECT *, CAST(created_date AS DATE) AS run_date FROM z) la WHERE hour(created_date) BETWEEN 0 AND 10 AND {still_open('la.created_date')}""")
def _(v):
    headers = v.orders.selectExpr("o_orderkey AS loan_header_id", "lower('PENDING') AS status",
                                  "timestampadd(MINUTE, CAST(floor(o_totalprice / 348) AS INT), o_orderdate) AS created_date",
                                  "o_orderstatus").filter("o_orderstatus = 'P'")
    days = v.days.select(F.col("ori_date").alias("run_date"))
    a = pending.list_pending_by_hour(headers, v.leads, v.rates, days, RULES, "PA0_NIGHT", 20, 23, -1)
    b = pending.list_pending_by_hour(headers, v.leads, v.rates, days, RULES, "PA0_EARLY", 0, 10)
    return a.unionByName(b)
