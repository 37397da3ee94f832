"""Funnels, fact tables and campaign measurement over whole tables."""

import datetime as dt

from pyspark.sql import functions as F

from lendreach.checks.common import CONSENT, CONSENT_VIEWS, USABLE, optin
from lendreach.checks.q_enrich import PROVIDER_SQL, providers
from lendreach.checks.q_groups import FIRST_PAY, PAGES
from lendreach.checks.q_lists import CAPS, caps, hashed
from lendreach.checks.registry import dbl, query
from lendreach.checks.views import FIRST_DAY, PLACEHOLDERS
from lendreach.context import RunContext
from lendreach.operators.ranking import draw_sequence
from lendreach.plans import facts, funnel, measure, paid_off
from lendreach.plans.refresh import StoredFact
from lendreach.session import Scratch, cut_lean, cut_lineage, fresh_path
from lendreach.sources.colocated import CoLocated

ID = "lms_application_id"
WEB_PAGES = ("create_password_submit", "welcome", "account_terms", "account_terms_submit", "payment_schedule_submit",
             "loan_docs-CI", "loan_docs_submit-CI", "loan_docs-TC", "loan_docs_submit-TC")


def fpd(v):
    return facts.first_payment_default(v.leads0, v.schedules, v.items)


SINCE = dt.datetime(1998, 1, 8)
VISITS_LEAD = """vl AS (SELECT visits.*, lead_received FROM visits LEFT JOIN (SELECT lms_customer_id AS lk, max(received_time) AS lead_received FROM leads0
  WHERE received_time < TIMESTAMP '1998-02-01 00:00:00' GROUP BY 1) l ON lk = lms_customer_id)"""


def began(offer, identity, bank):
    """Page flags and reject positions; the page names of the steps vary with the brand."""
    any_ = lambda c: f"max(CASE WHEN {c} THEN 1 ELSE 0 END)"
    seen = {n: any_(f"page = '{p}'") for n, p in (("o", offer), ("i", identity), ("b", bank))}
    return f"""WITH {VISITS_LEAD} SELECT lms_customer_id, {', '.join(f"{any_(f"page = '{p}'")} AS {funnel.flag_name(p)}" for p in funnel.INTERNAL_PAGES)},
  {any_("page = 'reject'")} AS reject, 0 AS is_rollback, count(*) AS events, CASE WHEN {any_("page = 'reject'")} = 1 AND {seen["o"]} = 0 THEN 1 ELSE 0 END AS reject_before_offer,
  CASE WHEN {any_("page = 'reject'")} = 1 AND {seen["o"]} = 1 AND {seen["i"]} = 0 THEN 1 ELSE 0 END AS reject_after_offer,
  CASE WHEN {any_("page = 'reject' AND lead_received <= event_ts")} = 1 AND {seen["b"]} = 1 THEN 1 ELSE 0 END AS reject_after_lead
  FROM vl WHERE event_ts >= TIMESTAMP '{SINCE}' AND lms_customer_id IN (SELECT lms_customer_id FROM visits WHERE page = 'create_password_submit' AND event_ts >= TIMESTAMP '{SINCE}') GROUP BY 1"""


def visits_lead(v):
    """Events with the time the customer's latest lead came in."""
    first = v.leads0.filter(F.col("received_time") < F.lit(dt.datetime(1998, 2, 1)).cast("timestamp_ntz")).groupBy(
        "lms_customer_id").agg(F.max("received_time").alias("lead_received"))
    return v.visits.join(first, "lms_customer_id", "left")


@query("N01_funnel_internal", "visits leads0", began("pre_approved_submit", "kyc_submit", "banking_info_submit"))
def _(v):
    return funnel.funnel_internal(visits_lead(v), "create_password_submit", F.lit(SINCE).cast("timestamp_ntz"),
                                  key="lms_customer_id", received="lead_received")


@query("N01_reject_positions", "visits leads0", began("account_terms_submit", "payment_schedule_submit", "loan_docs_submit-TC"))
def _(v):
    return funnel.funnel_internal(visits_lead(v), "create_password_submit", F.lit(SINCE).cast("timestamp_ntz"),
                                  key="lms_customer_id", received="lead_received", offer="account_terms_submit",
                                  identity="payment_schedule_submit", bank="loan_docs_submit-TC")


ORDERED = ("welcome", "loan_docs-CI", "loan_docs_submit-CI", "account_terms_submit")


@query("N01_ordered_steps", "visits", "WITH r AS (SELECT *, row_number() OVER (PARTITION BY lms_customer_id ORDER BY event_ts, id) AS rn FROM visits WHERE page IN "
       + str(ORDERED) + "), s0 AS (SELECT DISTINCT lms_customer_id, 0::BIGINT AS p0 FROM r)"
       + "".join(f", s{i} AS (SELECT s.*, (SELECT min(rn) FROM r WHERE r.lms_customer_id = s.lms_customer_id AND page = '{p}' AND rn > s.p{i - 1}) AS p{i} FROM s{i - 1} s)" for i, p in enumerate(ORDERED, 1))
       + " SELECT lms_customer_id, " + " + ".join(f"CASE WHEN p{i} IS NULL THEN 0 ELSE 1 END" for i in range(1, 5)) + " AS steps_done, "
       + ", ".join(f"(SELECT event_ts FROM r WHERE r.lms_customer_id = s4.lms_customer_id AND rn = p{i}) AS t_{i}" for i in range(1, 5)) + " FROM s4")
def _(v):
    return funnel.funnel_ordered(v.visits, ORDERED, "lms_customer_id")


DOCS = {"NATION_1": ("CI", "TC"), "NATION_2": ("TC",)}


def after(p):
    return f"(SELECT max(event_ts) FROM visits e WHERE e.lms_customer_id = a.lms_customer_id AND page = '{p}') >= received_time"


N02_FLAGS = ", ".join(f"CASE WHEN {after(p)} THEN 1 ELSE 0 END AS s_{funnel.flag_name(p)[2:]}" for p in ("account_terms", "payment_schedule_submit"))
N02_DOCS = ", ".join(f"CASE WHEN state = '{s}' AND {after(f'loan_docs{x}-{d}')} THEN 1 ELSE 0 END AS d_{funnel.flag_name(f'loan_docs{x}-{d}')[2:]}_{s.lower()}"
                     for s, ds in DOCS.items() for d in ds for x in ("", "_submit"))
N02_DONE = ", ".join(f"CASE WHEN state = '{s}' AND {after(f'loan_docs_submit-{ds[-1]}')} THEN 1 ELSE 0 END AS completed_loan_doc_{s.lower()}" for s, ds in DOCS.items())


@query("N02_funnel_external", "leads0 visits", f"""SELECT lms_application_id, lms_customer_id, received_time, state, CASE WHEN EXISTS (SELECT 1 FROM visits e WHERE e.lms_customer_id = a.lms_customer_id AND page = 'welcome'
   AND event_ts BETWEEN received_time - INTERVAL 2 MINUTE AND received_time + INTERVAL 5 MINUTE) THEN 1 ELSE 0 END AS is_redirect, CASE WHEN {after('welcome')} THEN 1 ELSE 0 END AS visit_welcome,
  {N02_FLAGS}, {N02_DOCS}, {N02_DONE}, 0 AS is_rollback FROM leads0 a WHERE provider_name <> 'Own Web' AND isapplicationtest = 0""")
def _(v):
    apps = v.leads0.filter("provider_name <> 'Own Web' and isapplicationtest = 0")
    return funnel.funnel_external(apps, v.visits, ("welcome",), ("account_terms", "payment_schedule_submit"),
                                  DOCS)


@query("N03_signing_time", "visits leads", """WITH d AS (SELECT lms_customer_id, session_id, page_group, min(event_ts) AS s, date_sub('second', min(event_ts), max(event_ts)) AS sec FROM (SELECT *, CASE WHEN page LIKE 'loan_docs%CI' THEN 'CI' WHEN page LIKE 'loan_docs%TC' THEN 'TC' END AS page_group FROM visits) z
   WHERE page_group IS NOT NULL GROUP BY 1, 2, 3), f AS (SELECT * FROM (SELECT *, rank() OVER (PARTITION BY lms_customer_id, page_group ORDER BY s) AS rk FROM d) q WHERE rk = 1),
  t AS (SELECT lms_customer_id AS k, CAST(sum(sec) AS BIGINT) AS total_seconds_spent, count(DISTINCT page_group) AS page_groups FROM f GROUP BY 1)
  SELECT lms_customer_id, total_seconds_spent, page_groups, state, product, loan_sequence, isoriginated, CASE WHEN loan_sequence = 1 THEN 1 ELSE 0 END AS is_nc FROM t JOIN leads ON k = lms_customer_id""")
def _(v):
    return funnel.signing_time(v.visits, v.leads, PAGES, "lms_customer_id", ["lms_customer_id", "session_id"])


BEHAVE = """beh AS (SELECT lms_customer_id AS bk, max(CASE WHEN page IN ('welcome', 'account_terms') THEN 1 ELSE 0 END) AS wel_visit, max(CASE WHEN page IN ('create_password_submit') THEN 1 ELSE 0 END) AS pw_visit,
  count(*) FILTER (page = 'account_terms_submit') AS terms_submit, count(*) FILTER (page = 'payment_schedule_submit') AS pay_submit FROM visits GROUP BY 1)"""


def behaviour(v):
    return facts.web_behaviour(v.visits, {"wel": ("welcome", "account_terms"), "pw": ("create_password_submit",)},
                               {"terms": "account_terms_submit", "pay": "payment_schedule_submit"})


FACT_CTX = RunContext(dt.datetime(2001, 12, 1, 9))


def buckets(a, b, sfx):
    d = f"date_diff('day', CAST({a} AS DATE), CAST({b} AS DATE))"
    return ", ".join(f"CASE WHEN {d} = {n} THEN 1 ELSE 0 END AS day{n}_{sfx}" for n in range(4)) + f", CASE WHEN {d} > 3 THEN 1 ELSE 0 END AS day3plus_{sfx}"


FACT = f"""{FIRST_PAY}, {CONSENT}, {BEHAVE},
 m AS (SELECT * FROM (SELECT lms_application_id AS mk, dm_name, row_number() OVER (PARTITION BY lms_application_id ORDER BY start_date, mapping_id) AS rn FROM leads JOIN mail_map ON lower(affid) LIKE lower(trim(pattern))
   AND CAST(received_time AS DATE) BETWEEN start_date - 5 AND expire_date) q WHERE rn = 1),
 p AS (SELECT lms_application_id AS pk, max(received_time) FILTER (isuniqueaccept = 1) OVER w AS prev_app, max(CASE WHEN loan_status = 'paid off' THEN received_time END) OVER w AS prev_paid_at,
   arg_max(last_paymentdate, received_time) FILTER (loan_status = 'paid off') OVER w AS prev_paid FROM leads WINDOW w AS (PARTITION BY lms_code, lms_customer_id ORDER BY received_time RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING)),
 fact AS (SELECT a.lms_code, a.product, a.state, a.lms_customer_id, a.lms_application_id AS original_lead_id, a.lead_sequence_id, a.origination_loan_id, a.loan_sequence, a.provider_name, a.campaign_name, CAST(a.lead_cost AS DOUBLE) AS lead_cost,
  CASE WHEN a.loan_sequence = 1 AND a.isexpress = 0 THEN 1 ELSE 0 END AS nc_accepts, CASE WHEN a.loan_sequence > 1 THEN 1 ELSE 0 END AS is_returning,
  CASE WHEN a.provider_name <> 'Own Web' AND a.loan_sequence = 1 AND a.isexpress = 0 THEN 1 ELSE 0 END AS is_external_nc, CASE WHEN a.provider_name <> 'Own Web' THEN 'External' ELSE 'Internal' END AS channel,
  CASE WHEN a.provider_name <> 'Own Web' THEN NULL ELSE dm_name END AS dm_name, CASE WHEN a.campaign_name IS NULL THEN NULL WHEN contains(a.campaign_name, '#') THEN 1 ELSE 0 END AS is_tag_campaign,
  a.application_status, l.loan_status AS current_loan_status, a.received_time, CAST(a.received_time AS DATE) AS received_date, dayname(a.received_time) AS weekday_name, strftime(a.received_time, '%Y %B') AS received_month,
  CAST(hour(a.received_time) AS INTEGER) AS received_hour, CASE WHEN a.origination_loan_id IS NOT NULL THEN 1 ELSE 0 END AS is_originated, l.origination_time AS origination_datetime,
  date_sub('minute', a.received_time, l.origination_time) AS minute_to_origination, {buckets('a.received_time', 'l.origination_time', 'origination')},
  CASE WHEN a.origination_loan_id IS NULL THEN a.withdrawn_reason END AS withdrawn_reason, CASE WHEN a.origination_loan_id IS NULL THEN a.withdrawn_time END AS withdrawn_datetime,
  date_sub('minute', a.received_time, a.withdrawn_time) AS minute_to_withdrawn, {buckets('a.received_time', 'a.withdrawn_time', 'withdrawn')},
  CASE WHEN base_loan_id IS NOT NULL THEN 1 ELSE 0 END AS is_first_payment_debited, debit_date, coalesce(is_defaulted, 0) AS is_first_payment_defaulted, {dbl('principal_paid fees_paid')},
  CASE WHEN principal_paid = l.approved_amount THEN 1 ELSE 0 END AS is_pif, CAST(CASE WHEN base_loan_id IS NOT NULL THEN l.approved_amount END AS DOUBLE) AS principal_debited, CAST(CASE WHEN is_defaulted = 1 THEN l.approved_amount END AS DOUBLE) AS principal_defaulted,
  CAST(a.requested_amount AS DOUBLE) AS requested_amount, CAST(a.approved_amount AS DOUBLE) AS approved_amount, CAST(l.approved_amount AS DOUBLE) AS originated_loan_amount,
  CAST(TRY_CAST(regexp_replace(app.nmi, '[$,]', '', 'g') AS DECIMAL(18,2)) AS DOUBLE) AS application_nmi, CAST(f.nmi AS DOUBLE) AS current_nmi,
  date_diff('day', CAST(prev_app AS DATE), CAST(a.received_time AS DATE))::INTEGER AS days_from_last_application, date_diff('day', prev_paid, CAST(a.received_time AS DATE))::INTEGER AS days_from_last_paid_off,
  CASE WHEN a.provider_name IN ('Provider 1') THEN left(a.affid, 4) ELSE a.subid END AS sub_id,
  CASE WHEN a.loan_sequence > 1 THEN 'RC' WHEN a.approved_amount <= 3000 THEN 'BV' WHEN a.isuniqueaccept = 0 THEN 'BV' ELSE 'NBV' END AS bank_verification, CASE WHEN a.isuniqueaccept = 1 THEN 0 ELSE 1 END AS routing_changed, 0 AS account_changed,
  a.emailaddress AS email_address, split_part(lower(a.emailaddress), '@', 2) AS email_domain, coalesce(wel_visit, 0) AS wel_visit, coalesce(pw_visit, 0) AS pw_visit, coalesce(terms_submit, 0) AS terms_submit, coalesce(pay_submit, 0) AS pay_submit,
  coalesce(is_transactional_optin, 0) AS is_transactional_optin, coalesce(is_sms_marketing_optin, 0) AS is_sms_marketing_optin
  FROM leads a LEFT JOIN (SELECT lms_customer_id AS lc, lms_application_id AS li, origination_time, loan_status, approved_amount FROM leads) l ON lc = a.lms_customer_id AND li = a.origination_loan_id
  LEFT JOIN pay ON base_loan_id = a.origination_loan_id LEFT JOIN application app ON app.lead_sequence_id = a.lead_sequence_id LEFT JOIN customer_flat f ON f.customer_id = a.lms_customer_id
  LEFT JOIN optin o ON o.customer_id = a.lms_customer_id LEFT JOIN beh ON bk = a.lms_customer_id LEFT JOIN m ON mk = a.lms_application_id LEFT JOIN p ON pk = a.lms_application_id
  WHERE (a.isuniqueaccept = 1 OR (a.loan_sequence = 1 AND a.isexpress = 0)) AND a.isapplicationtest = 0)"""


def fact_tables(v):
    return facts.FactTables(v.leads, v.application, v.schedules, v.items, optin(v), v.customer_flat, hashed(v),
                            v.mail_map, behaviour(v))


def fact(v, cut=cut_lean):
    return facts.application_fact(FACT_CTX, fact_tables(v), "Own Web", ("Provider 1",), FIRST_DAY, cut=cut)


@query("N04_application_fact", f"leads items schedules application customer_flat visits mail_map {CONSENT_VIEWS}", f"WITH {FACT} SELECT * FROM fact")
def _(v):
    return fact(v)


@query("N04_colocated", f"leads items schedules application customer_flat visits mail_map {CONSENT_VIEWS}", f"WITH {FACT} SELECT * FROM fact")
def _(v):
    buckets = CoLocated(v.spark, int(v.spark.conf.get("spark.sql.shuffle.partitions")))
    return facts.ColocatedFact.write(fact_tables(v), buckets).fact(FACT_CTX, "Own Web", ("Provider 1",), FIRST_DAY)


def _refreshed(v):
    """The fact as it was in March 1998, refreshed over a later look-back, double keys and tests cleaned up."""
    leads = v.leads.select("lms_code", F.col("lms_application_id").alias("original_lead_id"), "isapplicationtest", "isuniqueaccept")
    with Scratch(v.spark) as near:
        now = cut_lean(fact(v, near.cut), "fact-now")
    early = now.filter(F.col("received_time") < F.lit(dt.datetime(1998, 3, 2)).cast("timestamp_ntz")).withColumn(
        "withdrawn_reason", F.when(F.col("received_time") >= F.lit(dt.datetime(1998, 1, 1)).cast("timestamp_ntz"),
                                   F.concat("withdrawn_reason", F.lit(" (open)"))).otherwise(F.col("withdrawn_reason")))
    store = StoredFact(v.spark, fresh_path(v.spark, "fact"), now.schema, ["lms_code", "original_lead_id"], "received_date")
    late = now.filter(F.col("received_time") >= F.lit(dt.datetime(1997, 12, 1)).cast("timestamp_ntz"))
    late = late.unionByName(late.filter("original_lead_id % 5 = 0"))        # double keys
    steps = [store.refresh(early), store.refresh(late), store.refresh(late)]
    store.purge_tests(leads, ["lms_code", "original_lead_id"])
    store.purge_doubles(leads, ["lms_code", "original_lead_id"])
    return store, steps


NOW = f"""{FACT}, late AS (SELECT * FROM fact WHERE received_time >= TIMESTAMP '1997-12-01 00:00:00'), unq AS (SELECT lms_application_id AS uid, isuniqueaccept FROM leads0)"""


@query("N04_incremental", f"leads items schedules application customer_flat visits mail_map {CONSENT_VIEWS}", f"""WITH {NOW} SELECT fact.* FROM fact JOIN unq ON uid = original_lead_id
  WHERE NOT (received_time >= TIMESTAMP '1997-12-01 00:00:00' AND original_lead_id % 5 = 0 AND isuniqueaccept <> 1)
  UNION ALL SELECT late.* FROM late JOIN unq ON uid = original_lead_id WHERE original_lead_id % 5 = 0 AND isuniqueaccept = 1""")
def _(v):
    return _refreshed(v)[0].read()


@query("N05_web_behaviour", "visits", f"WITH {BEHAVE} SELECT bk AS lms_customer_id, * EXCLUDE (bk) FROM beh")
def _(v):
    return behaviour(v)


FPD = f"""{FIRST_PAY}, fpd AS (SELECT lms_code, lms_customer_id, origination_loan_id, state, product, loan_status, debit_date AS first_debit_date, CAST(debit_amount AS DOUBLE) AS debit_amount, is_defaulted AS is_fpd,
  date_diff('day', effective_date, debit_date)::INTEGER AS debit_days_since_originated FROM leads0 JOIN pay ON base_loan_id = origination_loan_id WHERE origination_time IS NOT NULL)"""


@query("N06_first_payment_default", "leads0 items schedules history", f"""WITH {FPD}, ddr AS (SELECT lms_code AS dc, lms_application_id AS dl, count(*) AS reminder_cnt FROM history WHERE ddr_type IN ('DDR3', 'DDR9') GROUP BY 1, 2)
  SELECT fpd.*, reminder_cnt, CASE WHEN first_debit_date BETWEEN DATE '1996-01-01' AND DATE '1997-12-31' THEN 'Period1' WHEN first_debit_date BETWEEN DATE '1998-06-01' AND DATE '1999-12-31' THEN 'Period2' ELSE 'Else' END AS period_filter,
  CASE WHEN reminder_cnt IS NOT NULL THEN 1 ELSE 0 END AS is_received_ddr FROM fpd LEFT JOIN ddr ON dc = lms_code AND dl = origination_loan_id""")
def _(v):
    return facts.compare_periods(fpd(v), v.history, [
        ("Period1", dt.date(1996, 1, 1), dt.date(1997, 12, 31)), ("Period2", dt.date(1998, 6, 1), dt.date(1999, 12, 31))])


@query("N07_monthly_looks", "application leads", """SELECT CAST(year(insert_date) AS INTEGER) AS received_year, CAST(month(insert_date) AS INTEGER) AS received_month, count(*) AS looks_cnt, count(*) FILTER (uw_cost > 0 OR decision = 'ACCEPT') AS unique_looks, count(DISTINCT email) AS unique_email_cnt,
  count(*) FILTER (decision = 'ACCEPT') AS total_accepted, count(origination_loan_id) AS total_loans, count(*) FILTER (loan_sequence = 1) AS nc_cnt, count(*) FILTER (loan_sequence = 1 AND origination_loan_id IS NOT NULL) AS nc_originated_cnt,
  count(*) FILTER (loan_sequence > 1) AS rc_cnt, count(*) FILTER (loan_sequence > 1 AND origination_loan_id IS NOT NULL) AS rc_originated_cnt, count(*) FILTER (loan_sequence > 1 AND a.lead_cost > 1) AS rc_external,
  CAST(sum(a.lead_cost) AS DOUBLE) AS total_lead_cost, CAST(sum(uw_cost) AS DOUBLE) AS total_uw_cost FROM application a LEFT JOIN (SELECT lead_sequence_id AS k, loan_sequence, origination_loan_id FROM leads WHERE isuniqueaccept = 1) l ON k = lead_sequence_id WHERE lead_provider_id NOT IN (0) GROUP BY 1, 2""")
def _(v):
    return measure.monthly_looks(v.application, v.leads, [0])


@query("N07_unique_addresses", "application", """WITH a AS (SELECT *, CAST(year(insert_date) AS INTEGER) AS y, CAST(month(insert_date) AS INTEGER) AS m FROM application WHERE lead_provider_id NOT IN (0))
  SELECT CASE WHEN grouping(m) = 0 THEN 'month' WHEN grouping(y) = 0 THEN 'year' ELSE 'all' END AS grain, y AS received_year, m AS received_month, count(DISTINCT email) AS unique_email_cnt,
  count(DISTINCT CASE WHEN uw_cost > 0 OR decision = 'ACCEPT' THEN email END) AS looked_email_cnt, count(DISTINCT CASE WHEN decision = 'ACCEPT' THEN email END) AS accepted_email_cnt,
  count(DISTINCT CASE WHEN decision <> 'ACCEPT' THEN email END) AS rejected_email_cnt FROM a GROUP BY GROUPING SETS ((y, m), (y), ())""")
def _(v):
    return measure.unique_looks(cut_lineage(measure.unique_addresses(v.application, [0]), "address-states"))


@query("N08_monthly_originations", "leads", """SELECT CAST(year(received_time) AS INTEGER) AS received_year, CAST(month(received_time) AS INTEGER) AS received_month, CAST(sum(isoriginated) AS BIGINT) AS total_originated, CAST(sum(approved_amount) AS DOUBLE) AS total_origination_amount,
  count(*) FILTER (loan_sequence = 1 AND lead_cost > 1) AS nc_external FROM leads WHERE origination_time IS NOT NULL AND lead_provider_id NOT IN (0) GROUP BY 1, 2""")
def _(v):
    return measure.monthly_originations(v.leads, [0])


@query("N09_affiliate_detail", "application leads0 items schedules", f"""WITH {FPD} SELECT a.lead_sequence_id, insert_date, CASE WHEN a.state IS NULL OR length(a.state) > 8 THEN 'X-NotAvail' ELSE a.state END AS state, a.product, 1 AS is_look, CASE WHEN uw_cost > 0 OR decision = 'ACCEPT' THEN 1 ELSE 0 END AS is_unique_look,
  CASE WHEN decision = 'ACCEPT' THEN 1 ELSE 0 END AS is_accepted, CASE WHEN l.origination_loan_id IS NOT NULL THEN 1 ELSE 0 END AS is_originated, CASE WHEN decision = 'REJECT' THEN CASE WHEN decision_detail = 'Internal Underwriting' THEN 'Internal_U/W' WHEN decision_detail LIKE '%Schema%' THEN 'Schema Reject'
  WHEN decision_detail = 'Duplicate Customer' THEN 'Dedup Reject' ELSE 'Others' END END AS reject_reason, decision_detail, CAST(uw_cost AS DOUBLE) AS uw_cost, CAST(a.lead_cost AS DOUBLE) AS lead_cost, CAST(TRY_CAST(regexp_replace(nmi, '[$,]', '', 'g') AS DECIMAL(18,2)) AS DOUBLE) AS net_income,
  CAST(CASE WHEN l.origination_loan_id IS NOT NULL THEN approved_amount END AS DOUBLE) AS originated_loan_amount, is_fpd AS is_first_payment_defaulted FROM application a LEFT JOIN leads0 l ON l.lead_sequence_id = a.lead_sequence_id LEFT JOIN fpd ON fpd.origination_loan_id = l.origination_loan_id
  WHERE a.lead_provider_id IN (1, 2) AND uw_cost >= 0 AND decision_detail NOT LIKE 'Flow%'""")
def _(v):
    return measure.affiliate_detail(v.application, v.leads0, fpd(v), [1, 2])


CODES = """codes AS (SELECT affid, state AS cs, max(CASE WHEN decision = 'ACCEPT' THEN 1 ELSE 0 END) AS is_accepted, min(insert_date) AS first_insert_date, max(insert_date) AS recent_insert_date, CAST(sum(uw_cost) AS DOUBLE) AS uw_cost,
  coalesce(arg_min(lead_sequence_id, (insert_date, lead_sequence_id)) FILTER (decision = 'ACCEPT'), arg_min(lead_sequence_id, (insert_date, lead_sequence_id))) AS lead_sequence_id FROM application GROUP BY 1, 2)"""


def response(group, where):
    return f"""SELECT '{group}' AS group_split, piece_id, promotion_code, state, CASE WHEN c.lead_sequence_id IS NOT NULL THEN 1 ELSE 0 END AS is_applied, coalesce(is_accepted, 0) AS is_accepted, c.lead_sequence_id, first_insert_date, recent_insert_date, uw_cost,
  coalesce(isoriginated, 0) AS is_originated, loan_status, CAST(CASE WHEN isoriginated = 1 THEN approved_amount END AS DOUBLE) AS originated_loan_amount FROM pieces LEFT JOIN codes c ON affid = promotion_code AND cs = state
  LEFT JOIN (SELECT lead_sequence_id AS lk, isoriginated, loan_status, approved_amount FROM leads0) l ON lk = c.lead_sequence_id WHERE {where}"""


@query("N10_mail_response", "pieces application leads0", f"WITH {CODES} {response('Mail', 'true')} UNION ALL {response('Remail', 'is_remail = 1')}")
def _(v):
    a = measure.mail_response(v.pieces, v.application, v.leads0, "Mail", "promotion_code")
    return a.unionByName(measure.mail_response(v.pieces.filter("is_remail = 1"), v.application, v.leads0,
                                               "Remail", "promotion_code"))


LABELS = [("Auto A", "Auto"), ("Auto B", "Auto"), ("House", "House"), ("House 2", "House")]
LABEL_SQL = "(VALUES " + ", ".join(f"('{a}', '{b}')" for a, b in LABELS) + ") AS g(name, label)"
CODED = """coded AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY mapping_id, affid ORDER BY insert_date, lead_sequence_id) AS rn FROM application JOIN mail_map ON lower(affid) LIKE lower(trim(pattern))
  AND CAST(insert_date AS DATE) BETWEEN start_date - 5 AND expire_date + 1 {more}) q WHERE rn = 1)"""


def div(a, b):
    return f"CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0)"


@query("N11_mail_performance", "application mail_map leads0 items schedules", f"""WITH {FPD}, {CODED.format(more='')}, fine AS (SELECT dm_name, start_date, total_mail_count, unit_cost, sum(uw_cost) AS uw_cost, count(*) AS applied, count(*) FILTER (decision = 'ACCEPT') AS accepted, count(lk) AS originated,
    count(is_fpd) AS debited, coalesce(sum(is_fpd), 0) AS fpd FROM coded LEFT JOIN (SELECT lead_sequence_id AS lk, origination_loan_id AS ol FROM leads0 WHERE isoriginated = 1) l ON lk = lead_sequence_id LEFT JOIN fpd ON fpd.origination_loan_id = ol GROUP BY 1, 2, 3, 4),
  camp AS (SELECT coalesce(label, dm_name) AS campaign, min(start_date) AS start_date, sum(total_mail_count) AS mailed, max(unit_cost) AS unit_cost, sum(uw_cost) AS uw_cost, sum(applied) AS applied, sum(accepted) AS accepted, sum(originated) AS originated, sum(debited) AS debited, sum(fpd) AS fpd
    FROM fine LEFT JOIN {LABEL_SQL} ON name = dm_name GROUP BY 1), c2 AS (SELECT *, CAST(unit_cost * mailed AS DECIMAL(18,2)) AS cost FROM camp)
  SELECT CAST(year(start_date) AS INTEGER) AS year, count(campaign) AS campaign_cnt, {', '.join(f'CAST(sum({c}) AS BIGINT) AS {c}' for c in ('mailed', 'applied', 'accepted', 'originated', 'debited', 'fpd'))}, {', '.join(f'CAST(sum({c}) AS DOUBLE) AS {c}' for c in ('uw_cost', 'cost'))},
  round(avg({div('applied', 'mailed')}), 6) AS net_response, round(avg({div('accepted', 'mailed')}), 6) AS accepted_response, round(avg({div('originated', 'accepted')}), 6) AS conversion, round(avg({div('fpd', 'originated')}), 6) AS fpd_rate, round(avg({div('cost', 'originated')}), 6) AS cpf,
  round(avg({div('(cost + uw_cost)', 'originated')}), 6) AS cpf_with_uw, round({div('sum(cost)', 'sum(mailed)')}, 6) AS average_unit_cost FROM c2 GROUP BY 1""")
def _(v):
    labels = v.spark.createDataFrame(LABELS, "name string, label string")
    p = measure.mail_performance(measure.mail_campaigns(v.application, v.mail_map, v.leads0, fpd(v), labels))
    fl = ("net_response", "accepted_response", "conversion", "fpd_rate", "cpf", "cpf_with_uw", "average_unit_cost")
    return p.withColumns({c: F.round(c, 6) for c in fl})


MCTX = RunContext(dt.datetime(1998, 1, 15, 9))


@query("N12_mail_totals", "application mail_map", f"""WITH {CODED.format(more="AND CAST(insert_date AS DATE) BETWEEN DATE '1998-01-15' - 90 AND DATE '1998-01-15'")} SELECT mapping_id, dm_name,
  CASE WHEN expire_date >= DATE '1998-01-14' THEN coalesce(n, 0) ELSE 0 END AS total_application FROM mail_map LEFT JOIN (SELECT dm_name AS d, count(*) AS n FROM coded WHERE mapping_id <> 5 OR state <> 'NATION_2' GROUP BY 1) t ON d = dm_name""")
def _(v):
    return measure.mail_totals(v.application, v.mail_map, MCTX, {5: F.col("state") != "NATION_2"}).select(
        "mapping_id", "dm_name", "total_application")


@query("N13_received_flag", "leads0 history", """SELECT a.lms_code, a.lms_application_id, state, isoriginated, last_contact_date, contacts, CASE WHEN contacts IS NOT NULL THEN 1 ELSE 0 END AS is_received FROM leads0 a LEFT JOIN (SELECT lms_code AS hc, lms_application_id AS hk, max(business_date) AS last_contact_date, count(*) AS contacts
  FROM history WHERE list_module = 'WAD' AND date_diff('day', CAST(withdrawn_time AS DATE), CAST(list_generation_time AS DATE)) IN (-3, -1, 0, 1) GROUP BY 1, 2) h ON hc = a.lms_code AND hk = a.lms_application_id""")
def _(v):
    return measure.received_flag(v.leads0, v.history, "WAD", (-3, -1, 0, 1))


N14_HISTORY = """hist AS (SELECT user_name AS email, event_ts AS received_time, event_ts + INTERVAL 60 MINUTE AS list_generation_time FROM tracking WHERE page = 'account_terms')"""


@query("N14_post_campaign", "tracking leads0 items", f"""WITH {N14_HISTORY}, s AS (SELECT email, min(received_time) AS first_drop_off, min(list_generation_time) AS first_contact, max(list_generation_time) AS last_contact, count(DISTINCT list_generation_time) AS sent_attempt FROM hist GROUP BY 1
    HAVING CAST(max(list_generation_time) AS DATE) < DATE '1998-03-02' - 7),
  l AS (SELECT * FROM (SELECT emailaddress AS le, received_time AS acc, isoriginated, origination_loan_id, row_number() OVER (PARTITION BY emailaddress ORDER BY received_time DESC, lms_application_id DESC) AS rn FROM leads0 WHERE isuniqueaccept = 1 AND received_time < TIMESTAMP '1998-03-02 00:00:00') q WHERE rn = 1),
  j AS (SELECT s.*, l.*, last_contact + INTERVAL 7 DAY AS ev_end, CASE WHEN acc BETWEEN first_drop_off AND first_contact THEN 11 WHEN acc < first_drop_off THEN 0 ELSE 1 END AS is_correct_sent,
    (SELECT min(event_ts) FROM tracking t WHERE t.user_name = s.email AND event_ts BETWEEN last_contact AND last_contact + INTERVAL 7 DAY) AS cb, (SELECT count(*) FROM tracking t WHERE t.user_name = s.email AND page = 'payment_schedule_submit' AND event_ts BETWEEN last_contact AND last_contact + INTERVAL 7 DAY) AS sub FROM s LEFT JOIN l ON le = s.email),
  d AS (SELECT payment_schedule_id AS dl, max(item_date) AS last_draw_date, count(*) AS draw_sequence FROM items WHERE total_amount < 0 AND status IN ('cleared', 'sent') GROUP BY 1)
  SELECT email, first_contact, last_contact, sent_attempt, is_correct_sent, CASE WHEN (is_correct_sent = 1 AND cb IS NOT NULL) OR is_correct_sent = 11 THEN 1 ELSE 0 END AS is_come_back, CASE WHEN is_correct_sent = 1 THEN cb END AS comeback_time,
  CASE WHEN (is_correct_sent = 1 AND sub > 0) OR (is_correct_sent = 11 AND acc IS NOT NULL) THEN 1 ELSE 0 END AS is_submit, CASE WHEN (is_correct_sent = 1 AND acc BETWEEN last_contact AND ev_end) OR is_correct_sent = 11 THEN 1 ELSE 0 END AS is_accepted,
  CASE WHEN ((is_correct_sent = 1 AND acc BETWEEN last_contact AND ev_end) OR is_correct_sent = 11) AND isoriginated = 1 THEN 1 ELSE 0 END AS is_originated, coalesce(draw_sequence, 0) AS draw_sequence, last_draw_date FROM j LEFT JOIN d ON dl = origination_loan_id""")
def _(v):
    hist = v.tracking.filter("page = 'account_terms'").select(
        F.col("user_name").alias("email"), F.col("event_ts").alias("received_time"), F.lit("ACH").alias("list_module"),
        F.timestamp_add("MINUTE", F.lit(60), "event_ts").alias("list_generation_time"))
    draws = draw_sequence(v.items.withColumnRenamed("payment_schedule_id", "base_loan_id"), ["base_loan_id"])
    seen = v.leads0.filter(F.to_date("received_time") < F.lit("1998-03-02").cast("date"))
    return measure.post_campaign(hist, seen, v.tracking, draws, RunContext(dt.datetime(1998, 3, 2, 9)),
                                 ("ACH", "ACD", "ACB"))


@query("N15_sends_per_draw", "items leads0 history", """WITH d AS (SELECT lms_customer_id, max(item_date) AS last_draw_date, count(item_date) AS draw_sequence FROM items JOIN leads0 ON payment_schedule_id = origination_loan_id WHERE total_amount < 0 AND status IN ('cleared', 'sent') GROUP BY 1),
  h AS (SELECT lms_customer_id AS hk, month(business_date) AS total_draw_count, count(*) AS sent_attempt, max(business_date) AS last_contact FROM history GROUP BY 1, 2)
  SELECT lms_customer_id, last_draw_date, draw_sequence, CAST(total_draw_count AS INTEGER) AS total_draw_count, sent_attempt, last_contact, CASE WHEN last_contact IS NOT NULL THEN 1 ELSE 0 END AS is_received FROM d LEFT JOIN h ON hk = lms_customer_id WHERE draw_sequence >= 2""")
def _(v):
    draws = draw_sequence(v.items.join(v.leads0.select("lms_customer_id", "origination_loan_id"), F.col(
        "payment_schedule_id") == F.col("origination_loan_id")), ["lms_customer_id"])
    hist = v.history.select("lms_customer_id", F.month("business_date").alias("total_draw_count"),
                            F.col("business_date").alias("list_generation_date"))
    return measure.sends_per_draw(draws, hist)


@query("N16_sms_response", "history leads0 customer_flat calls", f"""WITH s AS (SELECT lms_code, lms_application_id, list_generation_time AS t, {USABLE} AS phone FROM history LEFT JOIN customer_flat ON customer_id = lms_customer_id WHERE list_module IN ('PA', 'WAD') AND is_transactional_optin = 1),
  c AS (SELECT s.*, (SELECT min(call_start_time) FROM calls WHERE regexp_replace(called_ani, '[^0-9]', '', 'g') = phone AND CAST(call_start_time AS DATE) BETWEEN CAST(t AS DATE) AND CAST(t AS DATE) + 1 AND call_start_time >= t) AS first_called_time FROM s)
  SELECT c.lms_application_id, phone, t AS list_generation_time, first_called_time, CASE WHEN first_called_time BETWEEN t AND t + INTERVAL 24 HOUR THEN 1 ELSE 0 END AS is_called_in,
  CASE WHEN origination_time BETWEEN t AND t + INTERVAL 24 HOUR THEN 1 ELSE 0 END AS is_originated FROM c LEFT JOIN leads0 l ON l.lms_code = c.lms_code AND l.lms_application_id = c.lms_application_id""")
def _(v):
    return measure.sms_response(v.history, v.leads0, v.customer_flat, v.calls, ("PA", "WAD"), PLACEHOLDERS)


@query("N17_repeat_tracking", "leads legacy_loans legacy_payments schedules items", """WITH b AS (SELECT CASE WHEN original_loan_id = 0 THEN id ELSE original_loan_id END AS k, max(effective_date) AS last_payment_date FROM legacy_loans JOIN legacy_payments ON loan_id = id WHERE loan_status NOT IN ('deleted', 'voided renewed loan') AND payment_status = 'checked' AND is_debit = 1 GROUP BY 1
    UNION SELECT base_loan_id, max(item_date) FROM schedules s JOIN items i ON i.payment_schedule_id = s.payment_schedule_id WHERE status = 'cleared' AND total_amount > 0 GROUP BY 1),
  j AS (SELECT a.lms_code, a.lms_customer_id, a.lms_application_id, a.state, a.product, a.loan_sequence, last_payment_date, n.received_time AS nr, n.lead_cost AS nc, n.origination_loan_id AS nl, n.origination_time AS no, n.approved_amount AS na,
    CASE WHEN CAST(n.received_time AS DATE) BETWEEN last_payment_date AND DATE '2001-09-22' THEN 1 ELSE 0 END AS fits FROM leads a JOIN b ON k = a.lms_application_id LEFT JOIN leads n ON n.lms_code = a.lms_code AND n.lms_customer_id = a.lms_customer_id AND n.loan_sequence = a.loan_sequence + 1 AND n.isuniqueaccept = 1
    WHERE last_payment_date BETWEEN DATE '1995-01-01' AND DATE '2000-08-31')
  SELECT lms_code, lms_customer_id, lms_application_id, state, product, loan_sequence, last_payment_date, fits AS add_application, CASE WHEN fits = 1 THEN date_diff('day', last_payment_date, CAST(nr AS DATE)) END::INTEGER AS day_to_add_application, CASE WHEN fits = 1 AND nl IS NOT NULL THEN 1 ELSE 0 END AS add_origination,
  CASE WHEN fits = 1 THEN date_diff('day', last_payment_date, CAST(no AS DATE)) END::INTEGER AS day_to_add_origination, CAST(CASE WHEN fits = 1 AND nl IS NOT NULL THEN na END AS DOUBLE) AS approved_amount2, CASE WHEN fits = 1 THEN CASE WHEN nc > 1 THEN 'External' ELSE 'Internal' END END AS rc_channel FROM j""")
def _(v):
    return measure.repeat_tracking(paid_off.last_payment_legacy(v.legacy_loans, v.legacy_payments),
                                   paid_off.last_payment(v.schedules, v.items), v.leads, dt.date(1995, 1, 1),
                                   dt.date(2000, 8, 31), dt.date(2001, 9, 22))


@query("N18_consent_mix", f"leads0 customer_flat {CONSENT_VIEWS}", f"""WITH {CONSENT} SELECT strftime(received_time, '%Y %B') AS received_month, state, coalesce(is_transactional_optin, 0) AS is_transactional_optin, coalesce(is_sms_marketing_optin, 0) AS is_sms_marketing_optin,
  CASE WHEN f.customer_id IS NULL THEN NULL WHEN optout_account_email IS NULL OR lower(optout_account_email) = 'false' THEN 1 ELSE 0 END AS is_email_transactional_optin, CASE WHEN f.customer_id IS NULL THEN NULL WHEN optout_marketing_email IS NULL OR lower(optout_marketing_email) = 'false' THEN 1 ELSE 0 END AS is_email_marketing_optin,
  count(*) AS applications, CAST(sum(isoriginated) AS BIGINT) AS originated FROM leads0 LEFT JOIN optin o ON o.customer_id = lms_customer_id LEFT JOIN customer_flat f ON f.customer_id = lms_customer_id GROUP BY 1, 2, 3, 4, 5, 6""")
def _(v):
    return measure.consent_mix(v.leads0, optin(v), v.customer_flat)


@query("N19_needs_optout", f"leads0 {CONSENT_VIEWS}", f"""WITH {CONSENT} SELECT loan_number, lms_customer_id, application_status, loan_status, is_transactional_optin, is_sms_marketing_optin, CASE WHEN is_sms_marketing_optin = 0 AND is_transactional_optin = 1 THEN 1 ELSE 0 END AS needs_optout
  FROM leads0 JOIN optin ON customer_id = lms_customer_id WHERE lms_code = 'INST' AND loan_number IN (SELECT CAST(o_orderkey AS VARCHAR) FROM orders WHERE o_orderstatus = 'F')""")
def _(v):
    imported = v.orders.filter("o_orderstatus = 'F'").select(F.col("o_orderkey").cast("string").alias("loan_number"))
    return measure.needs_optout(imported, v.leads0, optin(v), "INST")


@query("N20_offer_gap", "leads limits entity_params", f"""WITH {CAPS}, old AS (SELECT * FROM (SELECT emailaddress AS oe, approved_amount AS previous_approved_amount, row_number() OVER (PARTITION BY emailaddress ORDER BY withdrawn_time DESC, lms_application_id DESC) AS rn FROM leads WHERE application_status = 'withdrawn' AND loan_sequence = 1) q WHERE rn = 1)
  SELECT lms_application_id, state, {dbl('approved_amount previous_approved_amount maximum_limit_by_state')}, isoriginated, CASE WHEN approved_amount > previous_approved_amount THEN 1 ELSE 0 END AS is_offer_higher, CASE WHEN maximum_limit_by_state > previous_approved_amount THEN 1 ELSE 0 END AS is_cap_higher
  FROM leads LEFT JOIN old ON oe = emailaddress LEFT JOIN caps ON cap_state = state""")
def _(v):
    return measure.offer_gap(v.leads, v.leads, caps(v))


@query("N21_campaign_outcome", "application leads0 items schedules", f"""WITH {FPD} SELECT a.lead_sequence_id, insert_date, a.campaign_name, a.state, a.product, CASE WHEN decision = 'ACCEPT' THEN 1 ELSE 0 END AS is_accept, CASE WHEN uw_cost > 0 OR decision = 'ACCEPT' THEN 1 ELSE 0 END AS is_unique_look, l.lms_code, coalesce(isoriginated, 0) AS is_originated,
  CAST(CASE WHEN isoriginated = 1 THEN approved_amount END AS DOUBLE) AS origination_loan_amount, withdrawn_reason, is_fpd AS is_first_payment_defaulted FROM application a LEFT JOIN (SELECT * FROM leads0 WHERE isuniqueaccept = 1) l ON l.lead_sequence_id = a.lead_sequence_id
  LEFT JOIN fpd ON fpd.origination_loan_id = l.origination_loan_id WHERE a.campaign_name IN ('MOB-#TAG#', 'WEB-DM')""")
def _(v):
    return measure.campaign_outcome(v.application, v.leads0, fpd(v), ("MOB-#TAG#", "WEB-DM"))


@query("N22_delivery_rates", "stats labels_map", f"""SELECT report_date, label AS list_name, CAST(sum(requests) AS BIGINT) AS total_sent, CAST(sum(delivered) AS DOUBLE) / 2 AS total_delivered, {', '.join(f'CAST(sum({c}) AS BIGINT) AS total_{c}' for c in ('unique_opens', 'unique_clicks', 'unsubscribes', 'bounces'))},
  {div('CAST(sum(delivered) AS DOUBLE) / 2', 'sum(requests)')} AS delivered_rate, {div('sum(unique_opens)', 'CAST(sum(delivered) AS DOUBLE) / 2')} AS unique_open_rate, {div('sum(unique_clicks)', 'sum(unique_opens)')} AS unique_ctr FROM stats LEFT JOIN labels_map ON name = category GROUP BY 1, 2""")
def _(v):
    return measure.delivery_rates(v.stats, v.labels_map, 2)


LISTED = """listed AS (SELECT CASE list_module WHEN 'PA' THEN 'PA' WHEN 'WAD' THEN 'WAD' ELSE 'AC' END AS ln, business_date AS bd, count(*) * 40 AS n FROM history GROUP BY 1, 2)"""


@query("N23_reconcile", "stats labels_map history", f"""WITH {LISTED}, sent AS (SELECT label AS sl, report_date AS sd, CAST(sum(requests) AS BIGINT) AS q FROM stats JOIN labels_map ON name = category GROUP BY 1, 2)
  SELECT coalesce(sl, ln) AS list_name, coalesce(sd, bd) AS report_date, q AS total_sent, coalesce(n, 0) AS total_listed, CASE WHEN q BETWEEN n - 15 AND n + 15 THEN 1 ELSE 0 END AS is_matched, CASE WHEN sd = bd THEN 1 ELSE 0 END AS is_ran, CASE WHEN q > coalesce(n, 0) THEN 1 ELSE 0 END AS is_more
  FROM sent FULL JOIN listed ON sl = ln AND sd = bd""")
def _(v):
    sent = measure.delivery_rates(v.stats, v.labels_map).filter("list_name is not null").select(
        "list_name", "report_date", "total_sent")
    name = F.when(F.col("list_module").isin("PA", "WAD"), F.col("list_module")).otherwise("AC")
    listed = v.history.groupBy(name.alias("list_name"), "business_date").agg(
        (F.count("*") * 40).alias("total_listed"))
    return measure.reconcile(sent, listed, 15)


@query("N24_rerun_days", "history", "SELECT business_date, list_module, count(DISTINCT list_generation_time) AS ran_cnt, max(list_generation_time) AS last_gen, min(list_generation_time) AS first_gen FROM history WHERE list_module NOT IN ('DDR') GROUP BY 1, 2 HAVING count(DISTINCT list_generation_time) > 1")
def _(v):
    return measure.rerun_days(v.history, ("DDR",))


def volume(label, where, days):
    return f"""SELECT CAST(month(list_generation_time) AS INTEGER) AS month, business_date, lms_customer_id, lms_application_id, state, product, days_since_paidoff, list_module || '_' || days_since_paidoff AS list_name, {label} AS group_filter FROM h WHERE {where} AND days_since_paidoff IN {days}"""


DAYS1, DAYS2 = tuple(range(-30, 0, 3)), tuple(range(-60, 0, 2))


@query("N25_list_volume", "history", f"""WITH h AS (SELECT *, date_diff('day', last_repayment_date, CAST(list_generation_time AS DATE))::INTEGER AS days_since_paidoff FROM history WHERE list_module = 'POL_NEW')
  {volume("'N3_BUILDING'", "state = 'NATION_3' AND product = 'BUILDING'", DAYS1)} UNION {volume("concat_ws('_', state, product)", "state <> 'NATION_9'", DAYS2)}""")
def _(v):
    return measure.list_volume(v.history, [
        ("N3_BUILDING", (F.col("state") == "NATION_3") & (F.col("product") == "BUILDING"), DAYS1),
        (None, F.col("state") != "NATION_9", DAYS2)], "POL_NEW")


BCTX = RunContext(dt.datetime(1999, 6, 1, 9))


@query("N26_bad_leads", "leads0", f"""SELECT DISTINCT label AS provider_group, lms_application_id, state, campaign_name, CAST(lead_cost AS DOUBLE) AS lead_cost, CAST(received_time AS DATE) AS received_date, isoriginated, application_status, withdrawn_reason, affid, subid FROM leads0 LEFT JOIN {PROVIDER_SQL} ON name = provider_name
  WHERE withdrawn_reason IN ('reason 3', 'reason 7', 'reason 11', 'reason 20') AND lead_cost > 1 AND CAST(withdrawn_time AS DATE) >= DATE '1999-06-01' - 720 AND CAST(withdrawn_time AS DATE) < DATE '1999-06-01'""")
def _(v):
    return measure.bad_leads(v.leads0, providers(v), ("reason 3", "reason 7", "reason 11", "reason 20"), BCTX, 720)


PCTX = RunContext(dt.datetime(1998, 3, 2, 9))


@query("N26_lead_performance", "leads visits", f"""SELECT DISTINCT label AS provider_group, lms_application_id, state, campaign_name, CAST(lead_cost AS DOUBLE) AS lead_cost, CAST(received_time AS DATE) AS received_date, isoriginated, application_status, withdrawn_reason,
  CASE WHEN EXISTS (SELECT 1 FROM visits e WHERE e.lms_customer_id = a.lms_customer_id AND page IN ('welcome', 'account_terms') AND event_ts BETWEEN received_time - INTERVAL 2 MINUTE AND received_time + INTERVAL 5 MINUTE) THEN 1 ELSE 0 END AS is_redirect
  FROM leads a LEFT JOIN {PROVIDER_SQL} ON name = provider_name WHERE loan_sequence = 1 AND lead_cost > 1 AND CAST(received_time AS DATE) BETWEEN DATE '1998-03-02' - 1200 AND DATE '1998-03-01'""")
def _(v):
    return measure.lead_performance(v.leads, v.visits, providers(v), PCTX, ("welcome", "account_terms"), 1200)


@query("N27_referral_outcome", "user_info application leads0 items schedules", """WITH t AS (SELECT email AS te, count(*) AS n, max(CASE WHEN decision = 'ACCEPT' THEN 1 ELSE 0 END) AS acc, max(insert_date) AS last_apply_time FROM application WHERE CAST(insert_date AS DATE) >= DATE '1999-12-12' GROUP BY 1),
  d AS (SELECT emailaddress AS de, count(*) AS topup_cnt, CAST(sum(total_amount) AS DOUBLE) AS total_topup_amt FROM items i JOIN schedules s ON s.payment_schedule_id = i.payment_schedule_id JOIN leads0 ON origination_loan_id = base_loan_id WHERE total_amount < 0 AND status IN ('sent', 'cleared') AND item_date > DATE '1999-12-12' GROUP BY 1)
  SELECT email, CASE WHEN n >= 1 THEN 1 ELSE 0 END AS is_apply, coalesce(acc, 0) AS is_accept, last_apply_time, CASE WHEN topup_cnt > 0 THEN 1 ELSE 0 END AS is_top_up, coalesce(topup_cnt, 0) AS topup_cnt, total_topup_amt FROM user_info LEFT JOIN t ON te = email LEFT JOIN d ON de = email""")
def _(v):
    return measure.referral_outcome(v.user_info.select("email"), v.application, v.leads0, v.schedules, v.items,
                                    dt.date(1999, 12, 12))


@query("N28_missing_stage", "application leads0", """SELECT lead_sequence_id, CAST(insert_date AS DATE) AS insert_day, CASE WHEN o_totalprice < 40000 THEN 'NOT IN LMS' WHEN o_totalprice < 90000 THEN 'NOT IN LA' WHEN o_totalprice < 120000 THEN 'NOT IN FACT' ELSE 'OKAY' END AS checker
  FROM application JOIN orders ON o_orderkey = lead_sequence_id WHERE decision = 'ACCEPT'""")
def _(v):
    headers = v.orders.filter("o_totalprice >= 40000").select(
        F.col("o_orderkey").alias("lead_sequence_id"), F.col("o_orderkey").alias("loan_header_id"))
    keep = v.orders.filter("o_totalprice >= 90000").select(F.col("o_orderkey").alias(ID))
    known = v.orders.filter("o_totalprice >= 120000").select(F.col("o_orderkey").alias("original_lead_id"))
    return measure.missing_stage(v.application, headers, keep, known)


@query("N29_withdrawn_extract", "leads", """SELECT lms_customer_id, lms_application_id, state, product, provider_name, campaign_name, CAST(lead_cost AS DOUBLE) AS lead_cost, received_time, withdrawn_reason, withdrawn_time, date_sub('minute', received_time, withdrawn_time) AS minute_to_withdrawn
  FROM (SELECT *, row_number() OVER (PARTITION BY lms_customer_id ORDER BY received_time DESC, lms_application_id DESC) AS rn FROM leads WHERE application_status = 'withdrawn' AND loan_sequence = 1 AND lead_cost > 1 AND CAST(received_time AS DATE) >= DATE '1995-01-01' AND CAST(received_time AS DATE) < DATE '2002-01-01') q WHERE rn = 1""")
def _(v):
    return measure.withdrawn_extract(v.leads, dt.date(1995, 1, 1), dt.date(2002, 1, 1))


@query("N30_lead_detail", "application leads", f"""SELECT a.lead_sequence_id, insert_date, label AS lead_provider_name, a.campaign_name, a.state, CASE WHEN a.lead_cost <= 10 THEN '$3-$10' WHEN a.lead_cost <= 20 THEN '$11-$20' WHEN a.lead_cost <= 30 THEN '$21-$30' WHEN a.lead_cost <= 40 THEN '$31-$40' WHEN a.lead_cost > 40 THEN '$41+' END AS lead_bid_group,
  dayname(insert_date) AS day_received, CAST(hour(insert_date) AS INTEGER) AS hour_received, monthname(insert_date) AS month_received, CASE WHEN contains(a.campaign_name, '#') THEN 1 ELSE 0 END AS is_tag_campaign, isreturning, CASE WHEN uw_cost > 0 OR decision = 'ACCEPT' THEN 1 ELSE 0 END AS is_unique_look,
  CAST(uw_cost + a.lead_cost AS DOUBLE) AS marketing_cost, decision_detail FROM application a LEFT JOIN (VALUES ('1', 'Provider One'), ('2', 'Provider Two')) AS g(name, label) ON CAST(name AS INTEGER) = a.lead_provider_id LEFT JOIN leads l ON l.lead_sequence_id = a.lead_sequence_id
  WHERE decision = 'ACCEPT' AND CAST(insert_date AS DATE) >= DATE '1995-01-01' AND CAST(insert_date AS DATE) < DATE '2002-01-01'""")
def _(v):
    names = v.spark.createDataFrame([("1", "Provider One"), ("2", "Provider Two")], "name string, label string")
    apps = v.application.withColumn("lead_provider_id", F.col("lead_provider_id").cast("string"))
    return measure.lead_detail(apps, v.leads, names, dt.date(1995, 1, 1), dt.date(2002, 1, 1))
