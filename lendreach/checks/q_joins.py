"""Join operators over whole tables."""

import datetime as dt

from pyspark.sql import functions as F

from lendreach.checks.common import MAX_LIMIT, USABLE, VARIANT
from lendreach.checks.registry import dbl, query
from lendreach.checks.views import PLACEHOLDERS, REMAP
from lendreach.functions.flags import usable_phone
from lendreach.functions.money import max_limit
from lendreach.functions.text import norm_key
from lendreach.operators import joins
from lendreach.operators.calendar import target_date
from lendreach.operators.limits import rate_card_join

ID = "lms_application_id"


@query("J01_inner_composite", "leads0 loans", """SELECT lms_application_id, base_loan_id, l.loan_status FROM loans l
  JOIN leads0 a ON l.customer_id = a.lms_customer_id AND l.loan_header_id = a.lms_application_id""")
def _(v):
    a = v.leads0.select("lms_customer_id", ID)
    return v.loans.join(a, (F.col("customer_id") == F.col("lms_customer_id"))
                        & (F.col("loan_header_id") == F.col(ID))).select(
        ID, "base_loan_id", "loan_status")


@query("J02_left_enrich_chain", "leads0 customer_flat application todo", """SELECT lms_application_id, homephone, decision, first_step FROM leads0
  LEFT JOIN customer_flat ON lms_customer_id = customer_id
  LEFT JOIN (SELECT lead_sequence_id AS ls, decision FROM application) a ON ls = leads0.lead_sequence_id
  LEFT JOIN (SELECT loan_header_id, min(todo_name) AS first_step FROM todo GROUP BY 1) t ON loan_header_id = lms_application_id""")
def _(v):
    flat = v.customer_flat.withColumnRenamed("customer_id", "lms_customer_id")
    steps = v.todo.select(F.col("loan_header_id").alias(ID), F.col("todo_name").alias("first_step"))
    return joins.enrich(v.leads0.select(ID, "lms_customer_id", "lead_sequence_id"), [
        joins.Lookup(flat, ["lms_customer_id"], ["homephone"], unique=True),
        joins.Lookup(v.application, ["lead_sequence_id"], ["decision"], unique=True),
        joins.Lookup(steps, [ID], ["first_step"], [F.col("first_step")]),
    ]).select(ID, "homephone", "decision", "first_step")


@query("J03_right_outer", "loans leads0", """SELECT lms_application_id, base_loan_id FROM loans RIGHT JOIN
  (SELECT lms_application_id FROM leads0) a ON loan_header_id = lms_application_id""")
def _(v):
    return v.loans.join(v.leads0.select(ID), F.col("loan_header_id") == F.col(ID),
                        "right").select(ID, "base_loan_id")


@query("J04_root_id_join", "leads0 legacy_loans", """SELECT lms_application_id, id, l.loan_status FROM legacy_loans l JOIN leads0 a
  ON a.lms_customer_id = l.debtor_client_id AND a.lms_application_id = CASE WHEN original_loan_id = 0 THEN id ELSE original_loan_id END""")
def _(v):
    loans = joins.with_root_id(v.legacy_loans, "id", "original_loan_id")
    a = v.leads0.select("lms_customer_id", ID)
    return loans.join(a, (F.col("debtor_client_id") == F.col("lms_customer_id"))
                      & (F.col("root_id") == F.col(ID))).select(ID, "id", "loan_status")


@query("J05_rate_card", "leads rates", f"""SELECT lms_application_id, {dbl('rpp hardcap')}, {VARIANT} AS rate_product, {MAX_LIMIT} AS max_limit
  FROM leads LEFT JOIN rates r ON state = state_code AND {VARIANT} = product_code
  AND least(leads.loan_sequence, 7) = r.loan_sequence AND leads.pay_frequency = r.pay_frequency""")
def _(v):
    return rate_card_join(v.leads, v.rates, F.col("pay_frequency"), remap=REMAP).select(
        ID, "rpp", "hardcap", "rate_product",
        max_limit(F.col("paycheck"), F.col("rpp"), F.col("hardcap")).alias("max_limit"))


PATTERN = """lower(affid) LIKE lower(trim(pattern)) AND CAST(insert_date AS DATE) BETWEEN start_date - 5 AND expire_date + 1"""


@query("J06_pattern_range", "application mail_map", f"SELECT lead_sequence_id, affid, insert_date, mapping_id, dm_name FROM application JOIN mail_map ON {PATTERN}")
def _(v):
    return joins.pattern_range_join(
        v.application.select("lead_sequence_id", "affid", "insert_date"), v.mail_map, "affid",
        "pattern", F.to_date("insert_date"), "start_date", "expire_date", 5, 1).select(
        "lead_sequence_id", "affid", "insert_date", "mapping_id", "dm_name")


PATTERNS = ("%00001%", "A_TO%", "%L_00%7", "MACH%", " hous%9 ", "%", "b", "BUIL0000010", "%zz%", "_UIL%")


@query("J06_pattern_index", "application", "WITH m AS (SELECT * FROM (VALUES " + ", ".join(
    f"({i}, '{p}', DATE '1995-01-01' + {i * 90}, DATE '1997-06-30' + {i * 60})" for i, p in enumerate(PATTERNS)) + """) AS t(mapping_id, pattern, start_date, expire_date))
  SELECT lead_sequence_id, affid, insert_date, mapping_id FROM application JOIN m ON lower(affid) LIKE lower(trim(pattern)) AND CAST(insert_date AS DATE) BETWEEN start_date - 5 AND expire_date""")
def _(v):
    dim = v.spark.createDataFrame([(i, p, dt.date(1995, 1, 1) + dt.timedelta(i * 90), dt.date(1997, 6, 30) + dt.timedelta(i * 60))
                                   for i, p in enumerate(PATTERNS)], "mapping_id int, pattern string, start_date date, expire_date date")
    return joins.pattern_index_join(v.application.select("lead_sequence_id", "affid", "insert_date"), dim, "affid", "pattern",
                                    "mapping_id", F.to_date("insert_date"), "start_date", "expire_date", 5).select(
        "lead_sequence_id", "affid", "insert_date", "mapping_id")


@query("J07_first_match", "application mail_map", f"""SELECT a.lead_sequence_id, m.dm_name FROM application a LEFT JOIN (
  SELECT lead_sequence_id, dm_name FROM (SELECT lead_sequence_id, dm_name, row_number() OVER (PARTITION BY lead_sequence_id
  ORDER BY start_date, mapping_id) AS rn FROM application JOIN mail_map ON {PATTERN}) z WHERE rn = 1) m
  ON a.lead_sequence_id = m.lead_sequence_id""")
def _(v):
    a = v.application.select("lead_sequence_id", "affid", "insert_date")
    return joins.first_match(a, v.mail_map, ["lead_sequence_id"],
                             [F.col("start_date"), F.col("mapping_id")], ["dm_name"], code="affid",
                             pattern="pattern", day=F.to_date("insert_date"), start="start_date",
                             end="expire_date", pad_before=5, pad_after=1).select(
        "lead_sequence_id", "dm_name")


@query("J08_interval", "visits calls", """SELECT v.id, c.id AS call_id FROM visits v JOIN (SELECT id, call_start_time,
  CAST(substr(regexp_replace(called_ani, '[^0-9]', '', 'g'), 4) AS BIGINT) * 10 + 1 AS cust FROM calls) c
  ON v.lms_customer_id = c.cust AND c.call_start_time BETWEEN v.event_ts - INTERVAL 120 MINUTE AND v.event_ts + INTERVAL 300 MINUTE""")
def _(v):
    calls = v.calls.select(F.col("id").alias("call_id"), "call_start_time", (
        F.substr(F.regexp_replace("called_ani", "[^0-9]", ""), F.lit(4)).cast("bigint") * 10 + 1)
        .alias("lms_customer_id"))
    return joins.interval_join(v.visits.select("id", "event_ts", "lms_customer_id"), calls,
                               "lms_customer_id", "event_ts", "call_start_time", -120, 300).select(
        "id", "call_id")


@query("J09_link_sequence", "leads", """SELECT a.lms_application_id, b.lms_application_id AS next_lms_application_id, b.application_status AS next_application_status
  FROM leads a LEFT JOIN leads b ON a.lms_customer_id = b.lms_customer_id AND a.lms_code = b.lms_code AND b.loan_sequence = a.loan_sequence + 1""")
def _(v):
    return joins.link_sequence(v.leads, ["lms_customer_id", "lms_code"], "loan_sequence", 1,
                               [ID, "application_status"], "next_").select(
        ID, "next_lms_application_id", "next_application_status")


@query("J10_exclude_later", "leads0", """SELECT lms_application_id FROM leads0 la WHERE application_status = 'pending' AND NOT EXISTS (
  SELECT 1 FROM leads0 la2 WHERE la2.lms_customer_id = la.lms_customer_id AND la2.application_status IN ('withdrawn', 'originated')
  AND CAST(la2.received_time AS DATE) >= CAST(la.received_time AS DATE))""")
def _(v):
    day = F.to_date("received_time")
    closed = v.leads0.filter(F.col("application_status").isin("withdrawn", "originated"))
    return joins.exclude_later(v.leads0.filter("application_status = 'pending'"), closed,
                               "lms_customer_id", day, day).select(ID)


@query("J11_exclude", "leads0", """SELECT lms_application_id FROM leads0 WHERE application_status = 'withdrawn' AND lms_customer_id NOT IN
  (SELECT lms_customer_id FROM leads0 WHERE application_status <> 'withdrawn')""")
def _(v):
    return joins.exclude(v.leads0.filter("application_status = 'withdrawn'"),
                         v.leads0.filter("application_status <> 'withdrawn'"),
                         ["lms_customer_id"]).select(ID)


@query("J12_keep_in", "leads0 visits", "SELECT lms_application_id FROM leads0 WHERE lms_customer_id IN (SELECT lms_customer_id FROM visits WHERE page = 'create_password_submit')")
def _(v):
    return joins.keep_in(v.leads0, v.visits.filter("page = 'create_password_submit'"),
                         ["lms_customer_id"]).select(ID)


@query("J13_tuple_in", "leads0", """SELECT lms_application_id FROM leads0 WHERE (lms_code, state, product) IN
  (SELECT lms_code, state, product FROM leads0 WHERE loan_status = 'default')""")
def _(v):
    return joins.keep_in(v.leads0, v.leads0.filter("loan_status = 'default'"),
                         ["lms_code", "state", "product"]).select(ID)


@query("J14_cross_system", "leads0", """SELECT lms_application_id FROM leads0 a WHERE NOT EXISTS (SELECT 1 FROM leads0 b
  WHERE lower(a.emailaddress) = lower(b.emailaddress) AND a.lms_code <> b.lms_code
  AND (CAST(b.origination_time AS DATE) >= CAST(a.received_time AS DATE)
   OR (b.application_status = 'pending' AND CAST(b.received_time AS DATE) >= CAST(a.received_time AS DATE))))""")
def _(v):
    active = F.greatest(F.to_date("origination_time"), F.when(
        F.col("application_status") == "pending", F.to_date("received_time")))
    return joins.exclude_cross_system(v.leads0, v.leads0, "emailaddress", "lms_code",
                                      F.to_date("received_time"), active).select(ID)


@query("J15_scalar_lookup", "leads0 limits", """SELECT lms_application_id, pick.maximum_limit AS maximum_limit FROM leads0 LEFT JOIN (
  SELECT entity_id, pay_frequency, CAST(maximum_limit AS DOUBLE) AS maximum_limit FROM (SELECT *, row_number() OVER (PARTITION BY entity_id, pay_frequency
  ORDER BY effective_date DESC, maximum_limit DESC) AS rn FROM limits) z WHERE rn = 1) pick
  ON pick.entity_id = lms_entity_id AND pick.pay_frequency = leads0.pay_frequency""")
def _(v):
    a = v.leads0.select(ID, F.col("lms_entity_id").alias("entity_id"), "pay_frequency")
    return joins.lookup_one(a, v.limits, ["entity_id", "pay_frequency"], "maximum_limit", [
        F.col("effective_date").desc(), F.col("maximum_limit").desc()]).select(ID, "maximum_limit")


@query("J16_asof_previous", "leads0", """SELECT lms_application_id, received_time, previous, date_diff('day', CAST(previous AS DATE), CAST(received_time AS DATE))::INTEGER AS days_since FROM (
  SELECT lms_application_id, received_time, (SELECT max(h.received_time) FROM leads0 h WHERE h.person_id = a.person_id
  AND h.application_status = 'originated' AND h.received_time < a.received_time) AS previous FROM leads0 a) z""")
def _(v):
    history = v.leads0.filter("application_status = 'originated'").select(
        "person_id", "received_time", F.col("received_time").alias("at"))
    return joins.asof_previous(v.leads0, ["person_id"], "received_time",
                               {"previous": (history, "at")}).select(
        ID, "received_time", "previous", F.datediff(F.to_date("received_time"), F.to_date(
            "previous")).alias("days_since"))


@query("J17_typed_keys", "accounts leads0", """SELECT account_number, lms_application_id FROM accounts JOIN leads0
  ON CAST(ltrim(account_number, '0') AS BIGINT) = lms_customer_id""")
def _(v):
    return v.accounts.join(v.leads0.select("lms_customer_id", ID), norm_key(F.col(
        "account_number")) == F.col("lms_customer_id")).select("account_number", ID)


@query("J18_match_calls", "leads0 customer_flat calls", f"""SELECT lms_application_id, phone, min(call_start_time) AS first_called_time FROM (
  SELECT lms_application_id, {USABLE} AS phone, CAST(received_time AS DATE) AS d FROM leads0 LEFT JOIN customer_flat ON customer_id = lms_customer_id) l
  LEFT JOIN calls ON regexp_replace(called_ani, '[^0-9]', '', 'g') = phone AND CAST(call_start_time AS DATE) BETWEEN d AND d + 10 GROUP BY 1, 2""")
def _(v):
    flat = v.customer_flat.select(F.col("customer_id").alias("lms_customer_id"), usable_phone(
        F.col("cellphone"), F.col("homephone"), PLACEHOLDERS).alias("phone"))
    lst = v.leads0.select(ID, "lms_customer_id", F.to_date("received_time").alias("d0")).join(
        flat, "lms_customer_id", "left").select(ID, "phone", "d0", F.date_add("d0", 10).alias("d1"))
    return joins.match_calls(lst, v.calls, "phone", "called_ani", "call_start_time", "d0",
                             "d1").select(ID, "phone", "first_called_time")


@query("J19_target_date", "accounts cal", """SELECT acct_id, CASE WHEN is_after_holiday = 1 THEN post_target_date ELSE pre_target_date END AS ach_date
  FROM accounts LEFT JOIN cal ON ori_date = date_of_total_due""")
def _(v):
    return target_date(v.accounts, v.cal, "date_of_total_due", "is_after_holiday",
                       "ach_date").select("acct_id", "ach_date")


@query("J20_full_outer", "leads0 stats", """SELECT coalesce(a.d, b.d) AS day, a.n AS received, b.n AS sent FROM
  (SELECT CAST(received_time AS DATE) AS d, count(*) AS n FROM leads0 GROUP BY 1) a
  FULL JOIN (SELECT report_date AS d, count(*) AS n FROM stats GROUP BY 1) b ON a.d = b.d""")
def _(v):
    a = v.leads0.groupBy(F.to_date("received_time").alias("_a")).agg(F.count("*").alias("received"))
    b = v.stats.groupBy(F.col("report_date").alias("_b")).agg(F.count("*").alias("sent"))
    return a.join(b, F.col("_a") == F.col("_b"), "full").select(
        F.coalesce("_a", "_b").alias("day"), "received", "sent")
