"""Grouping, ranking, ordering and set operators over whole tables."""

from pyspark.sql import functions as F

from lendreach.checks.registry import dbl, query
from lendreach.functions import flags
from lendreach.functions.money import rate
from lendreach.operators import aggregates, ranking
from lendreach.operators.calendar import next_weekday

ID = "lms_application_id"


@query("A01_group_by", "items", """SELECT payment_schedule_id, CAST(sum(total_amount) AS DOUBLE) AS total, CAST(max(amount_fee) AS DOUBLE) AS max_fee,
  min(item_date) AS first_date, count(*) AS n, round(avg(CAST(amount_int AS DOUBLE)), 6) AS avg_int FROM items GROUP BY 1""")
def _(v):
    return v.items.groupBy("payment_schedule_id").agg(
        F.sum("total_amount").alias("total"), F.max("amount_fee").alias("max_fee"),
        F.min("item_date").alias("first_date"), F.count("*").alias("n"),
        F.round(F.avg(F.col("amount_int").cast("double")), 6).alias("avg_int"))


@query("A02_conditional_sums", "items", """SELECT payment_schedule_id, CAST(coalesce(sum(CASE WHEN total_amount < 0 AND status = 'cleared' THEN amount_prin END), 0) AS DOUBLE) AS draws,
  count(*) FILTER (total_amount < 0 AND status = 'cleared') AS draw_cnt, max(CASE WHEN total_amount > 0 AND status = 'cleared' THEN item_date END) AS last_payment,
  min(CASE WHEN status = 'return' THEN item_date END) AS first_return FROM items GROUP BY 1""")
def _(v):
    draw = (F.col("total_amount") < 0) & (F.col("status") == "cleared")
    pay = (F.col("total_amount") > 0) & (F.col("status") == "cleared")
    return v.items.groupBy("payment_schedule_id").agg(*flags.cond_agg({
        "draws": ("sum", draw, F.col("amount_prin")), "draw_cnt": ("count", draw, None),
        "last_payment": ("max", pay, F.col("item_date")),
        "first_return": ("min", F.col("status") == "return", F.col("item_date"))}))


@query("A03_any_flags", "visits", """SELECT lms_customer_id, max(CASE WHEN page = 'reject' THEN 1 ELSE 0 END) AS rejected,
  max(CASE WHEN page LIKE 'loan_docs%' THEN 1 ELSE 0 END) AS reached_docs FROM visits GROUP BY 1""")
def _(v):
    return v.visits.groupBy("lms_customer_id").agg(
        flags.flag_any(F.col("page") == "reject").alias("rejected"),
        flags.flag_any(F.col("page").like("loan_docs%")).alias("reached_docs"))


@query("A04_distinct_counts", "visits", """SELECT session_id, count(DISTINCT lms_customer_id) AS users,
  count(DISTINCT CASE WHEN page = 'reject' THEN lms_customer_id END) AS rejected_users FROM visits GROUP BY 1""")
def _(v):
    return v.visits.groupBy("session_id").agg(
        F.count_distinct("lms_customer_id").alias("users"),
        flags.count_distinct_if(F.col("page") == "reject", F.col("lms_customer_id"))
        .alias("rejected_users"))


@query("A04_bitmap_counts", "visits", """SELECT session_id, count(DISTINCT lms_customer_id) AS users,
  count(DISTINCT CASE WHEN page = 'reject' THEN lms_customer_id END) AS rejected_users FROM visits GROUP BY 1""")
def _(v):
    ids = aggregates.dense_ids(v.visits, "lms_customer_id")
    states = aggregates.distinct_bitmaps(v.visits.join(ids, "lms_customer_id"), "dense_id", ["session_id"], {
        "users": F.lit(True), "rejected_users": F.col("page") == "reject"})
    return aggregates.bitmap_counts(states, ["session_id"], ["users", "rejected_users"])


@query("A05_pick_one", "dm_log", """SELECT promo_code, email, log_id, validation_date FROM (SELECT *, row_number() OVER (PARTITION BY promo_code
  ORDER BY create_datetime, log_id) AS rn FROM dm_log) z WHERE rn = 1""")
def _(v):
    return ranking.pick_one(v.dm_log, ["promo_code"], [F.col("create_datetime"), F.col("log_id")]
                            ).select("promo_code", "email", "log_id", "validation_date")


@query("A06_having", "items", "SELECT payment_schedule_id, max(item_date) AS last_date FROM items GROUP BY 1 HAVING max(item_date) BETWEEN DATE '1998-01-01' AND DATE '1999-12-31'")
def _(v):
    return v.items.groupBy("payment_schedule_id").agg(F.max("item_date").alias("last_date")).filter(
        F.col("last_date").between(F.lit("1998-01-01").cast("date"), F.lit("1999-12-31").cast("date")))


@query("A07_rates", "stats", """SELECT category, round(avg(r), 6) AS avg_of_rates, round(CAST(sum(d) AS DOUBLE) / CAST(sum(q) AS DOUBLE), 6) AS rate_of_sums FROM (
  SELECT category, report_date, sum(delivered) AS d, sum(requests) AS q, CAST(sum(delivered) AS DOUBLE) / nullif(CAST(sum(requests) AS DOUBLE), 0) AS r
  FROM stats GROUP BY 1, 2) z GROUP BY 1""")
def _(v):
    fine = v.stats.groupBy("category", "report_date").agg(F.sum("delivered").alias("d"),
                                                          F.sum("requests").alias("q"))
    fine = aggregates.rates(fine, {"r": ("d", "q")})
    return fine.groupBy("category").agg(F.round(F.avg("r"), 6).alias("avg_of_rates"),
                                        F.round(rate(F.sum("d"), F.sum("q")), 6).alias("rate_of_sums"))


@query("A08_rollup_labels", "stats labels_map", """SELECT report_date, label, CAST(sum(n) AS BIGINT) AS n, CAST(sum(sent) AS BIGINT) AS sent FROM (SELECT report_date, category, count(*) AS n,
  sum(requests) AS sent FROM stats GROUP BY 1, 2) z LEFT JOIN labels_map ON name = category GROUP BY 1, 2""")
def _(v):
    return aggregates.rollup_labels(v.stats, ["report_date"], "category", v.labels_map,
                                    [F.count("*").alias("n"), F.sum("requests").alias("sent")],
                                    [F.sum("n").alias("n"), F.sum("sent").alias("sent")])


@query("A09_duplicate_keys", "items", "SELECT payment_schedule_id, item_date, count(*) AS cnt FROM items GROUP BY 1, 2 HAVING count(*) > 1")
def _(v):
    return aggregates.duplicate_keys(v.items, ["payment_schedule_id", "item_date"])


@query("A10_by_period", "leads0", """SELECT CAST(year(received_time) AS INTEGER) AS received_year, CAST(month(received_time) AS INTEGER) AS received_month,
  count(*) AS n, CAST(sum(approved_amount) AS DOUBLE) AS amount FROM leads0 GROUP BY 1, 2
  UNION ALL SELECT NULL, CAST(month(received_time) AS INTEGER), count(*), CAST(sum(approved_amount) AS DOUBLE) FROM leads0 GROUP BY 1, 2""")
def _(v):
    aggs = [F.count("*").alias("n"), F.sum("approved_amount").cast("double").alias("amount")]
    a = aggregates.by_period(v.leads0, "received_time", aggs)
    b = aggregates.by_period(v.leads0, "received_time", aggs, "month")
    return a.unionByName(b, allowMissingColumns=True)


@query("A11_balance", "transactions", "SELECT base_loan_id, CAST(sum(-principal_amount) AS DOUBLE) AS owed FROM transactions GROUP BY 1")
def _(v):
    return aggregates.balance(v.transactions, "base_loan_id", {"owed": "principal_amount"})


@query("A12_weighted_cost", "leads0", """SELECT campaign_name, round(CAST(sum(lead_cost) AS DOUBLE) / nullif(CAST(sum(isoriginated) AS DOUBLE), 0), 6) AS cost_per_loan
  FROM leads0 GROUP BY 1""")
def _(v):
    return v.leads0.groupBy("campaign_name").agg(
        F.round(rate(F.sum("lead_cost"), F.sum("isoriginated")), 6).alias("cost_per_loan"))


@query("W01_latest_keep_ties", "leads0", """SELECT lms_code, person_id, lms_application_id, CAST(received_time AS DATE) AS day FROM (SELECT *, rank() OVER (
  PARTITION BY lms_code, person_id ORDER BY CAST(received_time AS DATE) DESC) AS rk FROM leads0) z WHERE rk = 1""")
def _(v):
    df = v.leads0.withColumn("day", F.to_date("received_time"))
    return ranking.latest_per(df, ["lms_code", "person_id"], "day").select(
        "lms_code", "person_id", ID, "day")


@query("W02_latest_value", "sms_log", """SELECT customer_id, notification_name_id, message FROM (SELECT *, row_number() OVER (PARTITION BY customer_id, notification_name_id
  ORDER BY event_date DESC, event_id DESC) AS rn FROM sms_log) z WHERE rn = 1""")
def _(v):
    return ranking.latest_value(v.sms_log, ["customer_id", "notification_name_id"], "event_date",
                                "event_id", "message", "message")


@query("W03_current_version", "limits", """SELECT entity_id, pay_frequency, effective_date, CAST(max(maximum_limit) AS DOUBLE) AS top FROM limits l WHERE effective_date =
  (SELECT max(effective_date) FROM limits m WHERE m.entity_id = l.entity_id AND m.pay_frequency = l.pay_frequency) GROUP BY 1, 2, 3""")
def _(v):
    return ranking.current_version(v.limits, ["entity_id", "pay_frequency"], "effective_date").groupBy(
        "entity_id", "pay_frequency", "effective_date").agg(F.max("maximum_limit").alias("top"))


FIRST_PAY = """pay AS (SELECT payment_schedule_id AS base_loan_id, item_date AS debit_date, CASE WHEN status IN ('return', 'missed') THEN 1 ELSE 0 END AS is_defaulted,
  total_amount AS debit_amount, CASE WHEN status IN ('return', 'missed') THEN total_amount ELSE 0 END AS uncollected_amount,
  CASE WHEN status IN ('return', 'missed') THEN amount_prin ELSE 0 END AS defaulted_principal,
  CASE WHEN status IN ('cleared', 'correction') THEN amount_prin ELSE 0 END AS principal_paid,
  CASE WHEN status IN ('cleared', 'correction') THEN total_amount - amount_prin ELSE 0 END AS fees_paid
  FROM (SELECT i.*, row_number() OVER (PARTITION BY i.payment_schedule_id ORDER BY payment_schedule_item_id, item_date, total_amount, amount_prin, status) AS rn
    FROM items i JOIN schedules s ON s.payment_schedule_id = i.payment_schedule_id AND is_collections = 0
    WHERE status IN ('cleared', 'missed', 'return', 'correction') AND total_amount > 0) z WHERE rn = 1)"""


@query("W04_first_payment", "items schedules", f"WITH {FIRST_PAY} SELECT base_loan_id, debit_date, is_defaulted, {dbl('debit_amount uncollected_amount defaulted_principal principal_paid fees_paid')} FROM pay")
def _(v):
    from lendreach.plans.facts import loan_first_payment
    return loan_first_payment(v.schedules, v.items)


PAGES = {"loan_docs-CI": "CI", "loan_docs_submit-CI": "CI", "loan_docs-TC": "TC", "loan_docs_submit-TC": "TC"}
DWELL = """dwell AS (SELECT lms_customer_id, session_id, page_group, min(event_ts) AS start_time, max(event_ts) AS end_time,
  date_sub('second', min(event_ts), max(event_ts)) AS seconds_spent FROM (SELECT *, CASE WHEN page IN ('loan_docs-CI', 'loan_docs_submit-CI') THEN 'CI'
  WHEN page IN ('loan_docs-TC', 'loan_docs_submit-TC') THEN 'TC' END AS page_group FROM visits) z WHERE page_group IS NOT NULL GROUP BY 1, 2, 3)"""


@query("W05_page_dwell", "visits", f"WITH {DWELL} SELECT * FROM dwell")
def _(v):
    return ranking.page_dwell(v.visits, ["lms_customer_id", "session_id"], "page", "event_ts", PAGES)


@query("W06_first_visit", "visits", f"""WITH {DWELL} SELECT * EXCLUDE (rk) FROM (SELECT *, rank() OVER (PARTITION BY lms_customer_id, page_group ORDER BY start_time) AS rk FROM dwell) z WHERE rk = 1""")
def _(v):
    d = ranking.page_dwell(v.visits, ["lms_customer_id", "session_id"], "page", "event_ts", PAGES)
    return ranking.first_visit(d, ["lms_customer_id", "page_group"])


@query("W07_draw_sequence", "items leads0", """SELECT lms_customer_id, max(item_date) AS last_draw_date, count(item_date) AS draw_sequence FROM items JOIN leads0
  ON payment_schedule_id = origination_loan_id WHERE total_amount < 0 AND status IN ('cleared', 'sent') AND item_date <= DATE '2000-06-30' GROUP BY 1""")
def _(v):
    df = v.items.join(v.leads0.select("lms_customer_id", "origination_loan_id"),
                      F.col("payment_schedule_id") == F.col("origination_loan_id"))
    return ranking.draw_sequence(df, ["lms_customer_id"], F.lit("2000-06-30").cast("date"))


@query("W08_cycle_number", "items", """SELECT DISTINCT i.payment_schedule_id, i.item_date, (SELECT count(DISTINCT p.item_date) + 1 FROM items p
  WHERE p.payment_schedule_id = i.payment_schedule_id AND p.total_amount > 0 AND p.status IN ('cleared', 'sent', 'return', 'missed') AND p.item_date < i.item_date) AS cycle_number
  FROM items i WHERE i.total_amount > 0""")
def _(v):
    return ranking.cycle_number(v.items.filter("total_amount > 0"), "payment_schedule_id",
                                "item_date", F.col("status").isin("cleared", "sent", "return",
                                                                  "missed"))


@query("W09_resolve_codes", "dm_log", """SELECT email, promo_code, log_id FROM (SELECT *, row_number() OVER (PARTITION BY email ORDER BY validation_date DESC, log_id) AS r2
  FROM (SELECT *, row_number() OVER (PARTITION BY promo_code ORDER BY create_datetime, log_id) AS r1 FROM dm_log) a WHERE r1 = 1) b WHERE r2 = 1""")
def _(v):
    return ranking.resolve_codes(v.dm_log, "promo_code", "email", "create_datetime",
                                 "validation_date", "log_id").select("email", "promo_code", "log_id")


@query("W10_next_weekday", "leads0 cal", """SELECT d AS run_date, n AS next_date, c.holiday AS next_is_holiday FROM (SELECT d, (SELECT min(ori_date) FROM cal WHERE ori_date > d AND weekend = 0) AS n
  FROM (SELECT DISTINCT CAST(received_time AS DATE) AS d FROM leads0) a) b JOIN cal c ON c.ori_date = n""")
def _(v):
    return next_weekday(v.cal, v.leads0.select(F.to_date("received_time").alias("run_date")).distinct())


@query("T01_order_by", "leads0", "SELECT lms_application_id, received_time, state FROM leads0 ORDER BY received_time DESC, lms_application_id")
def _(v):
    return v.leads0.select(ID, "received_time", "state").orderBy(F.col("received_time").desc(), ID)


@query("T02_top_n", "leads0", "SELECT lms_application_id, received_time, state FROM leads0 ORDER BY received_time DESC, lms_application_id LIMIT 1000")
def _(v):
    return ranking.top_n(v.leads0.select(ID, "received_time", "state"),
                         [F.col("received_time").desc(), F.col(ID)], 1000)


@query("U01_union_distinct", "leads0 history", """SELECT emailaddress AS email, state FROM leads0 UNION SELECT email, state FROM history WHERE list_module = 'WAD'
  UNION SELECT 'seed@example.com', state FROM leads0""")
def _(v):
    a = v.leads0.select(F.col("emailaddress").alias("email"), "state")
    b = v.history.filter("list_module = 'WAD'").select("email", "state")
    c = v.leads0.select(F.lit("seed@example.com").alias("email"), "state")
    return aggregates.union_distinct(a, b, c)
