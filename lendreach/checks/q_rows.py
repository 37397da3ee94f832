"""Predicates and column functions over whole tables."""

from pyspark.sql import functions as F

from lendreach.checks.common import DOM, EXT, MAX_LIMIT, RULES, nc
from lendreach.checks.registry import query
from lendreach.functions import dates, flags, money, text
from lendreach.operators.calendar import rota, weekday_rota
from lendreach.operators.limits import entity_state_mismatch, rate_card_join

ID = "lms_application_id"


@query("F01_external_email", "leads0", f"SELECT {ID}, emailaddress FROM leads0 WHERE {EXT}")
def _(v):
    return v.leads0.filter(text.external_email(F.col("emailaddress"), RULES.domains,
                                               RULES.prefixes)).select(ID, "emailaddress")


@query("F02_optin_filter", "leads0", f"""SELECT {ID}, CASE WHEN email_marketingoptin IN (0, 1) THEN 1 ELSE 0 END AS both_ok,
  CASE WHEN email_marketingoptin = 1 THEN 1 ELSE 0 END AS only_ok FROM leads0""")
def _(v):
    c = F.col("email_marketingoptin")
    return v.leads0.select(ID, flags.one(flags.optin_filter(c, False)).alias("both_ok"),
                           flags.one(flags.optin_filter(c, True)).alias("only_ok"))


@query("F03_eligibility", "leads0", f"""SELECT {ID} FROM leads0 WHERE application_status IN ('withdrawn', 'pending')
  AND state NOT IN ('NATION_9') AND CAST(received_time AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'
  AND isapplicationtest = 0""")
def _(v):
    df = v.leads0.withColumn("received", F.to_date("received_time"))
    return df.filter(flags.eligibility({
        "application_status": ["withdrawn", "pending"], "state": ("not", ["NATION_9"]),
        "received": ("between", F.lit("1996-01-01").cast("date"), F.lit("1999-12-31").cast("date")),
        "isapplicationtest": 0})).select(ID)


@query("F04_carve_out", "leads0", f"""SELECT {ID}, state, product FROM leads0 WHERE NOT (
  coalesce(state IN ('NATION_1', 'NATION_2') AND product IN ('BUILDING'), false)
  OR coalesce(state IN ('NATION_3') AND product IN ('MACHINERY', 'FURNITURE'), false))""")
def _(v):
    keep = flags.carve_out(F.col("state"), F.col("product"), [
        (("NATION_1", "NATION_2"), ("BUILDING",)), (("NATION_3",), ("MACHINERY", "FURNITURE"))])
    return v.leads0.filter(keep).select(ID, "state", "product")


@query("F05_not_test", "leads0", f"SELECT {ID} FROM leads0 WHERE isapplicationtest = 0")
def _(v):
    return v.leads0.filter(flags.not_test(F.col("isapplicationtest"))).select(ID)


@query("F06_hour_windows", "leads0", f"""SELECT {ID}, received_time, CASE WHEN hour(received_time) < 15 THEN 1 ELSE 0 END AS before_15,
  CASE WHEN hour(received_time) BETWEEN 0 AND 10 THEN 1 ELSE 0 END AS early,
  CASE WHEN hour(received_time) BETWEEN 20 AND 23 THEN 1 ELSE 0 END AS night FROM leads0""")
def _(v):
    t = F.col("received_time")
    return v.leads0.select(ID, t, flags.one(dates.hour_between(t, 0, 14)).alias("before_15"),
                           flags.one(dates.hour_between(t, 0, 10)).alias("early"),
                           flags.one(dates.hour_between(t, 20, 23)).alias("night"))


@query("F07_patterns", "leads0", f"""SELECT {ID}, CASE WHEN campaign_name ILIKE '%dm%' OR campaign_name ILIKE 'mob%' THEN 1 ELSE 0 END AS tagged,
  CASE WHEN {' OR '.join(f"emailaddress ILIKE '%{e}'" for e in text.MAIL_ENDINGS)} THEN 1 ELSE 0 END AS valid_mail FROM leads0""")
def _(v):
    return v.leads0.select(
        ID, flags.one(text.like_any(F.col("campaign_name"), ["%dm%", "mob%"])).alias("tagged"),
        flags.one(text.valid_mail_ending(F.col("emailaddress"))).alias("valid_mail"))


ROTA = [(d, g, f"NATION_{n}") for g, shift in (("Group1", 0), ("Group2", 2)) for n in range(25)
        for d in [(n + shift) % 5] if d < 4]
ROTA_SQL = "(VALUES " + ", ".join(f"({d}, '{g}', '{s}')" for d, g, s in ROTA) + ") AS r(w, g, s)"


@query("F08_weekday_rota", "leads0", f"""SELECT {ID}, state, CAST(received_time AS DATE) AS run_date FROM leads0
  WHERE (isodow(received_time) - 1, CASE WHEN isexpress = 1 THEN 'Group2' ELSE 'Group1' END, state)
  IN (SELECT w, g, s FROM {ROTA_SQL})""")
def _(v):
    df = v.leads0.select(ID, "state", F.to_date("received_time").alias("run_date"),
                         F.when(F.col("isexpress") == 1, "Group2").otherwise("Group1").alias("g"))
    return weekday_rota(df, rota(ROTA, v.spark), "run_date", "g", "state").drop("g")


@query("F09_delinquency_due", "accounts", """SELECT acct_id, days_delinquent, date_of_total_due FROM accounts
  WHERE CASE WHEN isodow(date_of_total_due) = 1 THEN days_delinquent IN (11, 12, 13) ELSE days_delinquent = 11 END""")
def _(v):
    return v.accounts.filter(dates.delinquency_due(F.col("days_delinquent"), F.col(
        "date_of_total_due"))).select("acct_id", "days_delinquent", "date_of_total_due")


@query("F10_distinct_rows", "history", "SELECT DISTINCT list_module, state, product, business_date FROM history")
def _(v):
    return v.history.select("list_module", "state", "product", "business_date").distinct()


NAMES = [("NATION_1", "N1"), ("NATION_2", "N2")]


@query("F11_state_mismatch", "leads0 entity_params", f"""SELECT {ID}, entity_name, state, CASE WHEN contains(entity_name, 'NATION_1') THEN 'N1'
  WHEN contains(entity_name, 'NATION_2') THEN 'N2' ELSE left(entity_name, 2) END AS entity_state
  FROM (SELECT {ID}, value AS entity_name, lpad(CAST(l.lms_entity_id AS VARCHAR), 2, '0') AS state FROM leads0 l
  JOIN entity_params e ON e.lms_entity_id = l.lms_entity_id) z
  WHERE NOT contains(entity_name, 'Trust') AND CASE WHEN contains(entity_name, 'NATION_1') THEN 'N1'
  WHEN contains(entity_name, 'NATION_2') THEN 'N2' ELSE left(entity_name, 2) END IS DISTINCT FROM state""")
def _(v):
    names = v.entity_params.select("lms_entity_id", F.col("value").alias("entity_name"))
    df = v.leads0.select(ID, "lms_entity_id").join(names, "lms_entity_id").select(
        ID, "entity_name", F.lpad(F.col("lms_entity_id").cast("string"), 2, "0").alias("state"))
    return entity_state_mismatch(df, NAMES, ["Trust"]).select(ID, "entity_name", "state",
                                                              "entity_state")


@query("F12_call_centre_open", "visits", """SELECT id, event_ts, CASE WHEN isodow(event_ts) <= 5 AND hour(event_ts) BETWEEN 8 AND 22 THEN 1
  WHEN isodow(event_ts) > 5 AND hour(event_ts) BETWEEN 11 AND 18 THEN 1 ELSE 0 END AS is_open FROM visits""")
def _(v):
    return v.visits.select("id", "event_ts",
                           dates.call_centre_open(F.col("event_ts")).alias("is_open"))


@query("X01_name_case", "leads0", f"SELECT {ID}, {nc('customer_firstname')} AS first_name, {nc('customer_lastname')} AS last_name FROM leads0")
def _(v):
    return v.leads0.select(ID, text.name_case(F.col("customer_firstname")).alias("first_name"),
                           text.name_case(F.col("customer_lastname")).alias("last_name"))


@query("X02_full_name", "leads0", f"SELECT {ID}, {nc('customer_firstname')} || ' ' || {nc('campaign_name')} AS full_name FROM leads0")
def _(v):
    return v.leads0.select(ID, text.full_name(F.col("customer_firstname"), F.col("campaign_name"))
                           .alias("full_name"))


@query("X03_usd", "items", """SELECT payment_schedule_id, payment_schedule_item_id, '$' || CAST(total_amount AS VARCHAR) AS total_text FROM items""")
def _(v):
    return v.items.select("payment_schedule_id", "payment_schedule_item_id",
                          text.usd(F.col("total_amount")).alias("total_text"))


@query("X04_job_id", "leads0", f"""SELECT {ID}, CASE WHEN state IN ('NATION_4', 'NATION_6') THEN 'ALOC' || strftime(received_time, '%m%d%Y') || 'DDR'
  WHEN received_time < TIMESTAMP '1996-05-24 00:00:00' THEN 'BLOC' || strftime(received_time, '%m%d%Y') || 'DDR'
  ELSE 'INS' || strftime(received_time, '%m%d%Y') || 'DDR' END AS job_id FROM leads0""")
def _(v):
    old = F.to_date("received_time") < F.lit("1996-05-24").cast("date")
    return v.leads0.select(ID, text.job_id(F.col("received_time"), [
        (F.col("state").isin("NATION_4", "NATION_6"), "ALOC", "DDR"), (old, "BLOC", "DDR")],
        ("INS", "DDR")).alias("job_id"))


@query("X05_email_domain", "leads0", f"SELECT {DOM} AS domain, count(*) AS n FROM leads0 GROUP BY 1")
def _(v):
    return v.leads0.groupBy(text.email_domain(F.col("emailaddress")).alias("domain")).agg(
        F.count("*").alias("n"))


@query("X06_norm_campaign", "mail_map leads0", f"""SELECT {ID}, upper(substr(trim(c), 1, 1)) || lower(substr(trim(c), 2)) AS campaign
  FROM (SELECT {ID}, '  ' || campaign_name || ' ' AS c FROM leads0) z""")
def _(v):
    c = F.concat(F.lit("  "), F.col("campaign_name"), F.lit(" "))
    return v.leads0.select(ID, text.norm_campaign(c).alias("campaign"))


@query("X07_pad_id", "leads0", f"SELECT {ID}, lpad(CAST(lms_customer_id AS VARCHAR), 7, '0') AS padded, lpad(CAST(lms_customer_id AS VARCHAR), 3, '0') AS cut FROM leads0")
def _(v):
    c = F.col("lms_customer_id")
    return v.leads0.select(ID, text.pad_id(c).alias("padded"), text.pad_id(c, 3).alias("cut"))


@query("X08_list_key", "leads0", f"SELECT {ID}, concat_ws('_', state, campaign_name, product) AS list_key FROM leads0")
def _(v):
    return v.leads0.select(ID, text.list_key(F.col("state"), F.col("campaign_name"),
                                             F.col("product")).alias("list_key"))


@query("X09_clean_money_phone", "application calls", r"""SELECT lead_sequence_id, CAST(TRY_CAST(regexp_replace(nmi, '[$,]', '', 'g') AS DECIMAL(18,2)) AS DOUBLE) AS income,
  CAST(NULL AS VARCHAR) AS phone FROM application UNION ALL
  SELECT id, NULL, regexp_replace(called_ani, '[^0-9]', '', 'g') FROM calls""")
def _(v):
    a = v.application.select("lead_sequence_id", text.clean_money(F.col("nmi")).cast("double")
                             .alias("income"), F.lit(None).cast("string").alias("phone"))
    b = v.calls.select(F.col("id").alias("lead_sequence_id"), F.lit(None).cast("double")
                       .alias("income"), text.clean_phone(F.col("called_ani")).alias("phone"))
    return a.unionAll(b)


@query("X10_prefix_sub_id", "leads0", f"""SELECT {ID}, left(affid, 3) AS zip3, left(affid, 4) AS zip4,
  CASE WHEN provider_name IN ('Provider 1', 'Provider 2') THEN left(affid, 4) ELSE subid END AS sub_id FROM leads0""")
def _(v):
    return v.leads0.select(ID, F.left("affid", F.lit(3)).alias("zip3"),
                           F.left("affid", F.lit(4)).alias("zip4"),
                           text.sub_id(F.col("provider_name"), F.col("affid"), F.col("subid"),
                                       ["Provider 1", "Provider 2"]).alias("sub_id"))


@query("X11_valid_state", "leads0", f"SELECT {ID}, CASE WHEN state IS NULL OR length(state) > 8 THEN 'X-NotAvail' ELSE state END AS state FROM leads0")
def _(v):
    return v.leads0.select(ID, text.valid_state(F.col("state"), width=8).alias("state"))


@query("X12_changed_flag", "leads0", f"""SELECT {ID}, CASE WHEN split_part('a:' || coalesce(campaign_name, ''), ':', -1) = coalesce(split_part(campaign_name, ':', -1), '') THEN 0 ELSE 1 END AS same_text,
  CASE WHEN sha256('s' || pay_frequency) = sha256('sW') THEN 0 ELSE 1 END AS changed,
  CASE WHEN coalesce(campaign_name, '') = coalesce(CASE WHEN isexpress = 1 THEN 'WEB' ELSE campaign_name END, '') THEN 0 ELSE 1 END AS null_safe FROM leads0""")
def _(v):
    c = F.col("campaign_name")
    return v.leads0.select(
        ID, text.changed_flag(F.concat(F.lit("a:"), F.coalesce(c, F.lit(""))), c).alias("same_text"),
        text.changed_flag(text.secret_hash(F.col("pay_frequency"), "s"),
                          text.secret_hash(F.lit("W"), "s")).alias("changed"),
        text.changed_flag(c, F.when(F.col("isexpress") == 1, "WEB").otherwise(c)).alias("null_safe"))


@query("X13_bank_verification", "leads", f"""SELECT {ID}, CASE WHEN isreturning >= 1 THEN 'RC' WHEN coalesce(email_marketingoptin, 0) = 0 THEN 'BV'
  WHEN isexpress = 1 OR isuniqueaccept = 1 THEN 'BV' WHEN isexpress = 0 AND isuniqueaccept = 0 THEN 'NBV' END AS label FROM leads""")
def _(v):
    return v.leads.select(ID, text.bank_verification(
        F.col("isreturning"), F.col("email_marketingoptin"), F.col("isexpress"),
        F.col("isuniqueaccept")).alias("label"))


@query("D02_shift", "leads0", f"""SELECT {ID}, CAST(received_time AS DATE) - 3 AS d3,
  CAST(CAST(received_time AS DATE) + INTERVAL 2 MONTH AS DATE) AS m2, received_time - INTERVAL 45 MINUTE AS min45 FROM leads0""")
def _(v):
    day = F.to_date("received_time")
    return v.leads0.select(ID, dates.shift(day, -3, "day").alias("d3"),
                           dates.shift(day, 2, "month").alias("m2"),
                           dates.shift(F.col("received_time"), -45, "minute").alias("min45"))


@query("D03_datediff", "leads0", f"SELECT {ID}, CAST(date_diff('day', CAST(received_time AS DATE), CAST(coalesce(origination_time, withdrawn_time) AS DATE)) AS INTEGER) AS days FROM leads0")
def _(v):
    return v.leads0.select(ID, dates.elapsed(F.col("received_time"), F.coalesce(
        "origination_time", "withdrawn_time"), "day").alias("days"))


@query("D04_elapsed_buckets", "leads0", f"""SELECT {ID}, date_sub('minute', received_time, origination_time) AS minutes, {', '.join(
    f"CASE WHEN date_diff('day', CAST(received_time AS DATE), CAST(origination_time AS DATE)) = {n} THEN 1 ELSE 0 END AS day{n}_orig" for n in range(4))},
  CASE WHEN date_diff('day', CAST(received_time AS DATE), CAST(origination_time AS DATE)) > 3 THEN 1 ELSE 0 END AS day3plus_orig FROM leads0""")
def _(v):
    a, b = F.col("received_time"), F.col("origination_time")
    return v.leads0.select(ID, dates.elapsed(a, b, "minute").alias("minutes"),
                           *dates.day_bucket_flags(a, b, "orig"))


@query("D05_date_parts", "visits", """SELECT id, CAST(year(event_ts) AS INTEGER) AS year, CAST(month(event_ts) AS INTEGER) AS month, CAST(day(event_ts) AS INTEGER) AS day,
  CAST(hour(event_ts) AS INTEGER) AS hour, CAST(isodow(event_ts) - 1 AS INTEGER) AS weekday, dayname(event_ts) AS day_name, monthname(event_ts) AS month_name,
  strftime(event_ts, '%Y %B') AS year_month FROM visits""")
def _(v):
    return v.visits.select("id", *dates.date_parts(F.col("event_ts")))


@query("D06_week_of_month", "leads0", f"SELECT {ID}, CAST(floor((day(received_time) - 1) / 7) + 1 AS INTEGER) AS week FROM leads0")
def _(v):
    return v.leads0.select(ID, dates.week_of_month(F.col("received_time")).alias("week"))


@query("D07_long_date", "leads0", f"SELECT {ID}, strftime(received_time, '%A , %B %-d , %Y') AS notice, strftime(received_time, '%B %-d, %Y') AS mail FROM leads0")
def _(v):
    return v.leads0.select(ID, dates.long_date(F.col("received_time"), "notice").alias("notice"),
                           dates.long_date(F.col("received_time")).alias("mail"))


@query("D08_dwell_seconds", "leads0", f"SELECT {ID}, date_sub('second', received_time, withdrawn_time) AS seconds, round(date_sub('second', received_time, withdrawn_time) / 60.0, 4) AS minutes FROM leads0")
def _(v):
    s = dates.dwell_seconds(F.col("received_time"), F.col("withdrawn_time"))
    return v.leads0.select(ID, s.alias("seconds"), F.round(s / F.lit(60.0), 4).alias("minutes"))


@query("M01_cap_and_step", "leads0", f"""SELECT {ID}, CAST(ceil(approved_amount / 25) * 25 AS DOUBLE) AS stepped,
  CAST(CASE WHEN requested_amount IS NULL THEN NULL ELSE least(requested_amount, 500) END AS DOUBLE) AS capped,
  CAST(floor(paycheck) AS DOUBLE) AS floored, CAST(abs(paycheck) AS DOUBLE) AS size FROM leads0""")
def _(v):
    return v.leads0.select(
        ID, money.step_up(F.col("approved_amount")).cast("double").alias("stepped"),
        money.capped(F.col("requested_amount"), F.lit(500).cast("decimal(18,2)")).alias("capped"),
        F.floor("paycheck").cast("double").alias("floored"), F.abs("paycheck").alias("size"))


@query("C01_defaults", "leads rates", f"""SELECT {ID}, CAST(coalesce(requested_amount, approved_amount) AS DOUBLE) AS requested,
  {MAX_LIMIT} AS max_limit FROM leads LEFT JOIN rates r ON state = state_code AND product = product_code
  AND leads.loan_sequence = r.loan_sequence AND leads.pay_frequency = r.pay_frequency""")
def _(v):
    df = rate_card_join(v.leads, v.rates, F.col("pay_frequency"), cap=None)
    return df.select(ID, F.coalesce("requested_amount", "approved_amount").alias("requested"),
                     money.max_limit(F.col("paycheck"), F.col("rpp"), F.col("hardcap"))
                     .alias("max_limit"))
