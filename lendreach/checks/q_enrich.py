"""Enrichment operators over whole tables."""

from pyspark.sql import functions as F

from lendreach.checks.common import (CONSENT, CONSENT_VIEWS, NEXT_LIMIT, RULES, USABLE, VARIANT, optin)
from lendreach.checks.q_lists import CAPS, BANDS, caps
from lendreach.checks.registry import query
from lendreach.checks.views import FLAT, PLACEHOLDERS
from lendreach.functions import flags, money
from lendreach.operators.aggregates import regroup
from lendreach.operators.consent import add_phone, email_consent, fill_phones
from lendreach.operators.limits import rate_card_join

ID = "lms_application_id"


@query("E01_sms_consent", CONSENT_VIEWS, f"WITH {CONSENT} SELECT * FROM optin")
def _(v):
    return optin(v)


@query("E02_email_consent", "customer_flat flags", """SELECT 'text' AS convention, customer_id, CASE WHEN optout_account_email IS NULL OR lower(optout_account_email) = 'false' THEN 1 ELSE 0 END AS is_email_transactional_optin,
  CASE WHEN optout_marketing_email IS NULL OR lower(optout_marketing_email) = 'false' THEN 1 ELSE 0 END AS is_email_marketing_optin FROM customer_flat
  UNION ALL SELECT 'number', customer_id, CASE WHEN email_operational_optin = 1 THEN 1 ELSE 0 END, CASE WHEN email_marketing_optin = 1 THEN 1 ELSE 0 END FROM customer_flat
  UNION ALL SELECT 'flags', cust_id, 1 - max(CASE WHEN flag_id = 2 AND flag_value = 1 THEN 1 ELSE 0 END), 1 - max(CASE WHEN flag_id IN (2, 6) AND flag_value = 1 THEN 1 ELSE 0 END) FROM flags GROUP BY cust_id""")
def _(v):
    out = None
    for kind, df, key in (("text", v.customer_flat, "customer_id"), ("number", v.customer_flat, "customer_id"),
                          ("flags", v.flags, "cust_id")):
        part = email_consent(df, kind, key).withColumnRenamed(key, "customer_id").withColumn(
            "convention", F.lit(kind))
        out = part if out is None else out.unionByName(part)
    return out


@query("E03_usable_phone", "leads0 customer_flat", f"SELECT {ID}, {USABLE} AS cell_phone FROM leads0 LEFT JOIN customer_flat ON customer_id = lms_customer_id")
def _(v):
    return add_phone(v.leads0.select(ID, "lms_customer_id"), v.customer_flat, "lms_customer_id",
                     PLACEHOLDERS).select(ID, "cell_phone")


@query("E04_fill_phones", "history customer_flat", """SELECT lms_application_id, CASE WHEN lms_code = 'INST' AND business_date >= DATE '1998-03-02' AND customer_id IS NOT NULL THEN homephone ELSE 'h' END AS home_phone,
  CASE WHEN lms_code = 'INST' AND business_date >= DATE '1998-03-02' AND customer_id IS NOT NULL THEN cellphone ELSE 'c' END AS cell_phone FROM history LEFT JOIN customer_flat ON customer_id = lms_customer_id""")
def _(v):
    h = v.history.select(ID, "lms_customer_id", "lms_code", "business_date", F.lit("h").alias("home_phone"),
                         F.lit("c").alias("cell_phone"))
    return fill_phones(h, v.customer_flat, "INST", F.lit("1998-03-02").cast("date")).select(
        ID, "home_phone", "cell_phone")


@query("E05_next_limit", "leads rates customer_flat", f"""SELECT {ID}, {NEXT_LIMIT} AS next_loan_limit FROM (SELECT leads.*, payfrequency, nmi, rpp, hardcap, {VARIANT} AS rate_product FROM leads
  LEFT JOIN customer_flat ON customer_id = lms_customer_id LEFT JOIN (SELECT state_code, product_code, loan_sequence AS rseq, pay_frequency AS rfreq, rpp, hardcap FROM rates) r
  ON state = state_code AND {VARIANT} = product_code AND least(loan_sequence + 1, 7) = rseq AND payfrequency = rfreq) z""")
def _(v):
    pay = v.customer_flat.select(F.col("customer_id").alias("lms_customer_id"), "payfrequency", "nmi")
    df = rate_card_join(v.leads.join(pay, "lms_customer_id", "left"), v.rates, F.col("payfrequency"), 1,
                        RULES.remap)
    return df.select(ID, money.next_limit(F.col("rate_product"), F.col("nmi"), F.col("payfrequency"),
                                          F.col("rpp"), F.col("hardcap"), FLAT).alias("next_loan_limit"))


DAYS = "date_diff('day', last_paymentdate, DATE '1998-03-02')"


@query("E06_recency_wait", "leads0", f"""SELECT {ID}, CASE WHEN {DAYS} <= 45 THEN 'GC Active' WHEN {DAYS} <= 180 THEN 'GC Engaged' WHEN {DAYS} > 180 THEN 'GC Dormant' END AS gc_group,
  CASE WHEN state = 'NATION_3' AND product = 'BUILDING' THEN 'NATION_3_BUILDING' WHEN state = 'NATION_8' AND product = 'MACHINERY' THEN 'NATION_8_MACHINERY' ELSE 'OTHERS' END AS wait_group FROM leads0""")
def _(v):
    d = F.datediff(F.lit("1998-03-02").cast("date"), F.col("last_paymentdate"))
    return v.leads0.select(ID, money.recency_group(d).alias("gc_group"), flags.wait_group(
        F.col("state"), F.col("product"), [("NATION_3", "BUILDING"), ("NATION_8", "MACHINERY")])
        .alias("wait_group"))


@query("E07_credit_band", "accounts", f"""SELECT acct_id, CAST(credit_limit - current_balance AS DOUBLE) / CAST(credit_limit AS DOUBLE) AS rate, {BANDS('(credit_limit - current_balance * 3)', 'credit_limit', 60)} AS high_band,
  {BANDS('(credit_limit - current_balance * 3)', 'credit_limit', 10)} AS low_band FROM accounts""")
def _(v):
    a, b = F.col("credit_limit") - F.col("current_balance"), F.col("credit_limit") - F.col("current_balance") * 3
    return v.accounts.select("acct_id", money.rate(a, F.col("credit_limit")).alias("rate"),
                             money.credit_band(b, F.col("credit_limit"), 60).alias("high_band"),
                             money.credit_band(b, F.col("credit_limit"), 10).alias("low_band"))


@query("E08_bid_band", "leads0", f"SELECT {ID}, CASE WHEN lead_cost <= 10 THEN '$3-$10' WHEN lead_cost <= 20 THEN '$11-$20' WHEN lead_cost <= 30 THEN '$21-$30' WHEN lead_cost <= 40 THEN '$31-$40' WHEN lead_cost > 40 THEN '$41+' END AS band FROM leads0")
def _(v):
    return v.leads0.select(ID, money.bid_band(F.col("lead_cost")).alias("band"))


PROVIDERS = [("Provider 1", "GROUP A"), ("Provider 2", "GROUP A"), ("Provider 3", "GROUP B")]
PROVIDER_SQL = "(VALUES " + ", ".join(f"('{a}', '{b}')" for a, b in PROVIDERS) + ") AS g(name, label)"


def providers(v):
    return v.spark.createDataFrame(PROVIDERS, "name string, label string")


@query("E09_regroup", "leads0", f"SELECT {ID}, label AS grp, coalesce(label, provider_name) AS grp_or_same FROM leads0 LEFT JOIN {PROVIDER_SQL} ON name = provider_name")
def _(v):
    df = regroup(v.leads0, "provider_name", providers(v), "grp", None)
    return regroup(df, "provider_name", providers(v), "grp_or_same").select(ID, "grp", "grp_or_same")


@query("E10_limit_by_state", "limits entity_params", f"WITH {CAPS} SELECT cap_state AS state, CAST(maximum_limit_by_state AS DOUBLE) AS maximum_limit_by_state FROM caps")
def _(v):
    return caps(v)


@query("E11_reject_reason", "application", """SELECT lead_sequence_id, CASE WHEN decision = 'REJECT' THEN CASE WHEN decision_detail = 'Internal Underwriting' THEN 'Internal_U/W' WHEN decision_detail LIKE '%Schema%' THEN 'Schema Reject'
  WHEN decision_detail = 'Duplicate Customer' THEN 'Dedup Reject' ELSE 'Others' END END AS reason, CASE WHEN decision = 'REJECT' AND state = 'NATION_1' THEN 'Clear Inquiry Reject' WHEN decision = 'REJECT' AND decision_detail = 'Internal Underwriting' THEN 'IU: ' || product
  WHEN decision = 'REJECT' THEN decision_detail WHEN decision = 'ACCEPT' THEN campaign_name ELSE decision_detail END AS rule FROM application""")
def _(v):
    return v.application.select(
        "lead_sequence_id", flags.reject_reason(F.col("decision"), F.col("decision_detail")).alias("reason"),
        flags.rule_label(F.col("decision"), F.when(F.col("state") == "NATION_1", "Deny"),
                         F.col("decision_detail"), F.col("product"), F.col("campaign_name"),
                         F.col("decision_detail")).alias("rule"))
