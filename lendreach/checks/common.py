"""Rules and SQL fragments the checks share."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from lendreach.checks.views import (EVENT_RUN, FLAT, INTERNAL_DOMAINS, INTERNAL_PREFIXES,
                                    PLACEHOLDERS, REMAP, RUN_DATE, Views)
from lendreach.context import RunContext
from lendreach.operators import calendar as cal_ops
from lendreach.operators.consent import sms_consent
from lendreach.plans.common import Rules

CTX = RunContext(dt.datetime.combine(RUN_DATE, dt.time(9)))
EVENT_CTX = RunContext(EVENT_RUN)
D, TS = f"DATE '{RUN_DATE}'", f"TIMESTAMP '{EVENT_RUN}'"
RULES = Rules(domains=INTERNAL_DOMAINS, prefixes=INTERNAL_PREFIXES, remap=REMAP,
              flat_products=FLAT, placeholders=PLACEHOLDERS,
              closed_states=("NATION_9", "NATION_13"),
              carve_outs=((("NATION_7",), ("BUILDING",)),),
              job_suffix={"INST": "PAJ", "LEGACY": "PA", "LOC": "PAT"})

DOM = "split_part(lower(emailaddress), '@', 2)"
EXT0 = f"{DOM} NOT IN ('internal.example.com')"
EXT = f"{EXT0} AND NOT starts_with({DOM}, 'seed')"
OPT = "email_marketingoptin IN (0, 1)"
OPT1 = "email_marketingoptin = 1"
PLACE = ("state NOT IN ('NATION_9', 'NATION_13') AND NOT coalesce(state = 'NATION_7' "
         "AND product = 'BUILDING', false)")
OK = f"isapplicationtest = 0 AND {EXT} AND {OPT} AND {PLACE}"
OK0 = f"isapplicationtest = 0 AND {EXT0} AND {OPT}"
OK1 = f"isapplicationtest = 0 AND {EXT} AND {OPT1}"
OK01 = f"isapplicationtest = 0 AND {EXT0} AND {OPT1}"
REASONS = "(1, 2, 10, 16, 19, 20, 22, 23, 24, 25, 26, 27)"


def job(date: str = "run_date") -> str:
    return (f"strftime({date}, '%m%d%Y') || CASE lms_code WHEN 'INST' THEN 'PAJ' "
            "WHEN 'LEGACY' THEN 'PA' ELSE 'PAT' END AS job_id")


def nc(c: str) -> str:
    return f"upper(substr({c}, 1, 1)) || lower(substr({c}, 2))"


def head(module: str, date: str = "run_date", jobs: str | None = None) -> str:
    """The common list columns in SQL."""
    return (f"{date} AS business_date, '{module}' AS list_module, {jobs or job(date)}, "
            "lms_customer_id, lms_application_id, received_time, lms_code, state, product, "
            f"loan_sequence, emailaddress AS email, {nc('customer_firstname')} AS customer_firstname, "
            f"{nc('customer_lastname')} AS customer_lastname")


RUNS = "runs AS (SELECT ori_date AS run_date FROM cal WHERE weekend + holiday = 0)"
NAMED = ("runs AS (SELECT ori_date AS run_date FROM cal LEFT JOIN (SELECT holiday AS t FROM holidays "
         "WHERE starts_with(description, 'Thanksgiving')) h ON ori_date = t WHERE weekend = 0 AND t IS NULL "
         "AND strftime(ori_date, '%m%d') NOT IN ('0101', '1225'))")
EVERY = "runs AS (SELECT ori_date AS run_date FROM days WHERE isodow(ori_date) <= 5)"

CONSENT = """consent AS (SELECT customer_id,
  max(first_consent_date_time) AS first_consent_date_time,
  count(*) FILTER (notification_name = 'SMS_TRANSACTIONAL' AND state = 1) AS transactional_consent,
  count(*) FILTER (notification_name = 'SMS_TRANSACTIONAL' AND stopped = 1) AS transactional_stop,
  count(*) FILTER (notification_name = 'SMS_MARKETING' AND state = 1) AS marketing_consent,
  count(*) FILTER (notification_name = 'SMS_MARKETING' AND stopped = 1) AS marketing_stop,
  count(*) FILTER (notification_name = 'PHONE_MARKETING' AND state = 1) AS phone_consent,
  count(*) FILTER (notification_name = 'PHONE_MARKETING' AND stopped = 1) AS phone_stop
  FROM (SELECT n.*, notification_name, CASE WHEN l.message = 'Stop' THEN 1 ELSE 0 END AS stopped
    FROM notifications n JOIN names ON notification_name_id = notification_name_mapping_id
    LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY customer_id, notification_name_id
      ORDER BY event_date DESC, event_id DESC) AS rn FROM sms_log) l
    ON l.customer_id = n.customer_id AND l.notification_name_id = n.notification_name_id AND rn = 1) z
  GROUP BY customer_id),
optin AS (SELECT *, CASE WHEN transactional_consent = 1 AND transactional_stop = 0 THEN 1 ELSE 0 END AS is_transactional_optin,
  CASE WHEN marketing_consent = 1 AND marketing_stop = 0 THEN 1 ELSE 0 END AS is_sms_marketing_optin FROM consent)"""
CONSENT_VIEWS = "notifications names sms_log"
OPTIN_COLS = ("coalesce(is_transactional_optin, 0) AS is_transactional_optin, "
              "coalesce(is_sms_marketing_optin, 0) AS is_sms_marketing_optin")
VARIANT = ("CASE WHEN state = 'NATION_5' AND product = 'MACHINERY' AND contains(storename, 'BAS') THEN 'MACHINERY-BAS' "
           "WHEN state = 'NATION_5' AND product = 'MACHINERY' AND contains(storename, 'NCP') THEN 'MACHINERY-NCP' "
           "ELSE product END")
MAX_LIMIT = ("coalesce(CASE WHEN paycheck IS NULL OR rpp IS NULL OR hardcap IS NULL THEN NULL ELSE "
             "least(CAST(ceil(paycheck * rpp / 25) * 25 AS DOUBLE), CAST(hardcap AS DOUBLE)) END, 1000.0)")
USABLE = ("CASE WHEN cellphone IS NULL OR trim(cellphone) = '' OR cellphone IN ('9999999999', "
          "'0000000000', '(999)999-9999') THEN homephone ELSE cellphone END")
PER_PERIOD = ("CASE payfrequency WHEN 'B' THEN CAST(nmi AS DOUBLE) / 2.16667::DOUBLE WHEN 'S' THEN CAST(nmi AS DOUBLE) / 2.0::DOUBLE "
              "WHEN 'W' THEN CAST(nmi AS DOUBLE) / 4.3333::DOUBLE WHEN 'M' THEN CAST(nmi AS DOUBLE) / 1.0::DOUBLE END")
NEXT_LIMIT = (f"CASE WHEN rate_product IN ('FURNITURE') THEN 255.0::DOUBLE WHEN {PER_PERIOD} IS NULL OR rpp IS NULL THEN NULL ELSE "
              f"least(ceil({PER_PERIOD} * CAST(rpp AS DOUBLE) / 25) * 25, CAST(hardcap AS DOUBLE)) END")
REACT = """NOT EXISTS (SELECT 1 FROM leads la2 WHERE la2.lms_customer_id = x.lms_customer_id {extra} AND (
  CAST(la2.origination_time AS DATE) >= {base}
  OR (la2.application_status = 'pending' AND CAST(la2.received_time AS DATE) >= {base})
  OR la2.loan_status IN ({bad})
  OR (la2.application_status = 'withdrawn' AND la2.withdrawn_reason_code IN (3, 6, 15, 21, 29)
      AND CAST(la2.received_time AS DATE) >= {base})))"""


def runs(v: Views, policy: str = "weekday"):
    d = v.days.select(F.col("ori_date").alias("run_date"))
    return cal_ops.allowed_dates(v.cal, v.holidays, d, policy)


def weekday_runs(v: Views):
    return v.days.filter(F.weekday("ori_date") < 5).select(F.col("ori_date").alias("run_date"))


def optin(v: Views):
    return sms_consent(v.notifications, v.names, v.sms_log)
