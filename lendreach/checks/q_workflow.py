"""Lists built, shaped, seeded, written, read back and measured in one go."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendreach.checks import q_lists  # noqa: F401  (its queries are built on)
from lendreach.checks.common import CONSENT_VIEWS, CTX, RULES, runs
from lendreach.checks.registry import PLAIN, QUERIES, query
from lendreach.plans import daily, due, measure
from lendreach.session import fresh_path
from lendreach.sources import writers
from lendreach.sources.schemas import TABLES
from lendreach.sources.stored import StoredTable

CHAIN = {"L08_list_pending_first": ("PA", "Pending"), "L10_list_withdrawn_range": ("WAD", "Withdrawn"),
         "L16_list_paid_off": ("POL_NEW", "Paid off")}
KEPT = ["business_date", "channel", "list_name", "list_module", "list_frq", "job_id", "lms_customer_id",
        "lms_application_id", "list_generation_time", "state", "email", "last_repayment_date"]
MAILED = ["email", "customer_firstname"]


def _broken():
    raise ValueError("no rate card for the list")


def _chain(v):
    """(history, audit rows) after a run of all lists, of which one is broken; the first list runs again."""
    schema = T.StructType([*TABLES["campaign_history"], T.StructField("business_period", T.DateType())])
    table = StoredTable(v.spark, fresh_path(v.spark, "chain"), schema, ["business_period", "list_module"])
    steps = [daily.ListStep(module, label, "daily", lambda name=name: QUERIES[name](v.spark, v.sf_dir))
             for name, (module, label) in CHAIN.items()]
    steps.insert(1, daily.ListStep("DDR", "Broken", "daily", _broken))
    audit = daily.run_lists(steps, table, "campaign_history", v.seeds, CTX, "year")
    daily.run_lists(steps[:1], table, "campaign_history", v.seeds, CTX, "year")       # changes nothing

    def export():
        path = fresh_path(v.spark, "handed")
        writers.export_segment(daily.hand_off(table.read(), None, "PA", MAILED), MAILED, path)
        return v.spark.read.csv(path, header=True).count()
    return table, audit.unionByName(daily.run_step("hand off PA", "Export", CTX, v.spark, export))


def _rows_sql():
    parts = []
    for name, (module, label) in CHAIN.items():
        paid = "last_repayment_date" if module == "POL_NEW" else "CAST(NULL AS DATE)"
        parts.append(f"""SELECT business_date, 'email' AS channel, '{label}' AS list_name, list_module, 'daily' AS list_frq, job_id, lms_customer_id,
  lms_application_id, TIMESTAMP '{CTX.run_ts}' AS list_generation_time, state, email, {paid} AS last_repayment_date, customer_firstname FROM ({PLAIN[name]}) {module.lower()}""")
        parts.append(f"""SELECT DATE '{CTX.run_date}', 'email', '{label}', '{module}', 'daily', NULL, -9, -9, TIMESTAMP '{CTX.run_ts}', 'test', email_address,
  NULL, first_name FROM seeds WHERE is_active = 1""")
    return "rows AS (" + " UNION ALL ".join(parts) + ")"


def _audit_sql():
    told = [f"SELECT 'populate {m}' AS step, 'Insert succeeded, total row count = ' || count(*) AS message FROM rows WHERE list_name = '{n}'" for m, n in CHAIN.values()]
    told.append("SELECT 'populate DDR', 'Insert failed, error message = ValueError: no rate card for the list'")
    told.append("SELECT 'hand off PA', 'Export succeeded, total row count = ' || count(*) FROM (SELECT DISTINCT email, customer_firstname FROM rows WHERE list_module = 'PA') z")
    return " UNION ALL ".join(told)


VIEWS = f"leads rates cal days loans transactions seeds history stats labels_map {CONSENT_VIEWS}"


@query("S15_list_chain", VIEWS, f"""WITH {_rows_sql()}, listed AS (SELECT CASE WHEN list_module IN ('PA', 'WAD') THEN list_module ELSE 'AC' END AS ln, business_date AS bd, count(*) AS n FROM rows GROUP BY 1, 2),
  sent AS (SELECT label AS sl, report_date AS sd, CAST(sum(requests) AS BIGINT) AS q FROM stats JOIN labels_map ON name = category GROUP BY 1, 2)
  SELECT 'row' AS kind, {', '.join(KEPT)}, NULL AS message FROM rows
  UNION ALL SELECT 'audit', {', '.join('NULL' for _ in KEPT)}, step || ': ' || message FROM ({_audit_sql()}) t
  UNION ALL SELECT 'reconciled', bd, NULL, ln, {', '.join('NULL' for _ in KEPT[3:])}, CASE WHEN q BETWEEN n - 15 AND n + 15 THEN 'matched' ELSE 'not matched' END || ' of ' || n FROM listed LEFT JOIN sent ON sl = ln AND sd = bd""")
def _(v):
    table, audit = _chain(v)
    back = table.read()
    rows = back.select(F.lit("row").alias("kind"), *KEPT, F.lit(None).cast("string").alias("message"))
    told = audit.select(F.lit("audit").alias("kind"), F.concat_ws(": ", "process_label", "message").alias("message"))
    sent = measure.delivery_rates(v.stats, v.labels_map).filter("list_name is not null").select(
        "list_name", "report_date", "total_sent")
    name = F.when(F.col("list_module").isin("PA", "WAD"), F.col("list_module")).otherwise("AC")
    listed = back.groupBy(name.alias("list_name"), "business_date").agg(F.count("*").alias("total_listed"))
    match = measure.reconcile(sent, listed, 15).filter("total_listed > 0").select(
        F.lit("reconciled").alias("kind"), F.col("report_date").alias("business_date"), "list_name",
        F.concat(F.when(F.col("is_matched") == 1, "matched").otherwise("not matched"), F.lit(" of "), "total_listed").alias("message"))
    return rows.unionByName(told, allowMissingColumns=True).unionByName(match, allowMissingColumns=True)


@query("L29_due_on_holidays", "leads items schedules loans cal holidays", PLAIN["L01_list_due_instalment"].replace(
    "WITH runs AS (", """WITH base AS (""", 1).replace("), tgt AS", """), runs AS (SELECT run_date FROM base UNION
  SELECT n FROM (SELECT run_date, (SELECT min(ori_date) FROM cal WHERE ori_date > run_date AND weekend = 0) AS n FROM base) z
  JOIN cal ON ori_date = n WHERE holiday = 1 AND n NOT IN (SELECT holiday FROM holidays WHERE description IN ('Thanksgiving Day', 'Christmas', 'New Year''s Day'))), tgt AS""", 1))
def _(v):
    days = due.due_run_dates(v.cal, v.holidays, runs(v))
    return due.list_due_instalment(v.leads, v.loans, v.schedules, v.items, days, RULES, "INST",
                                   ("NATION_4", "NATION_6"))
