"""Scans, writers and history maintenance; writers go to a fresh shared folder and are read back."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendreach.checks.common import CTX
from lendreach.checks.registry import query
from lendreach.operators import history as hist
from lendreach.session import fresh_path
from lendreach.sources import writers
from lendreach.sources.catalog import Catalog, read_import
from lendreach.sources.quarantine import ImportRule, load_import
from lendreach.sources.stored import StoredTable

LIST_COLS = ["business_date", "list_module", "lms_customer_id", "lms_application_id", "state", "email"]
LIST_SQL = ", ".join(LIST_COLS)


def _lists(v):
    return v.history.select(*LIST_COLS)


def _back(v, path, cols=None):
    return v.spark.read.parquet(path).select(*(cols or LIST_COLS))


@query("S01_scan", "", "SELECT o_orderkey, o_orderdate, o_orderstatus FROM orders")
def _(v):
    return Catalog(v.spark, {"orders": f"{v.sf_dir}/orders.parquet"}).read(
        "orders", ["o_orderkey", "o_orderdate", "o_orderstatus"])


@query("S02_append_history", "history", f"SELECT {LIST_SQL} FROM history WHERE list_module = 'PA' UNION ALL SELECT {LIST_SQL} FROM history")
def _(v):
    path = fresh_path(v.spark, "append")
    df = writers.gathered(_lists(v), ["list_module"])
    writers.append_history(df.filter("list_module = 'PA'"), path, ["list_module"])
    writers.append_history(df, path, ["list_module"])
    return _back(v, path)


@query("S03_replace_run", "history", f"SELECT {LIST_SQL} FROM history WHERE list_module NOT IN ('PA', 'WAD') OR list_module = 'PA' AND state <> 'NATION_1'")
def _(v):
    path = fresh_path(v.spark, "replace")
    df = writers.gathered(_lists(v), ["list_module"])
    writers.append_history(df, path, ["list_module"])
    again = df.filter("list_module = 'PA' and state <> 'NATION_1'")
    for _ in range(2):      # WAD has no row any more
        writers.replace_run(again, path, ["list_module"], runs=[("PA",), ("WAD",)])
    return _back(v, path)


@query("S04_overwrite", "history", f"SELECT {LIST_SQL} FROM history WHERE list_module = 'WAD'")
def _(v):
    path = fresh_path(v.spark, "staging")
    writers.overwrite(_lists(v), path)
    writers.overwrite(_lists(v).filter("list_module = 'WAD'"), path)
    return _back(v, path)


@query("S05_upsert", "history", """SELECT lms_application_id, list_module, state FROM history WHERE lms_application_id NOT IN
  (SELECT lms_application_id FROM history WHERE list_module = 'PA') UNION ALL
  SELECT lms_application_id, 'PA2', state FROM history WHERE list_module = 'PA'""")
def _(v):
    target = v.history.select("lms_application_id", "list_module", "state")
    staging = target.filter("list_module = 'PA'").withColumn("list_module", F.lit("PA2"))
    return hist.upsert(target, staging, ["lms_application_id"])


KEPT = ["lms_application_id", "lms_customer_id", "lms_code", "state", "home_phone", "business_date", "business_year", "list_module"]


def _history_table(v, name):
    """The list history as a stored table by year and module."""
    rows = v.history.select(*[c for c in KEPT if c in v.history.columns], F.lit(None).cast("string").alias("home_phone"),
                            F.year("business_date").alias("business_year")).select(*KEPT)
    table = StoredTable(v.spark, fresh_path(v.spark, name), rows.schema, ["business_year", "list_module"])
    table.replace(rows)
    return table, rows


STORED_HISTORY = """h AS (SELECT lms_application_id, lms_customer_id, lms_code, state, CAST(NULL AS VARCHAR) AS home_phone, business_date,
  CAST(year(business_date) AS INTEGER) AS business_year, list_module FROM history)"""


@query("S05_stored_upsert", "history", f"""WITH {STORED_HISTORY}, st AS (SELECT * REPLACE ('moved' AS state, 'PA2' AS list_module) FROM h WHERE list_module = 'PA' AND business_year = 1997)
  SELECT * FROM h WHERE lms_application_id NOT IN (SELECT lms_application_id FROM st) UNION ALL SELECT * FROM st""")
def _(v):
    table, rows = _history_table(v, "upserted")
    staging = rows.filter("list_module = 'PA' and business_year = 1997").withColumns(
        {"state": F.lit("moved"), "list_module": F.lit("PA2")})
    for _ in range(2):      # running it again changes nothing
        table.upsert(staging, ["lms_application_id"])
    return table.read()


@query("S06_stored_update", "history customer_flat", f"""WITH {STORED_HISTORY} SELECT h.* REPLACE (CASE WHEN customer_id IS NOT NULL AND lms_code = 'INST' AND business_date >= DATE '1998-01-01' THEN homephone END AS home_phone)
  FROM h LEFT JOIN customer_flat ON customer_id = lms_customer_id""")
def _(v):
    table, _rows = _history_table(v, "updated")
    src = v.customer_flat.select(F.col("customer_id").alias("lms_customer_id"), F.col("homephone").alias("home_phone"))
    table.update(src, ["lms_customer_id"], ["home_phone"],
                 (F.col("lms_code") == "INST") & (F.col("business_date") >= F.lit("1998-01-01").cast("date")))
    return table.read()


@query("S06_update_from", "history customer_flat", """SELECT lms_application_id, CASE WHEN customer_id IS NOT NULL AND lms_code = 'INST' THEN homephone ELSE 'old' END AS home_phone
  FROM history LEFT JOIN customer_flat ON customer_id = lms_customer_id""")
def _(v):
    target = v.history.select("lms_application_id", "lms_customer_id", "lms_code",
                              F.lit("old").alias("home_phone"))
    src = v.customer_flat.select(F.col("customer_id").alias("lms_customer_id"),
                                 F.col("homephone").alias("home_phone"))
    return hist.update_from(target, src, ["lms_customer_id"], ["home_phone"],
                            F.col("lms_code") == "INST").select("lms_application_id", "home_phone")


@query("S07_purge", "history leads0", "SELECT lms_application_id, list_module FROM history WHERE lms_application_id NOT IN (SELECT lms_application_id FROM leads0 WHERE isapplicationtest = 1)")
def _(v):
    return hist.purge(v.history.select("lms_application_id", "list_module"),
                      v.leads0.filter("isapplicationtest = 1"), ["lms_application_id"])


@query("S07_stored_purge", "history leads0", f"""WITH {STORED_HISTORY} SELECT * FROM h WHERE lms_application_id NOT IN (SELECT lms_application_id FROM leads0 WHERE isapplicationtest = 1)
  AND NOT (business_year = 1995 AND list_module = 'WAD')""")
def _(v):
    table, rows = _history_table(v, "purged")
    table.purge(v.leads0.filter("isapplicationtest = 1"), ["lms_application_id"])
    table.purge(rows.filter("business_year = 1995 and list_module = 'WAD'"), ["lms_application_id"])    # folders go empty
    return table.read()


@query("S08_null_where", "leads0", "SELECT lms_application_id, CASE WHEN coalesce(provider_name <> 'Own Web', false) THEN NULL ELSE campaign_name END AS campaign_name FROM leads0")
def _(v):
    return hist.null_where(v.leads0, "campaign_name", F.col("provider_name") != "Own Web").select(
        "lms_application_id", "campaign_name")


TARGET = T.StructType([T.StructField("piece_id", T.LongType()), T.StructField("code", T.StringType()),
                       T.StructField("ssn_7", T.StringType()), T.StructField("i_city", T.StringType()),
                       T.StructField("report_date", T.DateType())])


@query("S09_map_load", "pieces", "SELECT piece_id, promotion_code AS code, lpad(CAST(piece_id AS VARCHAR), 7, '0') AS ssn_7, CAST(NULL AS VARCHAR) AS i_city, DATE '1998-03-02' AS report_date FROM pieces")
def _(v):
    return hist.map_load(v.pieces, {
        "piece_id": "piece_id", "code": "promotion_code", "report_date": CTX.date(),
        "ssn_7": F.lpad(F.col("piece_id").cast("string"), 7, "0")}, TARGET)


@query("S11_export_segment", "history", "SELECT customer_firstname, email FROM history WHERE list_module = 'PA'")
def _(v):
    path = fresh_path(v.spark, "export")
    writers.export_segment(v.history.filter("list_module = 'PA'"), ["customer_firstname", "email"],
                           path)
    return v.spark.read.csv(path, header=True, schema="customer_firstname string, email string")


@query("S12_seed_rows", "history seeds", """SELECT business_date, list_module, lms_customer_id, lms_application_id, state, email FROM history WHERE list_module = 'PA'
  UNION ALL SELECT DATE '1998-03-02', 'PA', -9, -9, 'test', email_address FROM seeds WHERE is_active = 1""")
def _(v):
    return hist.with_seed_rows(_lists(v).filter("list_module = 'PA'"), v.seeds,
                               {"business_date": CTX.run_date, "list_module": "PA"})


@query("S13_read_import", "leads0", "SELECT loan_number, application_status AS list_loan_status FROM leads0 WHERE lms_code = 'INST' AND application_status = 'originated'")
def _(v):
    path = fresh_path(v.spark, "import")
    df = v.leads0.filter("lms_code = 'INST' and application_status = 'originated'").select(
        "loan_number", F.col("application_status").alias("list_loan_status"))
    df.write.option("header", True).csv(path)
    schema = T.StructType([T.StructField("loan_number", T.StringType()),
                           T.StructField("list_loan_status", T.StringType())])
    return read_import(v.spark, path, schema)


@query("S14_audit", "history", """SELECT DATE '1998-03-02' AS valuation_date, 'list' AS process_name, 'populate PA' AS process_label, 'Insert' AS process_type,
  'Insert succeeded, total row count = ' || count(*) AS message, 1 AS status_flag FROM history WHERE list_module = 'PA'""")
def _(v):
    path = fresh_path(v.spark, "audited")
    df, obs = hist.audited(_lists(v).filter("list_module = 'PA'"), "pa_rows")
    writers.overwrite(df, path)
    return hist.audit_row(df, CTX, "list", "populate PA", "Insert", obs.get["rows"])


IMPORT = T.StructType([T.StructField("loan_number", T.LongType()), T.StructField("received", T.DateType()),
                       T.StructField("amount", T.DecimalType(18, 2)), T.StructField("state", T.StringType())])
RULES_IN = (ImportRule("loan_number", required=True), ImportRule("received", required=True),
            ImportRule("amount", lowest=100, highest=3000), ImportRule("state", allowed=tuple(f"NATION_{n}" for n in range(20))))


@query("S13_import_quarantine", "leads0", """WITH f AS (SELECT lms_application_id AS k, CASE WHEN lms_application_id % 7 = 1 THEN 'L-' || loan_number WHEN lms_application_id % 7 = 2 THEN NULL ELSE loan_number END AS loan_number,
   CASE WHEN lms_application_id % 11 = 3 THEN 'soon' ELSE strftime(received_time, '%Y-%m-%d') END AS received, CAST(approved_amount AS DECIMAL(18,2)) AS amount, state FROM leads0 WHERE lms_code = 'INST'),
 r AS (SELECT *, list_filter([CASE WHEN k % 7 = 2 THEN 'loan_number: missing' WHEN k % 7 = 1 THEN 'loan_number: not a bigint' END, CASE WHEN received = 'soon' THEN 'received: not a date' END,
   CASE WHEN amount < 100 THEN 'amount: under 100' WHEN amount > 3000 THEN 'amount: over 3000' END, CASE WHEN split_part(state, '_', 2)::INT >= 20 THEN 'state: unknown value' END], lambda x: x IS NOT NULL) AS why FROM f)
 SELECT 'good' AS kind, loan_number, received, CAST(amount AS DOUBLE) AS amount, state, '' AS reasons, NULL::BIGINT AS n FROM r WHERE len(why) = 0
 UNION ALL SELECT 'bad', loan_number, received, CAST(amount AS DOUBLE), state, array_to_string(why, '; '), NULL FROM r WHERE len(why) > 0
 UNION ALL SELECT 'audit', NULL, NULL, NULL, NULL, 'Insert succeeded, total row count = ' || count(*) FILTER (len(why) = 0) || ', quarantined = ' || count(*) FILTER (len(why) > 0), NULL FROM r""")
def _(v):
    path = fresh_path(v.spark, "import-broken")
    k = F.col("lms_application_id")
    v.leads0.filter("lms_code = 'INST'").select(
        F.when(k % 7 == 1, F.concat(F.lit("L-"), "loan_number")).when(k % 7 == 2, None).otherwise(F.col("loan_number")).alias("loan_number"),
        F.when(k % 11 == 3, "soon").otherwise(F.date_format("received_time", "yyyy-MM-dd")).alias("received"),
        F.col("approved_amount").alias("amount"), "state").write.option("header", True).csv(path)
    out = load_import(v.spark, path, IMPORT, fresh_path(v.spark, "imported"), CTX, "referrals", RULES_IN)
    text = [F.col(c).cast("string") for c in ("loan_number", "received")]
    good = out.good.select(F.lit("good").alias("kind"), *text, "amount", "state", F.lit("").alias("reasons"))
    bad = out.bad.select(F.lit("bad").alias("kind"), *text, F.col("amount").cast("decimal(18,2)").alias("amount"), "state",
                         F.array_join("reasons", "; ").alias("reasons"))
    audit = out.audit.select(F.lit("audit").alias("kind"), *[F.lit(None).cast(t).alias(c) for c, t in (
        ("loan_number", "string"), ("received", "string"), ("amount", "decimal(18,2)"), ("state", "string"))],
        F.col("message").alias("reasons"))
    return good.unionByName(bad).unionByName(audit).withColumn("n", F.lit(None).cast("long"))
