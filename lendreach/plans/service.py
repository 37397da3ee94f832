"""Right-to-cure notices, surveys, active customers, segment extraction."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendreach.context import RunContext
from lendreach.functions.dates import delinquency_due, long_date
from lendreach.functions.flags import carve_out, one
from lendreach.functions.text import full_name, name_case, norm_key
from lendreach.operators.aggregates import union_distinct
from lendreach.operators.joins import bounded, exclude, link_sequence
from lendreach.operators.ranking import draw_sequence, pick_one

RULE_SALTS = 64


def list_right_to_cure(leads: DataFrame, accounts: DataFrame, statements: DataFrame,
                       ctx: RunContext, system: str, states: Sequence[str],
                       cure_days: int = 21) -> DataFrame:
    """Accounts that are 11 days late (Mondays 11 to 13), with due, cure and statement data."""
    late = accounts.filter((F.col("system_status") == 3)
                           & delinquency_due(F.col("days_delinquent"), ctx.date()))
    late = late.withColumn("due_date", F.date_sub(ctx.date(), F.col("days_delinquent")))
    people = leads.filter((F.col("lms_code") == system) & F.col("origination_time").isNotNull()
                          & F.col("state").isin(list(states)))
    df = late.join(people, norm_key(F.col("account_number")) == F.col("lms_customer_id"))
    sh = statements.select(F.col("account_number").alias("_acc"),
                           F.col("date_of_total_due").alias("_due"), "statement_date",
                           "minimum_payment_due")
    df = df.join(sh, (F.col("account_number") == F.col("_acc"))
                 & (F.col("due_date") == F.col("_due")), "left")
    return df.select(
        ctx.date().alias("report_date"), "lms_customer_id", F.col("emailaddress").alias("email"),
        full_name(F.col("customer_firstname"), F.col("customer_lastname"))
        .alias("customer_full_name"), F.to_date("origination_time").alias("origination_date"),
        F.col("credit_limit").alias("loc_amount"), "due_date",
        F.date_add(ctx.date(), cure_days).alias("cure_date"), "statement_date",
        "minimum_payment_due", "state", "lms_application_id", "loan_status", "days_delinquent",
        F.date_format(ctx.date(), "EEEE").alias("day_name"),
        long_date(ctx.date(), "notice").alias("full_date"))


def _survey_rows(df: DataFrame, name: str) -> DataFrame:
    return df.select("run_date", F.lit(name).alias("list_name"),
                     name_case(F.col("customer_firstname")).alias("customer_firstname"),
                     "lms_customer_id", "emailaddress", "lms_code", "product", "state",
                     "campaign_name", "origination_time", "loan_sequence", "isreturning",
                     one(F.col("lead_cost") > 1).alias("is_external"), "approved_amount")


def list_survey(leads: DataFrame, loans: DataFrame, txns: DataFrame, schedules: DataFrame,
                items: DataFrame, run_dates: DataFrame, system: str) -> DataFrame:
    """New loan today, paying off today, or a third or later draw yesterday; no repeats."""
    mine = leads.filter(F.col("lms_code") == system)
    fresh = (bounded(mine, "effective_date", run_dates, "run_date", "run_date")
             .withColumn("run_date", F.col("effective_date"))
             .join(run_dates, "run_date", "left_semi")
             .filter("loan_status <> 'voided'"))
    debits = (bounded(txns, "trans_date", run_dates, "run_date", "run_date").filter("trans_type = 'Debit'").withColumn("run_date", F.to_date("trans_date"))
              .join(run_dates, "run_date", "left_semi").select("base_loan_id", "run_date"))
    closing = (mine.filter("loan_status = 'pending paid off'")
               .join(loans.select("base_loan_id", "loan_header_id"),
                     F.col("lms_application_id") == F.col("loan_header_id"))
               .join(debits, "base_loan_id").filter("run_date >= last_paymentdate"))
    drawn = draw_sequence(items.join(schedules.filter("is_collections = 0").select(
        "payment_schedule_id", "base_loan_id"), "payment_schedule_id"), ["base_loan_id"])
    drawn = (drawn.filter("draw_sequence >= 3")
             .withColumn("run_date", F.date_add("last_draw_date", 1))
             .join(run_dates, "run_date", "left_semi"))
    drawing = (mine.filter("isoriginated = 1 and loan_status = 'originated'")
               .join(drawn, F.col("origination_loan_id") == F.col("base_loan_id")))
    return union_distinct(_survey_rows(fresh, "NEW"), _survey_rows(closing, "PAYS_OFF"),
                          _survey_rows(drawing, "THIRD_DRAW"))


def list_repeat_taken(leads: DataFrame, loans: DataFrame, ctx: RunContext, system: str,
                      back: int = 31) -> DataFrame:
    """Second loans of the last ``back`` days with the first loan's pay-off and the gap."""
    paid = loans.select(F.col("base_loan_id").alias("lms_application_id"), "paid_off_date")
    own = leads.filter("isoriginated = 1").join(paid, "lms_application_id", "left").withColumn(
        "paid_off", F.coalesce("paid_off_date", "last_paymentdate"))
    second = link_sequence(own, ["lms_code", "lms_customer_id"], "loan_sequence", -1,
                           ["paid_off", "loan_status"], "l1_")
    day = F.to_date("origination_time")
    second = second.filter((F.col("lms_code") == system) & (F.col("loan_sequence") == 2)
                           & F.col("loan_status").isin("paid off loan", "paid off", "originated")
                           & (F.col("isapplicationtest") == 0)
                           & day.between(F.date_sub(ctx.date(), back), F.date_sub(ctx.date(), 1)))
    return second.select(
        "lms_customer_id", "lms_application_id", "state", "product",
        F.col("emailaddress").alias("email"), "loan_status", "origination_time", "l1_paid_off",
        "l1_loan_status", F.datediff(day, F.col("l1_paid_off")).alias("days_funded_since_paid_off"),
        one(F.col("lead_cost") > 1).alias("rc_external"))


def list_repeat_missing(leads: DataFrame, loans: DataFrame, paid_items: DataFrame,
                        ctx: RunContext, system: str, newest: int = 30,
                        oldest: int = 60) -> DataFrame:
    """First loans paid off 30 to 60 days ago whose customer never applied again."""
    paid = loans.filter(F.col("loan_status").isin("paid off loan", "paid off")
                        & F.col("paid_off_date").between(F.date_sub(ctx.date(), oldest),
                                                         F.date_sub(ctx.date(), newest)))
    cleared = paid_items.filter("status = 'cleared' and total_amount > 0").select(
        F.col("payment_schedule_id").alias("base_loan_id"))
    paid = paid.join(cleared.distinct(), "base_loan_id", "left_semi")
    first = leads.filter((F.col("lms_code") == system) & (F.col("loan_sequence") == 1)
                         & (F.col("isoriginated") == 1) & (F.col("isapplicationtest") == 0))
    df = first.join(paid.select("base_loan_id", "paid_off_date"),
                    F.col("origination_loan_id") == F.col("base_loan_id"))
    df = exclude(df, leads.filter("loan_sequence = 2"), ["lms_code", "lms_customer_id"])
    return df.select("lms_customer_id", "lms_application_id", "loan_status", "campaign_name",
                     "paid_off_date", F.datediff(ctx.date(), F.col("paid_off_date"))
                     .alias("days_since_paid_off"))


def list_active(fact: DataFrame, system: str, states: Sequence[str], received_before: Column,
                ) -> DataFrame:
    """Customers with an originated loan in the states: latest dates per customer, received
    before a date."""
    live = fact.filter(F.col("state").isin(list(states)) & (F.col("lms_code") == system)
                       & (F.col("application_status") == "originated")
                       & (F.col("loan_status") == "originated"))
    return live.groupBy("lms_customer_id").agg(
        F.max("received_time").alias("max_received_time"),
        F.max("origination_time").alias("max_origination_time"),
        F.max_by("emailaddress", F.struct("received_time", "lms_application_id")).alias("email"),
        F.max_by("state", F.struct("received_time", "lms_application_id")).alias("state"),
        F.count("*").alias("loan_cnt")).filter(F.col("max_received_time") < received_before)


def list_active_legacy(leads: DataFrame, loans: DataFrame, payments: DataFrame, legacy: str,
                       states: Sequence[str]) -> DataFrame:
    """Legacy loans with principal left and no collection, one row per customer.

    The balance is money lent less principal collected; payments are summed per loan first.
    """
    debit = F.col("is_debit") == 1
    sums = payments.filter(F.col("payment_status").isin("checked", "rejected")).groupBy("loan_id").agg(
        F.sum(F.when(debit & (F.col("payment_status") == "checked"), -F.col("principle"))
              .when(~debit & (F.col("payment_status") == "checked"), F.col("principle")))
        .alias("_principal"),
        F.max(F.when(debit & (F.col("payment_status") == "checked"), F.col("effective_date")))
        .alias("_last"),
        F.count(F.when(debit & (F.col("payment_status") == "rejected"), 1)).alias("_bad"))
    root = F.when(F.col("original_loan_id") == 0, F.col("id")).otherwise(F.col("original_loan_id"))
    loan = (loans.filter(~F.col("loan_status").isin("deleted", "voided renewed loan"))
            .withColumn("root_id", root)
            .join(sums, F.col("id") == F.col("loan_id"), "left")
            .groupBy("root_id").agg(
                F.sum("_principal").alias("principal_balance"), F.max("_last").alias("last_payment_date"),
                F.sum("_bad").alias("default_cnt"),
                F.max(one(F.col("collection_start_date").isNotNull())).alias("is_collection")))
    people = leads.filter((F.col("lms_code") == legacy) & (F.col("isoriginated") == 1)
                          & F.col("state").isin(list(states)) & (F.col("isapplicationtest") == 0))
    df = people.join(loan, F.col("lms_application_id") == F.col("root_id")).filter(
        "principal_balance > 0 and is_collection = 0")
    counts = df.groupBy("lms_customer_id").agg(F.count("*").alias("loan_cnt"))
    one_each = pick_one(df, ["lms_customer_id"], [F.col("received_time").desc(),
                                                  F.col("lms_application_id").desc()])
    return one_each.select("lms_customer_id", "lms_application_id", "state", "product",
                           "principal_balance", "last_payment_date", "default_cnt").join(
        counts, "lms_customer_id")


def segment(history: DataFrame, spec: DataFrame, run_dates: DataFrame | None = None,
            carve: Sequence[tuple[Sequence[str], Sequence[str]]] = ()) -> DataFrame:
    """Mailing segments of a day's history from one table of rules.

    ``spec`` rows: segment, list_module, days_since (null for any), product (null for any),
    in_carve (1 inside the carved-out states and products, 0 outside, null for both) and
    extra1 (null for any). Days count from the withdrawal or the last repayment. There are few list modules, so
    each rule goes to every salt and each history row to one.
    """
    made = F.to_date("list_generation_time")
    h = history.withColumn("_days", F.datediff(
        made, F.coalesce(F.to_date("withdrawn_time"), F.col("last_repayment_date"))))
    h = h.withColumn("_in", one(~carve_out(F.col("state"), F.col("product"), carve)))
    h = h.withColumn("run_date", made)
    if run_dates is not None:
        h = h.join(run_dates, "run_date", "left_semi")
    s = spec.select("segment", F.col("list_module").alias("_m"), F.col("days_since").alias("_d"),
                    F.col("product").alias("_p"), F.col("in_carve").alias("_c"),
                    F.col("extra1").alias("_x"),
                    F.explode(F.sequence(F.lit(0), F.lit(RULE_SALTS - 1))).alias("_rule_salt"))
    h = h.withColumn("_salt", F.pmod(F.xxhash64("email", "customer_firstname", "approved_amount", "run_date"),
                                     F.lit(RULE_SALTS)).cast("int"))

    def same(rule: str, value: str) -> Column:
        return F.col(rule).isNull() | (F.col(rule) == F.col(value))
    hit = h.join(s, (F.col("list_module") == F.col("_m")) & (F.col("_salt") == F.col("_rule_salt")) & same("_d", "_days")
                 & same("_p", "product") & same("_c", "_in") & same("_x", "extra1"))
    return hit.select("segment", "run_date", "customer_firstname", "email",
                      "approved_amount").distinct()
