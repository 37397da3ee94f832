"""Pending-application lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendreach.functions.dates import hour_between
from lendreach.functions.flags import one
from lendreach.functions.money import max_limit
from lendreach.functions.text import bank_verification
from lendreach.operators.consent import add_phone, add_sms_consent
from lendreach.operators.joins import bounded, exclude_later, in_windows
from lendreach.operators.limits import rate_card_join
from lendreach.plans.common import (CLOSED, Rules, account_flags, allowed_place, eligible,
                                    list_rows, requested, system_job)

# The checklist steps and their flag names.
TODO_FLAGS = {
    "e-sig": "esig_wf", "Bank Verification": "bv_wf", "Spouse Info": "spouse_wf",
    "Read and Agreed to T&C": "tnc_wf", "Other loan Amount": "other_wf",
    "References": "ref_wf", "Employment Verification Info": "emp_wf", "Paystub": "paystub_wf",
}


def _still_open(df: DataFrame, leads: DataFrame, day: Column) -> DataFrame:
    """Without customers who were closed on the same or a later day."""
    closed = leads.filter(F.col("application_status").isin(*CLOSED))
    return exclude_later(df, closed, "lms_customer_id", day, F.to_date("received_time"))


def _named(df: DataFrame, new: str | None, returning: str | None) -> DataFrame:
    """Mark new and returning customers with their list's name; rows of neither are dropped.

    Both lists come from one pass over the applications.
    """
    is_new = (F.col("loan_sequence") == 1) & (F.col("isreturning") == 0)
    is_back = (F.col("loan_sequence") > 1) & (F.col("isreturning") == 1)
    name = F.when(is_new, F.lit(new)).when(is_back, F.lit(returning))
    return df.withColumn("_module", name).filter("_module is not null")


def _key_word(names: dict[tuple[str, str | None], str]) -> Column:
    out = None
    for (system, product), text in names.items():
        cond = F.col("lms_code") == system
        if product:
            cond = cond & (F.col("product") == product)
        out = F.when(cond, text) if out is None else out.when(cond, text)
    return (out.otherwise("application") if out is not None else F.lit("application"))


def list_pending_window(leads: DataFrame, rates: DataFrame, consent: DataFrame, windows: DataFrame,
                        rules: Rules, new: str | None, returning: str | None,
                        key_words: dict | None = None) -> DataFrame:
    """Pending applications received in each run date's window, with limit and SMS consent.

    ``new`` and ``returning`` name the two lists (null to leave one out); first and second
    touch differ only in ``windows``.
    """
    base = allowed_place(eligible(leads.filter("application_status = 'pending'"), rules, False),
                         rules)
    base = bounded(base, "received_time", windows, "std_date", "end_date")
    base = in_windows(_named(base, new, returning), F.to_date("received_time"), windows,
                      "std_date", "end_date")
    base = _still_open(base, leads, F.to_date("received_time"))
    base = rate_card_join(base, rates, F.col("pay_frequency"), remap=rules.remap)
    base = add_sms_consent(base, consent)
    return list_rows(base, F.col("_module"), "run_date", system_job(rules, F.col("run_date")), [
        _key_word(key_words or {}).alias("key_word"), requested(), "approved_amount",
        max_limit(F.col("paycheck"), F.col("rpp"), F.col("hardcap")).alias("max_loan_limit"),
        "is_transactional_optin", "is_sms_marketing_optin"])


def list_pending_today(leads: DataFrame, rates: DataFrame, run_dates: DataFrame, rules: Rules,
                       module: str, before_hour: int = 15) -> DataFrame:
    """Same-day pending applications, new and returning, received before the cut-off hour.

    Product variants of the rate card apply to returning customers only.
    """
    base = bounded(leads, "received_time", run_dates, "run_date", "run_date")
    base = eligible(base.filter("application_status = 'pending'"), rules, False)
    base = _named(allowed_place(base, rules), module, module)
    base = base.filter(F.hour("received_time") < before_hour)
    base = (base.withColumn("run_date", F.to_date("received_time"))
            .join(run_dates, "run_date", "left_semi"))
    base = _still_open(base, leads, F.col("run_date"))
    base = rate_card_join(base, rates, F.col("pay_frequency"), remap=rules.remap,
                          remap_where=F.col("loan_sequence") > 1)
    return list_rows(base, module, "run_date", system_job(rules, F.col("run_date")), [
        requested(), max_limit(F.col("paycheck"), F.col("rpp"), F.col("hardcap"))
        .alias("max_loan_limit")])


def list_pending_by_hour(headers: DataFrame, leads: DataFrame, rates: DataFrame,
                         run_dates: DataFrame, rules: Rules, module: str, lo: int, hi: int,
                         day_shift: int = 0) -> DataFrame:
    """New pending applications created within hours [lo, hi] of the day ``day_shift`` days
    from the run date (-1 for last night)."""
    days = run_dates.select(F.date_add("run_date", day_shift).alias("_day"))
    made = bounded(headers, "created_date", days, "_day", "_day").filter((F.col("status") == "pending")
                          & hour_between(F.col("created_date"), lo, hi))
    made = (made.withColumn("run_date", F.date_sub(F.to_date("created_date"), day_shift))
            .join(run_dates, "run_date", "left_semi"))
    base = made.select("loan_header_id", "created_date", "run_date").join(
        allowed_place(eligible(leads.filter("loan_sequence = 1"), rules, False), rules),
        F.col("loan_header_id") == F.col("lms_application_id"))
    base = _still_open(base, leads, F.to_date("created_date"))
    base = rate_card_join(base, rates, F.col("pay_frequency"), cap=None)
    return list_rows(base, module, "run_date", system_job(rules, F.col("run_date")), [
        "created_date", F.hour("received_time").alias("hour_received"),
        max_limit(F.col("paycheck"), F.col("rpp"), F.col("hardcap")).alias("max_loan_limit")])


def todo_counts(todo: DataFrame) -> DataFrame:
    """Steps, open steps and open e-signatures per application."""
    open_step = F.col("completion_time").isNull()
    return todo.groupBy("loan_header_id").agg(
        F.count_distinct("todo_name").alias("todo_item_cnt"),
        F.count(F.when(open_step, 1)).alias("incomplete_cnt"),
        F.count(F.when(open_step & (F.col("todo_name") == "e-sig"), 1)).alias("is_esig_incomplete"))


def list_pending_esign(leads: DataFrame, rates: DataFrame, todo: DataFrame, consent: DataFrame,
                       customers: DataFrame, run_dates: DataFrame, rules: Rules, system: str,
                       module: str = "PA0_no_esig") -> DataFrame:
    """Pending applications of one system whose only open step is the e-signature."""
    base = bounded(leads, "received_time", run_dates, "run_date", "run_date")
    base = eligible(base.filter((F.col("application_status") == "pending")
                                & (F.col("lms_code") == system)), rules, False)
    base = (allowed_place(base, rules).withColumn("run_date", F.to_date("received_time"))
            .join(run_dates, "run_date", "left_semi"))
    only_esign = todo_counts(todo).filter("incomplete_cnt = 1 and is_esig_incomplete = 1")
    base = base.join(only_esign, F.col("lms_application_id") == F.col("loan_header_id"))
    base = _still_open(base, leads, F.col("run_date"))
    base = rate_card_join(base, rates, F.col("pay_frequency"), cap=None)
    base = add_phone(base, customers, "lms_customer_id", rules.placeholders)
    base = add_sms_consent(base, consent)
    return list_rows(base, module, "run_date", system_job(rules, F.col("run_date")), [
        requested(), max_limit(F.col("paycheck"), F.col("rpp"), F.col("hardcap"))
        .alias("max_loan_limit"),
        one(F.col("campaign_name").contains("DM")).alias("is_dm"),
        one(F.col("origination_loan_id") > 0).alias("is_originated"),
        "todo_item_cnt", "incomplete_cnt", "is_esig_incomplete", "cell_phone",
        "is_transactional_optin", "is_sms_marketing_optin"])


def list_checklist(leads: DataFrame, todo: DataFrame, consent_state: DataFrame,
                   accounts: DataFrame, run_dates: DataFrame, rules: Rules,
                   module: str = "PA0_esig_NBV") -> DataFrame:
    """Same-day new applications with one completion flag per step and the bank label.

    ``accounts`` carries hashed account data as given in the application and in the loan
    system; the steps are pivoted in one pass over the step table.
    """
    base = bounded(leads, "received_time", run_dates, "run_date", "run_date")
    base = allowed_place(base.filter("isreturning = 0 and isexpress = 0"), rules)
    base = (base.withColumn("run_date", F.to_date("received_time"))
            .join(run_dates, "run_date", "left_semi"))
    steps = (todo.groupBy("loan_header_id").pivot("todo_name", list(TODO_FLAGS))
             .agg(F.count("completion_time"))
             .withColumnsRenamed(TODO_FLAGS))
    flags = list(TODO_FLAGS.values())
    acc = account_flags(accounts)
    base = (base.join(steps, F.col("lms_application_id") == F.col("loan_header_id"), "left")
            .join(acc, "lead_sequence_id", "left")
            .join(consent_state, "lms_customer_id", "left")
            .fillna(0, [*flags, "sms_consent"]))
    return list_rows(base, module, "run_date", system_job(rules, F.col("run_date")), [
        *flags, "sms_consent", "no_bank_call", "routing_changed", "account_changed",
        bank_verification(F.lit(0), F.col("no_bank_call"), F.col("routing_changed"),
                          F.col("account_changed")).alias("bv_final")])
