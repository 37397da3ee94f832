"""Lists around the end of a loan: pays off today, paid-off re-marketing, good customers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendreach.context import RunContext
from lendreach.functions.flags import wait_group
from lendreach.functions.money import next_limit, recency_group
from lendreach.functions.text import job_id
from lendreach.operators.aggregates import balance
from lendreach.operators.consent import add_phone, add_sms_consent
from lendreach.operators.joins import (bounded, exclude_cross_system, in_windows, keep_in,
                                       with_root_id)
from lendreach.operators.limits import rate_card_join
from lendreach.plans.common import (Rules, allowed_place, eligible, exclude_reactivated, list_rows,
                                    system_job)

# Loan outcomes that rule a customer out.
BAD_AFTER_PAYOFF = ("returned item pending paid off", "charged off pending paid off",
                    "returned item", "charged off", "charged off paid off")
BAD_GOOD_CUSTOMER = ("returned item", "charged off", "default", "default-sld", "default-bkc",
                     "default-sif", "default-frd")
PAID = ("paid off loan", "paid off")
# Least days since pay-off per wait group.
WAIT_DAYS = {"CA_PD": 65, "AL_SEP": 95, "OTHERS": 80}


def _limit(df: DataFrame, rates: DataFrame, income: DataFrame, rules: Rules) -> DataFrame:
    """Attach the limit of the next loan from current income."""
    pay = income.select(F.col("customer_id").alias("lms_customer_id"), "payfrequency", "nmi")
    df = df.join(pay, "lms_customer_id", "left")
    df = rate_card_join(df, rates, F.col("payfrequency"), step=1, remap=rules.remap)
    return df.withColumn("next_loan_limit", next_limit(
        F.col("rate_product"), F.col("nmi"), F.col("payfrequency"), F.col("rpp"),
        F.col("hardcap"), rules.flat_products))


def list_pays_off_legacy(leads: DataFrame, loans: DataFrame, payments: DataFrame,
                         rates: DataFrame, income: DataFrame, run_dates: DataFrame,
                         rules: Rules) -> DataFrame:
    """Legacy loans whose closing payment falls on the run date."""
    due = payments.filter("payment_status = 'notchecked' and is_debit = 1")
    due = due.withColumn("run_date", F.col("effective_date")).join(run_dates, "run_date",
                                                                     "left_semi")
    closing = with_root_id(loans, "id", "original_loan_id").filter(
        (F.col("loan_status") == "pending paid off") & F.col("collection_start_date").isNull())
    df = due.join(closing.select("id", "root_id", "debtor_client_id"),
                  F.col("loan_id") == F.col("id"))
    people = eligible(leads, rules, False, use_prefixes=False).drop("effective_date")
    df = df.join(people, (F.col("debtor_client_id") == F.col("lms_customer_id"))
                 & (F.col("root_id") == F.col("lms_application_id")))
    df = _limit(df, rates, income, rules)
    return list_rows(df, "PO", "run_date", job_id(F.col("run_date"), [], ("", "PO")), [
        F.col("effective_date").alias("ach_date"), F.col("payment_amount").alias("ach_debit"),
        "next_loan_limit"])


def list_pays_off(leads: DataFrame, loans: DataFrame, txns: DataFrame, rates: DataFrame,
                  income: DataFrame, collections: DataFrame, run_dates: DataFrame, rules: Rules,
                  suffixes: Sequence[tuple[Column, str]] = ()) -> DataFrame:
    """Loans pending pay-off with a debit on the run date, outside collections."""
    debit = bounded(txns, "trans_date", run_dates, "run_date", "run_date").filter(
        F.lower("trans_type").isin("debit", "d"))
    debit = debit.withColumn("run_date", F.to_date("trans_date")).join(run_dates, "run_date",
                                                                         "left_semi")
    people = eligible(leads.filter("loan_status = 'pending paid off'"), rules, False,
                      use_prefixes=False)
    people = people.withColumn("_loan", F.col("loan_number").try_cast("bigint"))
    people = people.join(collections.select(F.col("base_loan_id").alias("_loan")).distinct(),
                         "_loan", "left_anti")
    df = (people.join(loans.select("base_loan_id", "loan_header_id"),
                      F.col("lms_application_id") == F.col("loan_header_id"))
          .join(debit, "base_loan_id").filter("run_date >= last_paymentdate"))
    df = _limit(df, rates, income, rules)
    job = job_id(F.col("run_date"), [(c, "", s) for c, s in suffixes], ("", "POJ"))
    return list_rows(df, "PO", "run_date", job, [
        F.col("run_date").alias("ach_date"), F.col("amount").alias("ach_debit"),
        "next_loan_limit"])


def list_paid_off(leads: DataFrame, loans: DataFrame, txns: DataFrame, cal: DataFrame,
                  run_dates: DataFrame, rules: Rules, system: str, back: int = 91,
                  skip_products: Sequence[str] = ()) -> DataFrame:
    """Loans paid off in the last ``back`` days with nothing owed; weekend pay-offs count from
    the business day before."""
    paid = loans.filter("loan_status = 'paid off' and paid_off_date is not null")
    paid = paid.join(cal.select("ori_date", "pre_target_date"),
                     F.col("paid_off_date") == F.col("ori_date"), "left")
    paid = paid.withColumn("_day", F.when(F.weekday("paid_off_date") >= 5,
                                          F.col("pre_target_date"))
                           .otherwise(F.col("paid_off_date")))
    windows = run_dates.withColumn("std_date", F.date_sub("run_date", back)).withColumn(
        "end_date", F.col("run_date"))
    # only the loans of the windows have their balance summed
    lo, hi = windows.agg(F.min("std_date"), F.max("end_date")).first()
    paid = paid.filter(F.col("_day").between(F.lit(lo), F.lit(hi)))
    owed = balance(keep_in(txns, paid, ["base_loan_id"]), "base_loan_id",
                   {"owed": "principal_amount"}).filter("owed = 0")
    paid = paid.join(owed, "base_loan_id", "left_semi").select(
        "loan_header_id", "paid_off_date", F.col("_day").alias("paid_day"))
    people = allowed_place(eligible(leads.filter(F.col("lms_code") == system), rules, True,
                                    use_prefixes=False), rules)
    if skip_products:
        people = people.filter(~F.col("product").isin(list(skip_products)))
    df = people.join(paid, F.col("lms_application_id") == F.col("loan_header_id"))
    df = exclude_reactivated(df, leads, ["lms_customer_id"], F.col("last_paymentdate"),
                             BAD_AFTER_PAYOFF)
    df = in_windows(df, F.col("paid_day"), windows, "std_date", "end_date")
    return list_rows(df, "POL_NEW", "run_date", F.lit(""), [
        F.col("paid_off_date").alias("last_repayment_date")])


def last_payment_legacy(loans: DataFrame, payments: DataFrame) -> DataFrame:
    """(lms_application_id, last_payment_date) over all renewals of a legacy loan."""
    kept = with_root_id(loans, "id", "original_loan_id").filter(
        ~F.col("loan_status").isin("deleted", "voided renewed loan"))
    checked = payments.filter("payment_status = 'checked' and is_debit = 1")
    last = checked.groupBy("loan_id").agg(F.max("effective_date").alias("_last"))
    return (kept.select("id", "root_id").join(last, F.col("id") == F.col("loan_id"))
            .groupBy(F.col("root_id").alias("lms_application_id"))
            .agg(F.max("_last").alias("last_payment_date")))


def last_payment(schedules: DataFrame, items: DataFrame) -> DataFrame:
    """(lms_application_id, last_payment_date) of cleared payments."""
    paid = items.filter("status = 'cleared' and total_amount > 0")
    last = paid.groupBy("payment_schedule_id").agg(F.max("item_date").alias("_last"))
    return (schedules.select("payment_schedule_id", "base_loan_id")
            .join(last, "payment_schedule_id")
            .groupBy(F.col("base_loan_id").alias("lms_application_id"))
            .agg(F.max("_last").alias("last_payment_date")))


def good_customers(leads: DataFrame, legacy_last: DataFrame, last: DataFrame, rates: DataFrame,
                   income: DataFrame, ctx: RunContext, rules: Rules, legacy: str, system: str,
                   wait_pairs: Sequence[tuple[str, str]], wait_days: dict[str, int]) -> DataFrame:
    """Paid-off customers of two systems with no later activity, their next limit, recency and
    wait group, after the wait of their group."""
    base = allowed_place(eligible(leads.filter(
        F.col("loan_status").isin(*PAID) & (F.col("isoriginated") == 1)), rules, True,
        use_prefixes=False), rules)

    def system_rows(code: str, dates: DataFrame) -> DataFrame:
        return base.filter(F.col("lms_code") == code).join(dates, "lms_application_id")
    # the systems are disjoint; the list itself drops repeats
    both = system_rows(legacy, legacy_last).unionByName(system_rows(system, last))
    both = both.filter(F.col("last_payment_date") <= ctx.date())
    both = exclude_reactivated(both, leads, ["lms_customer_id", "lms_code"],
                               F.col("last_payment_date"), BAD_GOOD_CUSTOMER)
    active = F.greatest(F.to_date("origination_time"),
                        F.when(F.col("application_status") == "pending",
                               F.to_date("received_time")))
    both = exclude_cross_system(both, leads, "emailaddress", "lms_code",
                                F.col("last_payment_date"), active)
    both = _limit(both, rates, income, rules)
    both = both.withColumn("run_date", ctx.date()).withColumn(
        "days_since_paid_off", F.datediff("run_date", F.col("last_payment_date")))
    both = both.withColumn("gc_group", recency_group(F.col("days_since_paid_off"))).withColumn(
        "wait_group", wait_group(F.col("state"), F.col("product"), wait_pairs))
    due = F.lit(False)
    for group, days in wait_days.items():
        due = due | ((F.col("wait_group") == group) & (F.col("days_since_paid_off") >= days))
    return both.filter(due)


_EXTRAS = ("last_payment_date", "days_since_paid_off", "gc_group", "wait_group", "min_amt",
           "hardcap", "cell_phone", "next_loan_limit")


def list_good_customers(customers: DataFrame, phones: DataFrame, rules: Rules) -> DataFrame:
    """Monthly mail list from :func:`good_customers`."""
    df = add_phone(customers, phones, "lms_customer_id", rules.placeholders)
    return list_rows(df, "GC", "run_date", system_job(rules, F.col("run_date")), _EXTRAS)


def list_sms_good(customers: DataFrame, phones: DataFrame, consent: DataFrame,
                  rules: Rules) -> DataFrame:
    """Text-message variant: consenting customers only."""
    df = add_phone(customers, phones, "lms_customer_id", rules.placeholders)
    df = add_sms_consent(df, consent, required=True)
    return list_rows(df, "GCSMS", "run_date", system_job(rules, F.col("run_date")), [
        *_EXTRAS, "is_transactional_optin", "is_sms_marketing_optin"])
