"""Due-date reminders for three loan systems, and the payoff variant.

All take the business dates of the run (a plain day, or two when a holiday follows) as rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendreach.functions.text import job_id
from lendreach.operators.aggregates import balance
from lendreach.operators.calendar import due_targets, rollover_dates, target_date
from lendreach.operators.joins import keep_in, with_root_id
from lendreach.operators.ranking import cycle_number
from lendreach.plans.common import Rules, eligible, list_rows

# Legacy loan states that get no reminder, and payment states still to come.
LEGACY_CLOSED = ("pending application", "deleted", "denied", "withdrawn application",
                 "voided new loan", "voided renewed loan", "paid off loan", "returned item")
LEGACY_OPEN_PAYMENTS = ("pending", "none")
# Item states that count as an earlier cycle.
CYCLE_STATES = ("cleared", "sent", "pending", "return", "missed", "correction")


def target_rows(run_dates: DataFrame, which: Sequence[str]) -> DataFrame:
    """(run_date, target, ddr_type): one row per wanted target date."""
    t = due_targets(run_dates)
    label = {"first_date": "DDR3", "second_date": "DDR9", "third_date": ""}
    pairs = [F.struct(F.col(w).alias("target"), F.lit(label[w]).alias("ddr_type")) for w in which]
    return (t.select("run_date", F.explode(F.array(*pairs)).alias("t"))
            .select("run_date", "t.target", "t.ddr_type").filter("target is not null"))


def due_run_dates(cal: DataFrame, holidays: DataFrame, run_dates: DataFrame) -> DataFrame:
    """The business dates to build lists for: every run date, and the holiday after it on which lists
    still go out, for which no run takes place."""
    return (rollover_dates(cal, holidays, run_dates)
            .select(F.col("business_date").alias("run_date")).distinct())


def _due_items(leads: DataFrame, loans: DataFrame, schedules: DataFrame, items: DataFrame,
               targets: DataFrame, rules: Rules, system: str) -> DataFrame:
    due = items.filter(((F.col("status") == "scheduled")
                        | ((F.col("payment_mode") == "NON-ACH") & (F.col("status") == "bypass")))
                       & (F.col("total_amount") > 0))
    due = due.join(targets, F.col("item_date") == F.col("target"))
    active = schedules.filter("is_active = 1 and is_collections = 0").select(
        "payment_schedule_id", F.col("base_loan_id").alias("_loan"))
    paying = loans.filter("is_paying = 1").select("base_loan_id", "loan_header_id", "customer_id")
    people = eligible(leads.filter((F.col("lms_code") == system)
                                   & ~F.col("loan_status").isin("default", "paid off")),
                      rules, False, use_prefixes=False)
    return (due.join(active, "payment_schedule_id")
            .join(paying, F.col("_loan") == F.col("base_loan_id"))
            .join(people, (F.col("customer_id") == F.col("lms_customer_id"))
                  & (F.col("loan_header_id") == F.col("lms_application_id"))))


def _loan_job(aloc_states: Sequence[str], suffix: str) -> Column:
    return job_id(F.col("run_date"), [(F.col("state").isin(list(aloc_states)), "ALOC", suffix)],
                  ("INS", suffix))


def list_due_instalment(leads: DataFrame, loans: DataFrame, schedules: DataFrame,
                        items: DataFrame, run_dates: DataFrame, rules: Rules, system: str,
                        aloc_states: Sequence[str] = ()) -> DataFrame:
    """Instalments due on the first or second target date."""
    df = _due_items(leads, loans, schedules, items,
                    target_rows(run_dates, ["first_date", "second_date"]), rules, system)
    return list_rows(df, "DDR", "run_date", _loan_job(aloc_states, "DDR"), [
        "origination_time", F.col("approved_amount").alias("original_loan_amount"),
        F.col("item_date").alias("ach_date"), F.col("total_amount").alias("ach_debit"),
        F.col("amount_fee").alias("ach_finance"), F.col("amount_prin").alias("ach_principal"),
        "ddr_type", F.col("base_loan_id").alias("origination_loan_id")])


def list_due_legacy(leads: DataFrame, loans: DataFrame, payments: DataFrame,
                    run_dates: DataFrame, rules: Rules, late_states: Sequence[str]) -> DataFrame:
    """Legacy payments due: ``late_states`` on the third date (whole amount), others on the
    first or second (payment amount)."""
    late = target_rows(run_dates, ["third_date"]).withColumn("is_late", F.lit(1))
    early = target_rows(run_dates, ["first_date", "second_date"]).withColumn("is_late", F.lit(0))
    due = payments.filter((F.col("is_debit") == 1)
                          & F.col("payment_status").isin(*LEGACY_OPEN_PAYMENTS))
    due = due.join(late.unionByName(early), F.col("effective_date") == F.col("target"))
    open_loans = with_root_id(loans, "id", "original_loan_id").filter(
        ~F.col("loan_status").isin(*LEGACY_CLOSED) & F.col("collection_start_date").isNull())
    loan_side = open_loans.select(
        "id", "root_id", "debtor_client_id", "due_date",
        F.col("approved_amount").alias("loan_amount"), F.col("approved_fee").alias("loan_fee"))
    people = eligible(leads.filter(~F.col("loan_status").isin(*LEGACY_CLOSED)), rules, False,
                      use_prefixes=False)
    df = (due.join(loan_side, F.col("loan_id") == F.col("id"))
          .filter("due_date > run_date")
          .join(people.drop("effective_date"), (F.col("debtor_client_id") == F.col("lms_customer_id"))
                & (F.col("root_id") == F.col("lms_application_id")))
          .filter(F.col("is_late") == F.col("state").isin(list(late_states)).cast("int")))
    whole = F.col("is_late") == 1
    return list_rows(df, "DDR", "run_date", job_id(F.col("run_date"), [], ("", "DDR")), [
        "origination_time", F.col("approved_amount").alias("original_loan_amount"),
        F.when(whole, F.col("due_date")).otherwise(F.col("effective_date")).alias("ach_date"),
        F.when(whole, F.col("loan_amount") + F.col("loan_fee"))
        .otherwise(F.col("payment_amount")).cast("decimal(18,2)").alias("ach_debit"),
        "ddr_type", F.col("lms_application_id").alias("origination_loan_id")])


def list_due_loc(leads: DataFrame, accounts: DataFrame, cal: DataFrame, run_dates: DataFrame,
                 rules: Rules, old_state: str, cut_off, skip_state: str) -> DataFrame:
    """Line-of-credit payments whose holiday-shifted due date is a target date.

    ``accounts`` has one row per account with its number as a plain id.
    """
    due = target_date(accounts.filter("amount_due != 0"), cal, "date_of_total_due",
                      "is_after_holiday", "ach_date")
    due = due.join(target_rows(run_dates, ["first_date", "second_date"]),
                   F.col("ach_date") == F.col("target"))
    people = eligible(leads.filter(F.col("origination_time").isNotNull()
                                   & (F.col("state") != skip_state)), rules, False,
                      use_prefixes=False)
    df = due.join(people, F.col("account_id") == F.col("lms_customer_id"))
    old = F.to_date("origination_time") < F.lit(cut_off)
    job = job_id(F.col("run_date"), [((F.col("state") == old_state) & old, "BMD", "DDR"),
                                     (old, "BLOC", "DDR"), (~old, "ALOC", "DDR")])
    return list_rows(df, "DDR", "run_date", job, [
        "origination_time", "ach_date", F.col("amount_due").alias("ach_debit"), "ddr_type",
        F.col("lms_application_id").alias("origination_loan_id")])


def list_due_payoff(leads: DataFrame, loans: DataFrame, schedules: DataFrame, items: DataFrame,
                    txns: DataFrame, refunds: DataFrame, fees: DataFrame, run_dates: DataFrame,
                    rules: Rules, system: str, states: Sequence[str],
                    fee_factor: Mapping[int, float], aloc_states: Sequence[str] = ()) -> DataFrame:
    """First-cycle payoff offer: fee, rebate, outstanding fee and payoff amount.

    ``fees`` holds capitalised fees per loan, ``refunds`` the rebate percent per entity and
    cycle; entities in ``fee_factor`` with a zero fee use the approved amount times the factor.
    """
    df = _due_items(leads.filter(F.col("state").isin(list(states))), loans, schedules, items,
                    target_rows(run_dates, ["third_date"]), rules, system)
    due = df.select("payment_schedule_id", "base_loan_id")
    cycles = cycle_number(keep_in(items.filter("total_amount > 0"), due, ["payment_schedule_id"]),
                          "payment_schedule_id", "item_date",
                          F.col("status").isin(*CYCLE_STATES)).filter("cycle_number = 1")
    df = df.join(cycles, ["payment_schedule_id", "item_date"])
    owed = balance(keep_in(txns, due, ["base_loan_id"]), "base_loan_id", {"principal_owed": "principal_amount",
                                          "fee_owed": "fee_amount"})
    df = (df.join(fees, "base_loan_id", "left").join(owed, "base_loan_id", "left")
          .join(refunds.select("entity_id", "timespan", "refund_percent"),
                (F.col("lms_entity_id") == F.col("entity_id"))
                & (F.col("timespan") == F.col("cycle_number")), "left"))
    fee = F.col("capitalized_fees")
    for entity, factor in fee_factor.items():
        fee = F.when((F.col("lms_entity_id") == entity) & (F.col("capitalized_fees") == 0),
                     F.col("approved_amount") * F.lit(factor).cast("decimal(6,2)")).otherwise(fee)
    df = df.withColumn("original_fee", fee.cast("decimal(18,2)")).withColumn(
        "rebate_amount",
        (F.col("original_fee") * F.col("refund_percent") / 100).cast("decimal(18,2)"))
    df = df.withColumn("fee_outstanding", F.col("fee_owed") - F.col("rebate_amount"))
    return list_rows(df, "DDR", "run_date", _loan_job(aloc_states, "DDR5"), [
        F.col("item_date").alias("ach_date"), F.col("total_amount").alias("ach_debit"),
        "original_fee", F.when(F.col("pay_frequency") == "M", 4)
        .when(F.col("pay_frequency").isin("S", "W", "B"), 14).alias("number_of_installment"),
        "rebate_amount", F.col("amount_int").alias("ach_interest"), "fee_outstanding",
        (F.col("principal_owed") + F.col("amount_int") + F.col("fee_outstanding"))
        .alias("pif_amount"), F.col("base_loan_id").alias("origination_loan_id")])
