"""What all list builders share: the rules of a brand, eligibility, output shape."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendreach.functions.flags import carve_out, not_test, optin_filter
from lendreach.functions.text import changed_flag, external_email, job_id, name_case

# Normalised (lower case) statuses.
CLOSED = ("withdrawn", "withdraw", "originated", "approve")
WITHDRAWN = ("withdrawn", "withdraw")
# Withdrawal reasons that may be mailed, and that block re-marketing.
MAILABLE_REASONS = (1, 2, 10, 16, 19, 20, 22, 23, 24, 25, 26, 27)
WINBACK_REASONS = (1, 2, 4, 5, 8, 9, 10, 12, 13, 16, 19, 24, 25, 26, 27, 32)
BLOCKING_REASONS = (3, 6, 15, 21, 29)


@dataclass(frozen=True)
class Rules:
    """What differs between brands."""

    domains: Sequence[str] = ()
    prefixes: Sequence[str] = ()
    remap: Sequence[tuple[str, str, str, str]] = ()
    flat_products: Sequence[str] = ()
    placeholders: Sequence[str] = ("9999999999", "0000000000", "(999)999-9999")
    closed_states: Sequence[str] = ()
    carve_outs: Sequence[tuple[Sequence[str], Sequence[str]]] = ()
    job_suffix: Mapping[str, str] = None


def eligible(df: DataFrame, rules: Rules, opted_in_only: bool, use_prefixes: bool = True) -> DataFrame:
    """No test applications, no internal mail, known (or positive) opt-in."""
    return df.filter(
        not_test(F.col("isapplicationtest"))
        & external_email(F.col("emailaddress"), rules.domains,
                         rules.prefixes if use_prefixes else ())
        & optin_filter(F.col("email_marketingoptin"), opted_in_only))


def allowed_place(df: DataFrame, rules: Rules) -> DataFrame:
    keep = carve_out(F.col("state"), F.col("product"), rules.carve_outs)
    if rules.closed_states:
        keep = keep & ~F.col("state").isin(list(rules.closed_states))
    return df.filter(keep)


def system_job(rules: Rules, date: Column) -> Column:
    """MMddyyyy plus the suffix of the source system."""
    return job_id(date, [(F.col("lms_code") == code, "", suffix)
                         for code, suffix in rules.job_suffix.items()])


def _columns(extras: Sequence[Column | str]) -> list[Column | str]:
    """The columns of a list that no run date changes."""
    return ["lms_customer_id", "lms_application_id", "received_time", "lms_code",
            "state", "product", "loan_sequence", F.col("emailaddress").alias("email"),
            name_case(F.col("customer_firstname")).alias("customer_firstname"),
            name_case(F.col("customer_lastname")).alias("customer_lastname"), *extras]


def list_rows(df: DataFrame, module: str | Column, date: str, job: Column,
              extras: Sequence[Column | str] = ()) -> DataFrame:
    """The common list columns plus extras, without repeated rows."""
    name = F.lit(module) if isinstance(module, str) else module
    return df.select(F.col(date).alias("business_date"), name.alias("list_module"),
                     job.alias("job_id"), *_columns(extras)).distinct()


def list_rows_per_run(df: DataFrame, run_dates: DataFrame, first: str, last: str, module: str,
                      job: Column, extras: Sequence[Column | str] = ()) -> DataFrame:
    """The rows of :func:`list_rows` for every run date from ``first`` to ``last`` of a row.

    Rows are made distinct before they are opened into their run dates, so nothing is sorted or kept per run
    date. ``first`` and ``last`` must follow from the list columns; ``job`` may hold the run date and the system,
    ``extras`` no run date.
    """
    once = df.filter(F.col(first) <= F.col(last)).select(
        F.col(first).alias("_first"), F.col(last).alias("_last"), *_columns(extras)).distinct()
    each = once.withColumn("run_date", F.explode(F.sequence("_first", "_last")))
    each = each.join(run_dates.select("run_date").distinct(), "run_date")
    return each.select(F.col("run_date").alias("business_date"), F.lit(module).alias("list_module"),
                       job.alias("job_id"), *[c for c in once.columns if c not in ("_first", "_last")])


def requested() -> Column:
    return F.coalesce("requested_amount", "approved_amount").alias("requested_amount")


def exclude_reactivated(df: DataFrame, leads: DataFrame, keys: Sequence[str], base_date: Column,
                        bad_loans: Sequence[str],
                        reasons: Sequence[int] = BLOCKING_REASONS) -> DataFrame:
    """Drop customers who took a loan, applied, or withdrew for a blocking reason on or after
    ``base_date``, or ever had a bad loan. One summary row per customer meets the list."""
    day = F.to_date("received_time")
    seen = leads.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(
        F.max(F.to_date("origination_time")).alias("_orig"),
        F.max(F.when(F.col("application_status") == "pending", day)).alias("_pend"),
        F.max(F.when(F.col("application_status").isin(*WITHDRAWN)
                     & F.col("withdrawn_reason_code").isin(*reasons), day)).alias("_wd"),
        F.max(F.when(F.col("loan_status").isin(*bad_loans), 1).otherwise(0)).alias("_bad"))
    left = df.withColumn("_base", base_date)
    cond = ((F.col("_orig") >= F.col("_base")) | (F.col("_pend") >= F.col("_base"))
            | (F.col("_wd") >= F.col("_base")) | (F.col("_bad") == 1))
    for k in keys:
        cond = cond & (F.col(k) == F.col(f"_{k}"))
    return left.join(seen, cond, "left_anti").drop("_base")


def account_flags(accounts: DataFrame) -> DataFrame:
    """Per lead: did routing or account number change between application and loan system?
    Both sides are hashes."""
    return accounts.select(
        "lead_sequence_id", "no_bank_call",
        changed_flag(F.col("lms_routing_hash"), F.col("app_routing_hash")).alias("routing_changed"),
        changed_flag(F.col("lms_account_hash"), F.col("app_account_hash")).alias("account_changed"))
