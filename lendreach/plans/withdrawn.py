"""Withdrawn-application lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendreach.context import RunContext
from lendreach.functions.dates import within_days
from lendreach.functions.flags import one
from lendreach.functions.text import valid_mail_ending
from lendreach.operators.calendar import is_biweekly, weekday_rota
from lendreach.operators.consent import add_phone, add_sms_consent
from lendreach.operators.joins import bounded, exclude
from lendreach.operators.ranking import latest_in_runs, latest_per
from lendreach.plans.common import (MAILABLE_REASONS, WINBACK_REASONS, WITHDRAWN, Rules,
                                    allowed_place, eligible, list_rows, list_rows_per_run, requested,
                                    system_job)


def withdrawn_new(leads: DataFrame, rules: Rules,
                  reasons: Sequence[int] = MAILABLE_REASONS) -> DataFrame:
    """Opted-in first applications withdrawn for a mailable reason."""
    base = leads.filter(F.col("application_status").isin(*WITHDRAWN)
                        & F.col("withdrawn_reason_code").isin(*reasons)
                        & (F.col("loan_sequence") == 1) & (F.col("isreturning") == 0))
    return allowed_place(eligible(base, rules, True), rules)


def live_customers(leads: DataFrame) -> DataFrame:
    """Applications that are pending or were ever originated."""
    return leads.filter((F.col("application_status") == "pending")
                        | F.col("origination_time").isNotNull())


def _extras(key_word: Column) -> list[Column | str]:
    return [requested(), "approved_amount", F.col("maxloanlimit").alias("max_loan_limit"),
            "withdrawn_reason", "withdrawn_time", key_word.alias("key_word"),
            one(F.col("campaign_name").contains("DM")).alias("extra1")]


def _last_application(df: DataFrame, date: str) -> DataFrame:
    """The customer's last application of the list; equal times are kept."""
    return latest_per(df, [date, "lms_code", "lms_customer_id"], "received_time")


def list_withdrawn_range(leads: DataFrame, run_dates: DataFrame, rules: Rules,
                         key_word: Column, back: int = 90, until: int = 1,
                         module: str = "WAD") -> DataFrame:
    """Withdrawn within [run - back, run - until] days; weekdays only."""
    windows = (run_dates.filter(F.weekday("run_date") < 5)
               .withColumn("std_date", F.date_sub("run_date", back))
               .withColumn("end_date", F.date_sub("run_date", until)))
    base = bounded(withdrawn_new(leads, rules), "withdrawn_time", windows, "std_date", "end_date")
    base = exclude(base, live_customers(leads), ["lms_customer_id"])
    base = latest_in_runs(base, ["lms_code", "lms_customer_id"], F.to_date("withdrawn_time"),
                          "received_time", back, until)
    return list_rows_per_run(base, windows, "first_run", "last_run", module,
                             system_job(rules, F.col("run_date")), _extras(key_word))


def list_withdrawn_on_days(leads: DataFrame, run_dates: DataFrame, rules: Rules,
                           days: Sequence[int] = (2, 10, 25), module: str = "WAD") -> DataFrame:
    """Withdrawn exactly n days before the run; the key word names n."""
    targets = run_dates.select("run_date", F.explode(F.array(*[F.lit(n) for n in days]))
                               .alias("days_ago")).withColumn(
        "_day", F.date_sub("run_date", F.col("days_ago")))
    base = bounded(withdrawn_new(leads, rules), "withdrawn_time", targets, "_day", "_day")
    base = exclude(base, live_customers(leads), ["lms_customer_id"])
    base = base.withColumn("_day", F.to_date("withdrawn_time")).join(targets, "_day").drop("_day")
    word = F.concat(F.lit("WA"), F.col("days_ago"))
    return list_rows(_last_application(base, "run_date"), module, "run_date",
                     system_job(rules, F.col("run_date")), _extras(word))


def list_withdrawn_aged(leads: DataFrame, ctx: RunContext, rules: Rules, days: int = 30,
                        module: str = "WAB") -> DataFrame:
    """Withdrawn at least ``days`` ago with a positive limit; empty unless the run date is a
    first or third Wednesday."""
    base = withdrawn_new(leads, rules).filter(
        within_days(F.col("withdrawn_time"), last=ctx.shifted(-days).run_date)
        & (F.col("maxloanlimit") > 0) & F.lit(is_biweekly(ctx.run_date)))
    base = exclude(base, live_customers(leads), ["lms_customer_id"])
    base = base.withColumn("run_date", ctx.date())
    return list_rows(_last_application(base, "run_date"), module, "run_date",
                     system_job(rules, F.col("run_date")), _extras(F.lit(None).cast("string")))


def list_winback(leads: DataFrame, caps: DataFrame, consent: DataFrame, customers: DataFrame,
                 rota: DataFrame, ctx: RunContext, rules: Rules, states: Sequence[str],
                 min_days: int = 30, module: str = "WA-PRJ") -> DataFrame:
    """Long-run win-back: one row per mail address, its last withdrawal, by weekday rota."""
    base = withdrawn_new(leads, rules, WINBACK_REASONS).filter(
        F.col("state").isin(list(states)) & within_days(F.col("withdrawn_time"),
                                                        last=ctx.run_date))
    base = latest_per(base, ["lms_code", "lms_customer_id"], "withdrawn_time")
    base = exclude(base, live_customers(leads), ["emailaddress"])
    base = latest_per(base, ["emailaddress"], "withdrawn_time", "one",
                      [F.col("lms_application_id")])
    base = (base.withColumn("run_date", ctx.date())
            .withColumn("days_since_last_withdraw",
                        F.datediff("run_date", F.to_date("withdrawn_time")))
            .filter((F.col("days_since_last_withdraw") > min_days)
                    & valid_mail_ending(F.col("emailaddress")))
            .withColumn("group_filter", F.when(F.col("days_since_last_withdraw") <= 365, "Group1")
                        .otherwise("Group2")))
    base = weekday_rota(base, rota, "run_date", "group_filter", "state")
    base = base.join(caps, "state", "left")
    few = base.select(F.col("lms_customer_id").alias("customer_id")).distinct()
    base = add_phone(base, customers.join(few, "customer_id", "left_semi"), "lms_customer_id", rules.placeholders)
    base = add_sms_consent(base, consent.join(few, "customer_id", "left_semi"))
    return list_rows(base, module, "run_date", system_job(rules, F.col("run_date")), [
        "approved_amount", F.col("maximum_limit_by_state").alias("max_loan_limit"),
        "withdrawn_reason", "withdrawn_time", "cell_phone", "is_transactional_optin",
        "is_sms_marketing_optin", F.col("days_since_last_withdraw").alias("extra1"),
        F.col("group_filter").alias("key_word")])


def list_cross_brand(leads: DataFrame, other_brand: DataFrame, run_dates: DataFrame, rules: Rules,
                     states: Sequence[str], back: int = 90, until: int = 1,
                     module: str = "WA_X") -> DataFrame:
    """Withdrawn in the given states with a mail address unknown to the other brand."""
    known = other_brand.filter(F.col("emailaddress").isNotNull())
    open_states = Rules(**{**rules.__dict__, "closed_states": ()})
    windows = (run_dates.withColumn("std_date", F.date_sub("run_date", back))
               .withColumn("end_date", F.date_sub("run_date", until)))
    base = bounded(withdrawn_new(leads, open_states), "withdrawn_time", windows, "std_date", "end_date").filter(
        F.col("state").isin(list(states)) & (F.col("maxloanlimit") > 0))
    base = exclude(base, live_customers(leads), ["lms_customer_id"])
    base = exclude(base, known, ["emailaddress"])
    base = latest_in_runs(base, ["lms_code", "lms_customer_id"], F.to_date("withdrawn_time"),
                          "received_time", back, until)
    return list_rows_per_run(base, windows, "first_run", "last_run", module,
                             system_job(rules, F.col("run_date")), _extras(F.lit(None).cast("string")))
