"""Good customers on a line of credit."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendreach.context import RunContext
from lendreach.functions.flags import cond_agg
from lendreach.functions.money import credit_band, rate
from lendreach.functions.text import name_case
from lendreach.operators.consent import add_phone, add_sms_consent
from lendreach.operators.joins import exclude, keep_in
from lendreach.operators.ranking import pick_one


def loc_summary(leads: DataFrame, accounts: DataFrame, txns: DataFrame, opted_out: DataFrame,
                ctx: RunContext, system: str, states: Sequence[str],
                statuses: Sequence[int] = (2, 4)) -> DataFrame:
    """One row per customer: draws, payments, returns, balance, available credit, day counts."""
    good = F.col("payment_status").isNull()
    totals = txns.groupBy("account_number").agg(*cond_agg({
        "total_draw_amount": ("sum", good & (F.col("tran_type") == "Credit"), F.col("amount")),
        "total_draw_count": ("count", good & (F.col("tran_type") == "Credit"), None),
        "last_payment_date": ("max", good & F.col("tran_type").isin("Debit", "Write-Off"),
                              F.col("effective_date")),
        "default_count": ("count", F.col("return_date").isNotNull()
                          & (F.col("tran_type") == "Debit"), None),
        "last_topup_date": ("max", F.col("return_date").isNull()
                            & (F.col("tran_type") == "Credit"), F.col("effective_date")),
    }), F.coalesce(F.sum("is_collection"), F.lit(0)).alias("collection_count"))
    people = leads.filter((F.col("lms_code") == system) & (F.col("isapplicationtest") == 0)
                          & (F.col("isoriginated") == 1) & F.col("state").isin(list(states)))
    people = pick_one(people, ["lms_customer_id"], [F.col("origination_time").desc(),
                                                    F.col("lms_application_id").desc()])
    stops = opted_out.filter("flag_id = 6 and flag_value = 1").select(
        F.col("cust_id").alias("lms_customer_id"))
    df = (exclude(people, stops, ["lms_customer_id"])
          .join(totals, F.col("lms_customer_id") == F.col("account_number"))
          .join(accounts.filter(F.col("system_status").isin(*statuses)).select(
              F.col("account_id").alias("lms_customer_id"), "credit_limit", "current_balance",
              "principal"), "lms_customer_id"))
    return df.select(
        ctx.date().alias("run_date"), "lms_customer_id", "lms_application_id", "state",
        name_case(F.col("customer_firstname")).alias("first_name"),
        F.col("emailaddress").alias("email"), "pay_frequency", "approved_amount", "loan_status",
        F.to_date("origination_time").alias("origination_date"), "total_draw_amount",
        "total_draw_count", "last_payment_date", "default_count", "collection_count",
        F.col("current_balance").alias("total_balance"),
        F.col("principal").alias("principal_balance"),
        (F.col("current_balance") - F.col("principal")).alias("fee_balance"),
        F.col("credit_limit").alias("max_loan_limit"),
        (F.col("credit_limit") - F.col("current_balance")).alias("available_credit_limit"),
        rate(F.col("credit_limit") - F.col("current_balance"), F.col("credit_limit"))
        .alias("avail_credit_rate"),
        credit_band(F.col("credit_limit") - F.col("current_balance"), F.col("credit_limit"), 60)
        .alias("available_credit_range"),
        F.datediff(ctx.date(), F.col("last_payment_date")).alias("day_since_last_payment"),
        F.datediff(ctx.date(), F.col("last_topup_date")).alias("day_since_last_topup"))


def _clean(df: DataFrame) -> DataFrame:
    return df.filter("default_count = 0 and collection_count = 0 and total_draw_count > 0")


def list_loc_good_active(summary: DataFrame, active: str) -> DataFrame:
    """Active lines with at least 60% or 150 of credit free and no draw for 30 days."""
    free = ((F.col("available_credit_limit") >= F.lit(60) / 100 * F.col("max_loan_limit"))
            | (F.col("available_credit_limit") >= 150))
    return _clean(summary).filter(free & (F.col("loan_status") == active)
                                  & (F.col("day_since_last_topup") >= 30))


def list_loc_good_inactive(summary: DataFrame, inactive: str) -> DataFrame:
    """Inactive lines: at most 5 of principal, 15 days since payment, over 15 since a draw."""
    return _clean(summary).filter(
        (F.col("principal_balance") <= 5) & (F.col("day_since_last_payment") >= 15)
        & (F.col("loan_status") == inactive) & (F.col("day_since_last_topup") > 15))


def loc_items_summary(leads: DataFrame, items: DataFrame, opted_out: DataFrame,
                      ctx: RunContext, system: str,
                      products: Sequence[str]) -> DataFrame:
    """Line-of-credit customers rebuilt from instalment items: draws negative, payments positive."""
    people = leads.filter((F.col("lms_code") == system) & (F.col("isoriginated") == 1)
                          & F.col("product").isin(list(products))
                          & (F.col("loan_status") == "originated")
                          & (F.col("isapplicationtest") == 0))
    people = pick_one(people, ["lms_customer_id"], [F.col("origination_time").desc(),
                                                    F.col("lms_application_id").desc()])
    people = exclude(people, opted_out.filter("lower(optout_marketing_email) = 'true'").select(
        F.col("customer_id").alias("lms_customer_id")), ["lms_customer_id"])
    draw, pay = F.col("total_amount") < 0, F.col("total_amount") > 0
    st = F.col("status")
    settled = items.filter(st.isin("missed", "return", "cleared", "correction")
                           & (F.col("item_date") <= ctx.date()))
    # only items of the people left above are summed
    mine = people.select(F.col("origination_loan_id").alias("payment_schedule_id"))
    settled = keep_in(settled, mine, ["payment_schedule_id"])
    totals = settled.groupBy(F.col("payment_schedule_id").alias("origination_loan_id")).agg(*cond_agg({
        "total_draw_amount": ("sum", draw & st.isin("cleared", "sent", "correction"),
                              F.col("amount_prin")),
        "total_draw_count": ("count", draw & (st == "cleared"), None),
        "total_prin_paid": ("sum", pay & st.isin("cleared", "correction"), F.col("amount_prin")),
        "last_draw_date": ("max", draw & (st == "cleared"), F.col("item_date")),
        "last_payment_date": ("max", pay & st.isin("cleared", "correction"), F.col("item_date")),
        "total_default_count": ("count", pay & st.isin("missed", "return"), None),
        "total_payment_count": ("count", pay, None),
    }))
    df = people.join(totals, "origination_loan_id", "left").fillna(
        0, ["total_draw_amount", "total_draw_count", "total_prin_paid", "total_default_count",
            "total_payment_count"])
    avail = F.col("approved_amount") + F.col("total_draw_amount") + F.col("total_prin_paid")
    return df.select(
        ctx.date().alias("run_date"), "lms_customer_id", "lms_application_id",
        "origination_loan_id", "state", "product",
        name_case(F.col("customer_firstname")).alias("first_name"),
        F.col("emailaddress").alias("email"), "pay_frequency", "approved_amount", "loan_status",
        "total_draw_amount", "total_draw_count", "total_prin_paid", "last_draw_date",
        "last_payment_date", "total_default_count", "total_payment_count",
        avail.cast("decimal(18,2)").alias("available_credit_limit"),
        rate(avail, F.col("approved_amount")).alias("avail_credit_rate"),
        credit_band(avail, F.col("approved_amount"), 10).alias("available_credit_range"),
        F.datediff(ctx.date(), F.col("last_draw_date")).alias("days_since_last_draw"),
        F.datediff(ctx.date(), F.col("last_payment_date")).alias("days_since_last_payment"))


def list_loc_good_items(summary: DataFrame, floors: Mapping[str, int],
                        min_payments: int | None = None) -> DataFrame:
    """15 days since a draw, under three returns, and either 40% or 100 of credit free, or the
    state's own floor. The second brand also asks for more than ``min_payments`` payments."""
    free = (F.col("avail_credit_rate") >= 0.4) | (F.col("available_credit_limit") >= 100)
    own: Column | None = None
    for state, floor in floors.items():
        cond, ok = F.col("state") == state, F.col("available_credit_limit") >= floor
        own = F.when(cond, ok) if own is None else own.when(cond, ok)
    keep = free if own is None else own.otherwise(free)
    df = summary.filter((F.col("days_since_last_draw") >= 15)
                        & (F.col("total_default_count") < 3) & keep)
    return df if min_payments is None else df.filter(F.col("total_payment_count") > min_payments)


def list_sms_loc(rows: DataFrame, phones: DataFrame, consent: DataFrame,
                 placeholders: Sequence[str]) -> DataFrame:
    """Text-message variant of a line-of-credit list: consent required, usable phone."""
    df = add_phone(rows, phones, "lms_customer_id", placeholders)
    return add_sms_consent(df, consent, required=True)
