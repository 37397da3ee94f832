"""Measuring campaigns: response, conversion, default, cost, reconciliation."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendreach.context import RunContext
from lendreach.functions.dates import instant, within_days
from lendreach.functions.flags import cond_agg, flag_any, one, reject_reason, usable_phone
from lendreach.functions.money import bid_band, rate
from lendreach.functions.text import clean_money, list_key, valid_state
from lendreach.operators.aggregates import (bitmap_counts, by_period, dense_ids, distinct_bitmaps, regroup,
                                            union_distinct)
from lendreach.operators.consent import email_consent
from lendreach.operators.history import update_from
from lendreach.operators.joins import (interval_join, join_sparse, match_calls,
                                       pattern_range_join)
from lendreach.operators.ranking import pick_one


def _look_flags() -> tuple[Column, Column]:
    accept = F.upper("decision") == "ACCEPT"
    return accept, (F.col("uw_cost") > 0) | accept


def monthly_looks(apps: DataFrame, leads: DataFrame, internal: Sequence[int],
                  grain: str = "year_month") -> DataFrame:
    """Looks, unique looks, mail addresses, accepts, loans and costs of external leads."""
    info = leads.filter("isuniqueaccept = 1").select("lead_sequence_id", "loan_sequence",
                                                     "origination_loan_id")
    df = (apps.filter(~F.col("lead_provider_id").isin(list(internal)))
          .join(info, "lead_sequence_id", "left"))
    accept, unique = _look_flags()
    loan = F.col("origination_loan_id").isNotNull()
    nc, rc = F.col("loan_sequence") == 1, F.col("loan_sequence") > 1
    return by_period(df, "insert_date", [
        F.count("*").alias("looks_cnt"), F.count(F.when(unique, 1)).alias("unique_looks"),
        F.count_distinct("email").alias("unique_email_cnt"),
        *cond_agg({"total_accepted": ("count", accept, None), "total_loans": ("count", loan, None),
                   "nc_cnt": ("count", nc, None), "nc_originated_cnt": ("count", nc & loan, None),
                   "rc_cnt": ("count", rc, None), "rc_originated_cnt": ("count", rc & loan, None),
                   "rc_external": ("count", rc & (F.col("lead_cost") > 1), None)}),
        F.sum("lead_cost").alias("total_lead_cost"), F.sum("uw_cost").alias("total_uw_cost")],
        grain)


def unique_addresses(apps: DataFrame, internal: Sequence[int]) -> DataFrame:
    """(received_year, received_month, _bucket, bitmaps): months of different mail addresses of external leads,
    of those looked at, accepted and rejected, as states that add up to any longer period."""
    df = apps.filter(~F.col("lead_provider_id").isin(list(internal)))
    accept, unique = _look_flags()
    df = df.join(dense_ids(df, "email"), "email").select(
        F.year("insert_date").alias("received_year"), F.month("insert_date").alias("received_month"), "dense_id",
        accept.alias("_accept"), unique.alias("_unique"))
    return distinct_bitmaps(df, "dense_id", ["received_year", "received_month"], {
        "unique_email_cnt": F.lit(True), "looked_email_cnt": F.col("_unique"), "accepted_email_cnt": F.col("_accept"),
        "rejected_email_cnt": ~F.col("_accept")})


def unique_looks(states: DataFrame) -> DataFrame:
    """Different addresses by month, by year and over all, all from the monthly states; years do not add up
    months, as an address may come back."""
    names = [c for c in states.columns if c.endswith("_cnt")]
    year, month = F.col("received_year"), F.col("received_month")
    out = None
    for grain, by in (("month", ["received_year", "received_month"]), ("year", ["received_year"]), ("all", [])):
        rows = bitmap_counts(states, by, names)
        rows = rows.select(F.lit(grain).alias("grain"), (year if "received_year" in by else F.lit(None)).cast("int").alias("received_year"),
                           (month if "received_month" in by else F.lit(None)).cast("int").alias("received_month"), *names)
        out = rows if out is None else out.unionByName(rows)
    return out


def monthly_originations(leads: DataFrame, internal: Sequence[int]) -> DataFrame:
    """Originated loans and amounts of external leads by year and month of receipt; the lead's
    cost falls back to that of the record that became the loan."""
    became = leads.filter("origination_loan_id is not null").select(
        "lms_code", "lms_customer_id", F.col("origination_loan_id").alias("lms_application_id"),
        F.col("lead_cost").alias("first_lead_cost"))
    df = leads.filter(F.col("origination_time").isNotNull()
                      & ~F.col("lead_provider_id").isin(list(internal)))
    df = df.join(became, ["lms_code", "lms_customer_id", "lms_application_id"], "left")
    return by_period(df, "received_time", [
        F.sum("isoriginated").alias("total_originated"),
        F.sum("approved_amount").alias("total_origination_amount"),
        F.count(F.when((F.col("loan_sequence") == 1)
                       & (F.coalesce("lead_cost", "first_lead_cost") > 1), 1)).alias("nc_external")])


def affiliate_detail(apps: DataFrame, leads: DataFrame, fpd: DataFrame,
                     providers: Sequence[int]) -> DataFrame:
    """Lead detail of affiliate providers with decision flags, cleaned income and outcome."""
    accept, unique = _look_flags()
    df = apps.filter(F.col("lead_provider_id").isin(list(providers)) & (F.col("uw_cost") >= 0)
                     & ~F.col("decision_detail").like("Flow%"))
    loan = leads.select("lead_sequence_id", "origination_loan_id", F.col("approved_amount")
                        .alias("_amount"))
    df = df.join(loan, "lead_sequence_id", "left")
    df = join_sparse(df, fpd.select("origination_loan_id", "is_fpd"), "origination_loan_id",
                     "lead_sequence_id")
    return df.select(
        "lead_sequence_id", "insert_date", valid_state(F.col("state"), width=8).alias("state"),
        "product", F.lit(1).alias("is_look"), one(unique).alias("is_unique_look"),
        one(accept).alias("is_accepted"),
        one(F.col("origination_loan_id").isNotNull()).alias("is_originated"),
        reject_reason(F.col("decision"), F.col("decision_detail")).alias("reject_reason"),
        "decision_detail", "uw_cost", "lead_cost", clean_money(F.col("nmi")).alias("net_income"),
        F.when(F.col("origination_loan_id").isNotNull(), F.col("_amount"))
        .alias("originated_loan_amount"), F.col("is_fpd").alias("is_first_payment_defaulted"))


def code_applications(apps: DataFrame) -> DataFrame:
    """One row per mailed code and state: accepted when any application was, first and last
    time, and the accepted (else first) application."""
    accept = F.upper("decision") == "ACCEPT"
    return apps.groupBy("affid", "state").agg(
        flag_any(accept).alias("is_accepted"), F.count("*").alias("applications"),
        F.min("insert_date").alias("first_insert_date"),
        F.max("insert_date").alias("recent_insert_date"), F.sum("uw_cost").alias("uw_cost"),
        F.coalesce(F.min_by(F.when(accept, F.col("lead_sequence_id")),
                            F.when(accept, F.struct("insert_date", "lead_sequence_id"))),
                   F.min_by("lead_sequence_id", F.struct("insert_date", "lead_sequence_id")))
        .alias("lead_sequence_id"))


def mail_response(pieces: DataFrame, apps: DataFrame, fact: DataFrame, group: str,
                  code_col: str) -> DataFrame:
    """Every mailed piece with the application and loan it led to; ``group`` names the mailing."""
    codes = code_applications(apps).select(
        F.col("affid").alias(code_col), "state", "lead_sequence_id", "is_accepted",
        "first_insert_date", "recent_insert_date", "uw_cost")
    loan = fact.select("lead_sequence_id", "isoriginated", "loan_status", "approved_amount")
    df = join_sparse(pieces.join(codes, [code_col, "state"], "left"), loan, "lead_sequence_id",
                     "piece_id")
    return df.select(F.lit(group).alias("group_split"), "piece_id", code_col, "state",
                     one(F.col("lead_sequence_id").isNotNull()).alias("is_applied"),
                     F.coalesce("is_accepted", F.lit(0)).alias("is_accepted"),
                     "lead_sequence_id", "first_insert_date", "recent_insert_date", "uw_cost",
                     F.coalesce("isoriginated", F.lit(0)).alias("is_originated"), "loan_status",
                     F.when(F.col("isoriginated") == 1, F.col("approved_amount"))
                     .alias("originated_loan_amount"))


def _coded(apps: DataFrame, mapping: DataFrame, pad_after: int = 1) -> DataFrame:
    """Applications matched to their mailing; one application per code and mailing."""
    hit = pattern_range_join(apps, mapping, "affid", "pattern", F.to_date("insert_date"),
                             "start_date", "expire_date", 5, pad_after)
    return pick_one(hit, ["mapping_id", "affid"], [F.col("insert_date"),
                                                   F.col("lead_sequence_id")])


def mail_totals(apps: DataFrame, mapping: DataFrame, ctx: RunContext,
                state_rules: Mapping[int, Column] | None = None, back: int = 90) -> DataFrame:
    """Mapping rows still running with their application totals; other rows keep theirs.

    Mailings in ``state_rules`` count only applications that fit their rule.
    """
    running = F.col("expire_date") >= F.date_sub(ctx.date(), 1)
    recent = apps.filter(within_days(F.col("insert_date"),
                                     ctx.run_date - dt.timedelta(days=back), ctx.run_date))
    hit = _coded(recent, mapping.filter(running))
    for mapping_id, rule in (state_rules or {}).items():
        hit = hit.filter((F.col("mapping_id") != mapping_id) | rule)
    totals = hit.groupBy("dm_name").agg(F.count("*").alias("total_application"))
    target = mapping.withColumn("total_application", F.lit(0).cast("bigint"))
    return update_from(target, totals, ["dm_name"], ["total_application"], running)


def mail_campaigns(apps: DataFrame, mapping: DataFrame, leads: DataFrame, fpd: DataFrame,
                   labels: DataFrame) -> DataFrame:
    """Per (relabelled) campaign: mailed, applied, accepted, originated, defaults, amounts,
    rates and costs."""
    hit = _coded(apps, mapping)
    loan = leads.filter("isoriginated = 1").select(
        "lead_sequence_id", F.col("approved_amount").alias("_amount"), F.lit(1).alias("_loan"),
        "origination_loan_id")
    df = join_sparse(hit.join(loan, "lead_sequence_id", "left"),
                     fpd.select("origination_loan_id", "is_fpd"), "origination_loan_id",
                     "lead_sequence_id")
    fine = df.groupBy("dm_name", "start_date", "total_mail_count", "unit_cost").agg(
        F.sum("uw_cost").alias("uw_cost"), F.count("*").alias("applied"),
        F.count(F.when(F.upper("decision") == "ACCEPT", 1)).alias("accepted"),
        F.count("_loan").alias("originated"), F.count("is_fpd").alias("debited"),
        F.coalesce(F.sum("is_fpd"), F.lit(0)).alias("fpd"), F.sum("_amount").alias("amount"))
    named = regroup(fine, "dm_name", labels, "campaign")
    c = named.groupBy("campaign").agg(
        F.min("start_date").alias("start_date"), F.sum("total_mail_count").alias("mailed"),
        F.max("unit_cost").alias("unit_cost"),
        *[F.sum(x).alias(x) for x in ("uw_cost", "applied", "accepted", "originated", "debited",
                                      "fpd", "amount")])
    cost = (F.col("unit_cost") * F.col("mailed")).cast("decimal(18,2)")
    return c.withColumn("year", F.year("start_date")).withColumn("cost", cost).select(
        "*", rate(F.col("applied"), F.col("mailed")).alias("net_response"),
        rate(F.col("accepted"), F.col("mailed")).alias("accepted_response"),
        rate(F.col("originated"), F.col("accepted")).alias("conversion"),
        rate(F.col("fpd"), F.col("originated")).alias("fpd_rate"),
        rate(F.col("cost"), F.col("originated")).alias("cpf"),
        rate(F.col("cost") + F.col("uw_cost"), F.col("originated")).alias("cpf_with_uw"))


def mail_performance(campaigns: DataFrame) -> DataFrame:
    """Year over year: totals, averages of campaign rates, and the weighted unit cost."""
    rates = ("net_response", "accepted_response", "conversion", "fpd_rate", "cpf", "cpf_with_uw")
    sums = ("mailed", "applied", "accepted", "originated", "debited", "fpd", "uw_cost", "cost")
    return campaigns.groupBy("year").agg(
        F.count("campaign").alias("campaign_cnt"), *[F.sum(c).alias(c) for c in sums],
        *[F.avg(c).alias(c) for c in rates],
        rate(F.sum("cost"), F.sum("mailed")).alias("average_unit_cost"))


def received_flag(apps: DataFrame, history: DataFrame, module: str, days: Sequence[int]) -> DataFrame:
    """Did each application also get a mail of a list ``days`` days after its withdrawal?"""
    sent = history.filter((F.col("list_module") == module) & F.datediff(
        F.to_date("list_generation_time"), F.to_date("withdrawn_time")).isin(list(days)))
    sent = sent.groupBy("lms_code", "lms_application_id").agg(
        F.max("business_date").alias("last_contact_date"), F.count("*").alias("contacts"))
    return (apps.join(sent, ["lms_code", "lms_application_id"], "left")
            .withColumn("is_received", one(F.col("contacts").isNotNull()))
            .select("lms_code", "lms_application_id", "state", "isoriginated",
                    "last_contact_date", "contacts", "is_received"))


def post_campaign(history: DataFrame, leads: DataFrame, events: DataFrame, draws: DataFrame,
                  ctx: RunContext, modules: Sequence[str], days: int = 7) -> DataFrame:
    """Per recipient of the lists: contact times, whether the send was right, and whether they
    came back, submitted, were accepted or originated within ``days``."""
    sent = history.filter(F.col("list_module").isin(list(modules))).groupBy("email").agg(
        F.min("received_time").alias("first_drop_off"),
        F.min("list_generation_time").alias("first_contact"),
        F.max("received_time").alias("last_drop_off"),
        F.max("list_generation_time").alias("last_contact"),
        F.count_distinct("list_generation_time").alias("sent_attempt"))
    sent = sent.filter(F.to_date("last_contact") < F.date_sub(ctx.date(), days))
    lead = pick_one(leads.filter("isuniqueaccept = 1"), ["emailaddress"],
                    [F.col("received_time").desc(), F.col("lms_application_id").desc()]).select(
        F.col("emailaddress").alias("email"), F.col("received_time").alias("accepted_time"),
        "isoriginated", "origination_loan_id", "loan_status")
    df = sent.join(lead, "email", "left").withColumn(
        "evaluation_end", F.timestamp_add("DAY", F.lit(days), F.col("last_contact")))
    before = F.col("accepted_time") < F.col("first_drop_off")
    between = F.col("accepted_time").between(F.col("first_drop_off"), F.col("first_contact"))
    df = df.withColumn("is_correct_sent", F.when(between, 11).when(before, 0).otherwise(1))
    seen = interval_join(
        df.select("email", "last_contact"),
        events.select(F.col("user_name").alias("email"), "event_ts", "page"),
        "email", "last_contact", "event_ts", 0, days * 24 * 60)
    back = seen.groupBy("email").agg(F.min("event_ts").alias("comeback_time"),
                                     flag_any(F.col("page") == "payment_schedule_submit")
                                     .alias("_submit"))
    df = df.join(back, "email", "left").withColumn("_row", F.abs(F.xxhash64("email") / 2)
                                                   .cast("bigint"))
    df = join_sparse(df, draws.withColumnRenamed("base_loan_id", "origination_loan_id"),
                     "origination_loan_id", "_row")
    right, early = F.col("is_correct_sent") == 1, F.col("is_correct_sent") == 11
    inside = F.col("accepted_time").between(F.col("last_contact"), F.col("evaluation_end"))
    return df.select(
        "email", "first_contact", "last_contact", "sent_attempt", "is_correct_sent",
        one((right & F.col("comeback_time").isNotNull()) | early).alias("is_come_back"),
        F.when(right, F.col("comeback_time")).alias("comeback_time"),
        one((right & (F.col("_submit") == 1)) | (early & F.col("accepted_time").isNotNull()))
        .alias("is_submit"),
        one((right & inside) | early).alias("is_accepted"),
        one(((right & inside) | early) & (F.col("isoriginated") == 1)).alias("is_originated"),
        F.coalesce("draw_sequence", F.lit(0)).alias("draw_sequence"), "last_draw_date")


def sends_per_draw(draws: DataFrame, history: DataFrame) -> DataFrame:
    """Customers with two or more draws, and how often they were mailed per draw count."""
    sent = history.groupBy("lms_customer_id", "total_draw_count").agg(
        F.count("*").alias("sent_attempt"), F.max("list_generation_date").alias("last_contact"))
    return (draws.filter("draw_sequence >= 2").join(sent, "lms_customer_id", "left")
            .withColumn("is_received", one(F.col("last_contact").isNotNull())))


def sms_response(history: DataFrame, leads: DataFrame, customers: DataFrame, calls: DataFrame,
                 modules: Sequence[str], placeholders: Sequence[str],
                 hours: int = 24) -> DataFrame:
    """Texted pending customers: did they originate or call in within the hours that follow?"""
    sent = history.filter(F.col("list_module").isin(list(modules))
                          & (F.col("is_transactional_optin") == 1)).select(
        "lms_code", "lms_customer_id", "lms_application_id", "list_generation_time")
    phone = customers.select(F.col("customer_id").alias("lms_customer_id"),
                             usable_phone(F.col("cellphone"), F.col("homephone"), placeholders)
                             .alias("phone"))
    df = sent.join(phone, "lms_customer_id", "left").withColumn(
        "_from", F.to_date("list_generation_time")).withColumn("_to", F.date_add("_from", 1))
    df = match_calls(df, calls, "phone", "called_ani", "call_start_time", "_from", "_to",
                     not_before="list_generation_time")
    loan = leads.select("lms_code", "lms_application_id", "origination_time")
    df = df.join(loan, ["lms_code", "lms_application_id"], "left")
    end = F.timestamp_add("HOUR", F.lit(hours), F.col("list_generation_time"))

    def within(c: str) -> Column:
        return F.col(c).between(F.col("list_generation_time"), end)
    return df.select("lms_application_id", "phone", "list_generation_time", "first_called_time",
                     one(within("first_called_time")).alias("is_called_in"),
                     one(within("origination_time")).alias("is_originated"))


def repeat_tracking(legacy_paid: DataFrame, paid: DataFrame, leads: DataFrame,
                    start: dt.date, end: dt.date, track_end: dt.date) -> DataFrame:
    """Loans paid off in a period: next application and loan, days to each, and its channel."""
    base = union_distinct(legacy_paid, paid).filter(
        F.col("last_payment_date").between(F.lit(start), F.lit(end)))
    own = leads.join(base, "lms_application_id")
    nxt = leads.filter("isuniqueaccept = 1").select(
        "lms_code", "lms_customer_id", (F.col("loan_sequence") - 1).alias("loan_sequence"),
        F.col("received_time").alias("next_received"), F.col("lead_cost").alias("next_cost"),
        F.col("origination_loan_id").alias("next_loan_id"),
        F.col("origination_time").alias("next_origination"),
        F.col("approved_amount").alias("next_amount"))
    df = own.join(nxt, ["lms_code", "lms_customer_id", "loan_sequence"], "left")
    fits = F.to_date("next_received").between(F.col("last_payment_date"), F.lit(track_end))

    def if_fits(c: Column | str) -> Column:
        return F.when(fits, F.col(c) if isinstance(c, str) else c)
    return df.select(
        "lms_code", "lms_customer_id", "lms_application_id", "state", "product", "loan_sequence",
        "last_payment_date", one(fits).alias("add_application"),
        if_fits(F.datediff(F.to_date("next_received"), F.col("last_payment_date")))
        .alias("day_to_add_application"),
        one(fits & F.col("next_loan_id").isNotNull()).alias("add_origination"),
        if_fits(F.datediff(F.to_date("next_origination"), F.col("last_payment_date")))
        .alias("day_to_add_origination"),
        if_fits(F.when(F.col("next_loan_id").isNotNull(), F.col("next_amount")))
        .alias("approved_amount2"),
        if_fits(F.when(F.col("next_cost") > 1, "External").otherwise("Internal"))
        .alias("rc_channel"))


def consent_mix(leads: DataFrame, sms: DataFrame, customers: DataFrame) -> DataFrame:
    """Applications by month and their text and mail consent."""
    s = sms.select(F.col("customer_id").alias("lms_customer_id"), "is_transactional_optin",
                   "is_sms_marketing_optin")
    m = email_consent(customers, "text", "customer_id").withColumnRenamed(
        "customer_id", "lms_customer_id")
    df = (leads.join(s, "lms_customer_id", "left").join(m, "lms_customer_id", "left")
          .fillna(0, ["is_transactional_optin", "is_sms_marketing_optin"]))
    return df.groupBy(F.date_format("received_time", "yyyy MMMM").alias("received_month"), "state",
                      "is_transactional_optin", "is_sms_marketing_optin",
                      "is_email_transactional_optin", "is_email_marketing_optin").agg(
        F.count("*").alias("applications"), F.sum("isoriginated").alias("originated"))


def needs_optout(imported: DataFrame, leads: DataFrame, sms: DataFrame, system: str) -> DataFrame:
    """Listed loans whose customer takes account texts but refused marketing texts."""
    mine = leads.filter(F.col("lms_code") == system).select(
        "loan_number", "lms_customer_id", "application_status", "loan_status")
    s = sms.select(F.col("customer_id").alias("lms_customer_id"), "is_transactional_optin",
                   "is_sms_marketing_optin")
    return (imported.join(mine, "loan_number").join(s, "lms_customer_id")
            .withColumn("needs_optout", one((F.col("is_sms_marketing_optin") == 0)
                                            & (F.col("is_transactional_optin") == 1))))


def offer_gap(fact: DataFrame, leads: DataFrame, caps: DataFrame) -> DataFrame:
    """Current offer against the amount approved before the last withdrawal and the state cap."""
    old = leads.filter(F.col("application_status").isin("withdrawn", "withdraw")
                       & (F.col("loan_sequence") == 1))
    old = pick_one(old, ["emailaddress"], [F.col("withdrawn_time").desc(),
                                           F.col("lms_application_id").desc()]).select(
        "emailaddress", F.col("approved_amount").alias("previous_approved_amount"))
    df = fact.join(old, "emailaddress", "left").join(caps, "state", "left")
    return df.select("lms_application_id", "state", "approved_amount", "previous_approved_amount",
                     "maximum_limit_by_state", "isoriginated",
                     one(F.col("approved_amount") > F.col("previous_approved_amount"))
                     .alias("is_offer_higher"),
                     one(F.col("maximum_limit_by_state") > F.col("previous_approved_amount"))
                     .alias("is_cap_higher"))


def campaign_outcome(apps: DataFrame, leads: DataFrame, fpd: DataFrame,
                     campaigns: Sequence[str]) -> DataFrame:
    """Leads of a project campaign: accepted, originated, loan amount, reason, default."""
    accept, unique = _look_flags()
    lead = leads.filter("isuniqueaccept = 1").select(
        "lead_sequence_id", "lms_code", "loan_status", "isoriginated", "approved_amount",
        "withdrawn_reason", "origination_loan_id")
    df = join_sparse(apps.filter(F.col("campaign_name").isin(list(campaigns)))
                     .join(lead, "lead_sequence_id", "left"),
                     fpd.select("origination_loan_id", "is_fpd"), "origination_loan_id",
                     "lead_sequence_id")
    return df.select("lead_sequence_id", "insert_date", "campaign_name", "state", "product",
                     one(accept).alias("is_accept"), one(unique).alias("is_unique_look"),
                     "lms_code", F.coalesce("isoriginated", F.lit(0)).alias("is_originated"),
                     F.when(F.col("isoriginated") == 1, F.col("approved_amount"))
                     .alias("origination_loan_amount"), "withdrawn_reason",
                     F.col("is_fpd").alias("is_first_payment_defaulted"))


def delivery_rates(stats: DataFrame, mapping: DataFrame, copies: int = 1) -> DataFrame:
    """Delivery per list and day: sums, then rates of sums. ``copies`` corrects a provider that
    counts each delivery several times."""
    named = regroup(stats, "category", mapping, "list_name", None)
    s = named.groupBy("report_date", "list_name").agg(
        F.sum("requests").alias("total_sent"),
        (F.sum("delivered") / F.lit(copies)).alias("total_delivered"),
        F.sum("unique_opens").alias("total_unique_opens"),
        F.sum("unique_clicks").alias("total_unique_clicks"),
        F.sum("unsubscribes").alias("total_unsubscribes"), F.sum("bounces").alias("total_bounces"))
    return s.select("*", rate(F.col("total_delivered"), F.col("total_sent")).alias("delivered_rate"),
                    rate(F.col("total_unique_opens"), F.col("total_delivered"))
                    .alias("unique_open_rate"),
                    rate(F.col("total_unique_clicks"), F.col("total_unique_opens"))
                    .alias("unique_ctr"))


def reconcile(sent: DataFrame, listed: DataFrame, tolerance: int) -> DataFrame:
    """Sent against listed counts per list and day, in both directions."""
    a = sent.select(F.col("list_name").alias("_ln"), F.col("report_date").alias("_d"),
                    "total_sent")
    b = listed.select("list_name", "business_date", "total_listed")
    df = a.join(b, (F.col("_ln") == F.col("list_name")) & (F.col("_d") == F.col("business_date")),
                "full")
    n = F.coalesce("total_listed", F.lit(0))
    return df.select(
        F.coalesce("_ln", "list_name").alias("list_name"),
        F.coalesce("_d", "business_date").alias("report_date"), "total_sent",
        n.alias("total_listed"),
        one(F.col("total_sent").between(F.col("total_listed") - tolerance,
                                        F.col("total_listed") + tolerance)).alias("is_matched"),
        one(F.col("_d") == F.col("business_date")).alias("is_ran"),
        one(F.col("total_sent") > n).alias("is_more"))


def rerun_days(history: DataFrame, skip: Sequence[str] = ("ACH",)) -> DataFrame:
    """Lists generated more than once for a business date."""
    return (history.filter(~F.col("list_module").isin(list(skip)))
            .groupBy("business_date", "list_module").agg(
                F.count_distinct("list_generation_time").alias("ran_cnt"),
                F.max("list_generation_time").alias("last_gen"),
                F.min("list_generation_time").alias("first_gen")).filter("ran_cnt > 1"))


def list_volume(history: DataFrame, specs: Sequence[tuple[str | None, Column, Sequence[int]]],
                module: str) -> DataFrame:
    """List rows by segment: (label or null for state_product, rows, days since pay-off)."""
    h = history.filter(F.col("list_module") == module).withColumn(
        "days_since_paidoff", F.datediff(F.to_date("list_generation_time"),
                                         F.col("last_repayment_date")))
    parts = []
    for label, cond, days in specs:
        group = F.lit(label) if label else list_key(F.col("state"), F.col("product"))
        parts.append(h.filter(cond & F.col("days_since_paidoff").isin(list(days))).select(
            F.month("list_generation_time").alias("month"), "business_date", "lms_customer_id",
            "lms_application_id", "state", "product", "days_since_paidoff",
            list_key(F.col("list_module"), F.col("days_since_paidoff").cast("string"))
            .alias("list_name"), group.alias("group_filter")))
    return union_distinct(*parts)


def bad_leads(leads: DataFrame, providers: DataFrame, reasons: Sequence[str], ctx: RunContext,
              days: int = 14) -> DataFrame:
    """Paid leads withdrawn for bad-lead reasons in the last ``days``, by provider group."""
    df = leads.filter(F.col("withdrawn_reason").isin(list(reasons)) & (F.col("lead_cost") > 1)
                      & within_days(F.col("withdrawn_time"), ctx.shifted(-days).run_date,
                                    ctx.shifted(-1).run_date))
    return regroup(df, "provider_name", providers, "provider_group", None).select(
        "provider_group", "lms_application_id", "state", "campaign_name", "lead_cost",
        F.to_date("received_time").alias("received_date"), "isoriginated", "application_status",
        "withdrawn_reason", "affid", "subid").distinct()


def lead_performance(leads: DataFrame, events: DataFrame, providers: DataFrame, ctx: RunContext,
                     welcome: Sequence[str], days: int = 60) -> DataFrame:
    """Paid new leads of the last ``days`` with a redirect flag ([-2, +5] minutes)."""
    df = leads.filter((F.col("loan_sequence") == 1) & (F.col("lead_cost") > 1)
                      & within_days(F.col("received_time"), ctx.shifted(-days).run_date,
                                    ctx.shifted(-1).run_date))
    hit = interval_join(df.select("lms_application_id", "lms_customer_id", "received_time"),
                        events.filter(F.col("page").isin(list(welcome)))
                        .select("lms_customer_id", "event_ts"),
                        "lms_customer_id", "received_time", "event_ts", -2, 5)
    flag = hit.select("lms_application_id").distinct().withColumn("is_redirect", F.lit(1))
    df = df.join(flag, "lms_application_id", "left").fillna(0, ["is_redirect"])
    return regroup(df, "provider_name", providers, "provider_group", None).select(
        "provider_group", "lms_application_id", "state", "campaign_name", "lead_cost",
        F.to_date("received_time").alias("received_date"), "isoriginated", "application_status",
        "withdrawn_reason", "is_redirect").distinct()


def referral_outcome(referred: DataFrame, apps: DataFrame, leads: DataFrame, schedules: DataFrame,
                     items: DataFrame, since: dt.date) -> DataFrame:
    """Referred addresses: applied, accepted, and top-ups with their amount since a date."""
    tried = apps.filter(within_days(F.col("insert_date"), since)).groupBy("email").agg(
        F.count("*").alias("applications"),
        flag_any(F.upper("decision") == "ACCEPT").alias("is_accept"),
        F.max("insert_date").alias("last_apply_time"))
    draws = items.filter((F.col("total_amount") < 0) & F.col("status").isin("sent", "cleared")
                         & (F.col("item_date") > F.lit(since))).join(
        schedules.select("payment_schedule_id", "base_loan_id"), "payment_schedule_id")
    per_loan = draws.groupBy("base_loan_id").agg(F.count("*").alias("_n"),
                                                 F.sum("total_amount").alias("_amt"))
    topups = (leads.filter("origination_loan_id is not null")
              .join(per_loan, F.col("origination_loan_id") == F.col("base_loan_id"))
              .groupBy(F.col("emailaddress").alias("email"))
              .agg(F.sum("_n").alias("topup_cnt"), F.sum("_amt").alias("total_topup_amt")))
    return (referred.join(tried, "email", "left").join(topups, "email", "left")
            .select("email", one(F.col("applications") >= 1).alias("is_apply"),
                    F.coalesce("is_accept", F.lit(0)).alias("is_accept"), "last_apply_time",
                    one(F.col("topup_cnt") > 0).alias("is_top_up"),
                    F.coalesce("topup_cnt", F.lit(0)).alias("topup_cnt"), "total_topup_amt"))


def missing_stage(apps: DataFrame, headers: DataFrame, leads: DataFrame, fact: DataFrame) -> DataFrame:
    """Where each accepted application stops: loan system, accepted leads or the fact table."""
    h = headers.select("lead_sequence_id", "loan_header_id")
    la = leads.select(F.col("lms_application_id").alias("loan_header_id"), F.lit(1).alias("_la"))
    n = fact.select(F.col("original_lead_id").alias("loan_header_id"), F.lit(1).alias("_fact"))
    df = apps.filter(F.upper("decision") == "ACCEPT").join(h, "lead_sequence_id", "left")
    df = join_sparse(df, la, "loan_header_id", "lead_sequence_id")
    df = join_sparse(df, n, "loan_header_id", "lead_sequence_id")
    return df.select("lead_sequence_id", F.to_date("insert_date").alias("insert_day"),
                     F.when(F.col("loan_header_id").isNull(), "NOT IN LMS")
                     .when(F.col("_la").isNull(), "NOT IN LA")
                     .when(F.col("_fact").isNull(), "NOT IN FACT").otherwise("OKAY")
                     .alias("checker"))


def withdrawn_extract(leads: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Paid first applications received in [start, end) and withdrawn, one per customer."""
    df = leads.filter(F.col("application_status").isin("withdrawn", "withdraw")
                      & (F.col("loan_sequence") == 1) & (F.col("lead_cost") > 1)
                      & (F.col("received_time") >= instant(start))
                      & (F.col("received_time") < instant(end)))
    df = pick_one(df, ["lms_customer_id"], [F.col("received_time").desc(),
                                            F.col("lms_application_id").desc()])
    return df.select("lms_customer_id", "lms_application_id", "state", "product", "provider_name",
                     "campaign_name", "lead_cost", "received_time", "withdrawn_reason",
                     "withdrawn_time", F.timestamp_diff("MINUTE", F.col("received_time"),
                                                        F.col("withdrawn_time"))
                     .alias("minute_to_withdrawn"))


def lead_detail(apps: DataFrame, leads: DataFrame, providers: DataFrame,
                start: dt.date, end: dt.date) -> DataFrame:
    """Accepted underwriting leads received in [start, end): bid band, cost, decision label."""
    df = apps.filter((F.upper("decision") == "ACCEPT") & (F.col("insert_date") >= instant(start))
                     & (F.col("insert_date") < instant(end)))
    info = leads.select("lead_sequence_id", "isreturning", "loan_sequence")
    df = regroup(df, "lead_provider_id", providers, "lead_provider_name", None).join(
        info, "lead_sequence_id", "left")
    accept, unique = _look_flags()
    return df.select("lead_sequence_id", "insert_date", "lead_provider_name", "campaign_name",
                     "state", bid_band(F.col("lead_cost")).alias("lead_bid_group"),
                     F.date_format("insert_date", "EEEE").alias("day_received"),
                     F.hour("insert_date").alias("hour_received"),
                     F.date_format("insert_date", "MMMM").alias("month_received"),
                     F.coalesce(one(F.contains(F.col("campaign_name"), F.lit("#"))), F.lit(0))
                     .alias("is_tag_campaign"), "isreturning", one(unique).alias("is_unique_look"),
                     (F.col("uw_cost") + F.col("lead_cost")).alias("marketing_cost"),
                     "decision_detail")


