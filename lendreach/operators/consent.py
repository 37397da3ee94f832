"""Consent and phones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendreach.functions.flags import count_where, one, usable_phone
from lendreach.operators.history import update_from
from lendreach.operators.ranking import latest_value

# Channel names in the consent tables.
TRANSACTIONAL = "SMS_TRANSACTIONAL"
MARKETING = "SMS_MARKETING"
PHONE = "PHONE_MARKETING"


def sms_consent(notifications: DataFrame, names: DataFrame, log: DataFrame) -> DataFrame:
    """Per customer: consent counts, stop counts and the two opt-in flags.

    The log is cut to one row per customer and channel before it meets the consents.
    """
    stop = latest_value(log, ["customer_id", "notification_name_id"], "event_date", "event_id",
                        "message", "last_message")
    rows = (notifications.join(names.select(
        F.col("notification_name_mapping_id").alias("notification_name_id"), "notification_name"),
        "notification_name_id")
        .join(stop, ["customer_id", "notification_name_id"], "left")
        .withColumn("stopped", one(F.col("last_message") == "Stop")))

    def consented(name: str) -> Column:
        return count_where((F.col("notification_name") == name) & (F.col("state") == 1))

    def stopped(name: str) -> Column:
        return count_where((F.col("notification_name") == name) & (F.col("stopped") == 1))
    counts = rows.groupBy("customer_id").agg(
        F.max("first_consent_date_time").alias("first_consent_date_time"),
        consented(TRANSACTIONAL).alias("transactional_consent"),
        stopped(TRANSACTIONAL).alias("transactional_stop"),
        consented(MARKETING).alias("marketing_consent"),
        stopped(MARKETING).alias("marketing_stop"),
        consented(PHONE).alias("phone_consent"), stopped(PHONE).alias("phone_stop"))
    return counts.select(
        "*",
        one((F.col("transactional_consent") == 1) & (F.col("transactional_stop") == 0))
        .alias("is_transactional_optin"),
        one((F.col("marketing_consent") == 1) & (F.col("marketing_stop") == 0))
        .alias("is_sms_marketing_optin"))


def add_sms_consent(df: DataFrame, consent: DataFrame, key: str = "lms_customer_id",
                    required: bool = False) -> DataFrame:
    """Attach the two opt-in flags (0 when unknown), or keep consenting customers only."""
    flags = consent.select(F.col("customer_id").alias(key), "transactional_consent",
                           "marketing_consent", "is_transactional_optin",
                           "is_sms_marketing_optin")
    if required:
        flags = flags.filter("transactional_consent = 1 or marketing_consent = 1")
    out = df.join(flags.drop("transactional_consent", "marketing_consent"), key,
                  "inner" if required else "left")
    return out.fillna(0, ["is_transactional_optin", "is_sms_marketing_optin"])


def email_consent(df: DataFrame, convention: str, key: str) -> DataFrame:
    """Per customer opt-in flags for account and marketing mail.

    ``text``: opt-out columns hold 'false' or null when opted in. ``number``: opt-in columns
    hold 1. ``flags``: rows of (flag_id, flag_value), where flag 2 stops both and 6 marketing.
    """
    if convention == "text":
        def ok(c: str) -> Column:
            return one(F.col(c).isNull() | (F.lower(F.col(c)) == "false"))
        return df.select(key, ok("optout_account_email").alias("is_email_transactional_optin"),
                         ok("optout_marketing_email").alias("is_email_marketing_optin"))
    if convention == "number":
        return df.select(key, one(F.col("email_operational_optin") == 1)
                         .alias("is_email_transactional_optin"),
                         one(F.col("email_marketing_optin") == 1).alias("is_email_marketing_optin"))
    stop = F.col("flag_value") == 1
    return df.groupBy(key).agg(
        (1 - F.max(one(stop & (F.col("flag_id") == 2)))).alias("is_email_transactional_optin"),
        (1 - F.max(one(stop & F.col("flag_id").isin(2, 6)))).alias("is_email_marketing_optin"))


def add_phone(df: DataFrame, customers: DataFrame, key: str, placeholders: Sequence[str],
              out: str = "cell_phone") -> DataFrame:
    """Attach the usable phone; ``customers`` has one row per key."""
    c = customers.select(F.col("customer_id").alias(key),
                         usable_phone(F.col("cellphone"), F.col("homephone"), placeholders)
                         .alias(out))
    return df.join(c, key, "left")


def fill_phones(history: DataFrame, customers: DataFrame, system: str, since: Column) -> DataFrame:
    """Overwrite both phones of one source system's rows from a business date on."""
    src = customers.select(F.col("customer_id").alias("lms_customer_id"),
                           F.col("homephone").alias("home_phone"),
                           F.col("cellphone").alias("cell_phone"))
    return update_from(history, src, ["lms_customer_id"], ["home_phone", "cell_phone"],
                       (F.col("lms_code") == system) & (F.col("business_date") >= since))
