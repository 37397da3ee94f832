"""Abandoned web applications."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendreach.context import RunContext
from lendreach.functions.dates import within_days
from lendreach.functions.flags import flag_any, one
from lendreach.functions.text import job_id, name_case
from lendreach.operators.joins import exclude, pattern_range_join
from lendreach.operators.ranking import current_version, pick_one, resolve_codes
from lendreach.session import cut_lineage
from lendreach.sources.stored import StoredTable


def last_activity(events: DataFrame, info: DataFrame, since: dt.date,
                  skip_domains: Sequence[str], known_since: dt.date | None = None) -> DataFrame:
    """Last activity and event count per web user since a day, with the form data; users ever
    rejected, or known as customers since ``known_since``, are left out.

    All of it comes from one aggregation of the events.
    """
    keep = F.lit(True)
    for d in skip_domains:
        keep = keep & ~F.lower("user_name").endswith(d.lower())
    recent = within_days(F.col("event_ts"), since)
    known = F.lit(False) if known_since is None else (
        (F.col("known_id") > 0) & within_days(F.col("event_ts"), known_since))
    seen = events.filter(keep).groupBy("user_name").agg(
        F.max(F.when(recent, F.col("event_ts"))).alias("dropoff_time"),
        F.count(F.when(recent, F.col("id"))).alias("record_cnt"),
        flag_any((F.col("page") == "reject") | known).alias("_out"))
    seen = seen.filter("_out = 0 and dropoff_time is not null").drop("_out")
    return seen.join(form_data(info), "user_name", "left")


def form_data(info: DataFrame) -> DataFrame:
    """One row of form data an address: the first by name, state and amount, so that nobody is mailed twice."""
    form = info.select(F.col("email").alias("user_name"), "firstname", "state", "amount")
    return pick_one(form, ["user_name"], [F.col("firstname"), F.col("state"), F.col("amount")])


ACTIVITY = T.StructType([T.StructField("user_name", T.StringType()), T.StructField("dropoff_time", T.TimestampNTZType()),
                         T.StructField("record_cnt", T.LongType()), T.StructField("day", T.DateType())])
BARRED = T.StructType([T.StructField("user_name", T.StringType()), T.StructField("is_rejected", T.IntegerType()),
                       T.StructField("is_known", T.IntegerType()), T.StructField("day", T.DateType())])


class DailyActivity:
    """Activity per user and day, kept as two stored tables: what users did, and who was rejected or known that day.

    A run reads the events of its own days alone and replaces their partitions; lists merge a few days of small
    rows, and who is barred comes from a table that holds only such users.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.activity = StoredTable(spark, f"{path}/activity", ACTIVITY, ["day"])
        self.barred = StoredTable(spark, f"{path}/barred", BARRED, ["day"])

    def refresh(self, events: DataFrame, first: dt.date, last: dt.date, skip_domains: Sequence[str]) -> None:
        """Work out the days from ``first`` to ``last`` again; the scan is bounded by them."""
        keep = within_days(F.col("event_ts"), first, last)
        for d in skip_domains:
            keep = keep & ~F.lower("user_name").endswith(d.lower())
        known = F.col("known_id") > 0
        seen = cut_lineage(events.filter(keep).groupBy("user_name", F.to_date("event_ts").alias("day")).agg(
            F.max("event_ts").alias("dropoff_time"), F.count("id").alias("record_cnt"),
            flag_any(F.col("page") == "reject").alias("is_rejected"), flag_any(known).alias("is_known")), "activity")
        days = [(first + dt.timedelta(days=i),) for i in range((last - first).days + 1)]
        self.activity.replace(seen, days)
        self.barred.replace(seen.filter("is_rejected + is_known > 0"), days)

    def last_activity(self, info: DataFrame, since: dt.date, until: dt.date, known_since: dt.date | None = None,
                      ) -> DataFrame:
        """The rows of :func:`last_activity` up to a day, from the stored days."""
        recent = self.activity.read().filter(F.col("day").between(F.lit(since), F.lit(until))).groupBy("user_name").agg(
            F.max("dropoff_time").alias("dropoff_time"), F.sum("record_cnt").alias("record_cnt"))
        out = F.col("is_rejected") == 1
        if known_since is not None:
            out = out | ((F.col("is_known") == 1) & (F.col("day") >= F.lit(known_since)))
        gone = self.barred.read().filter((F.col("day") <= F.lit(until)) & out)
        return exclude(recent, gone, ["user_name"]).join(form_data(info), "user_name", "left")


def mail_offers(log: DataFrame, amounts: DataFrame, mapping: DataFrame,
                ctx: RunContext, back: int = 60) -> DataFrame:
    """Open direct-mail offer per mail address: code, amount, expiry.

    The first address to use a code owns it; an address with several codes keeps its last.
    """
    recent = log.filter((F.col("application_status") == 1)
                        & within_days(F.col("create_datetime"), ctx.run_date - dt.timedelta(days=back), ctx.run_date))
    codes = resolve_codes(recent, "promo_code", "email", "create_datetime", "validation_date",
                          "log_id")
    codes = codes.join(current_version(amounts, ["state"], "id").select("state", "offer"), "state")
    live = (mapping.filter(F.col("expire_date") >= ctx.date())
            .withColumn("_start", ctx.date()))
    hit = pattern_range_join(codes, live, "promo_code", "pattern", ctx.date(), "_start",
                             "expire_date")
    return pick_one(hit, ["email"], [F.col("expire_date").desc(), F.col("mapping_id")]).select(
        "email", "promo_code", "offer", "expire_date")


def abandoned(events: DataFrame, info: DataFrame, leads: DataFrame, since: dt.date,
              skip_domains: Sequence[str], states: Sequence[str] | None = None,
              known_since: dt.date | None = None) -> DataFrame:
    """Users who stopped: never rejected, not accepted under that address, and (optionally) not
    known as a customer since a date."""
    return unaccepted(last_activity(events, info, since, skip_domains, known_since), leads, states)


def unaccepted(df: DataFrame, leads: DataFrame, states: Sequence[str] | None = None) -> DataFrame:
    """Users not accepted under that address, in ``states`` where given."""
    df = exclude(df, leads.select(F.col("emailaddress").alias("user_name")), ["user_name"])
    return df if states is None else df.filter(F.col("state").isin(list(states)))


def _rows(df: DataFrame, ctx: RunContext, module: str, offers: DataFrame | None) -> DataFrame:
    extras = []
    if offers is not None:
        df = df.join(offers.withColumnRenamed("email", "user_name"), "user_name", "left")
        extras = [F.col("offer").alias("approved_amount"),
                  one(F.col("promo_code").isNotNull()).alias("extra1"), "promo_code",
                  F.col("expire_date").alias("dm_expire_date")]
    return df.select(
        ctx.date().alias("business_date"), F.lit(module).alias("list_module"),
        job_id(ctx.date(), [], ("", module)).alias("job_id"), F.col("user_name").alias("email"),
        name_case(F.col("firstname")).alias("customer_firstname"),
        F.col("amount").alias("requested_amount"), F.col("dropoff_time").alias("received_time"),
        F.col("record_cnt").alias("key_word"), "state", *extras)


def list_abandoned_hourly(df: DataFrame, offers: DataFrame, ctx: RunContext, longest: int = 105,
                          shortest: int = 45, module: str = "ACH") -> DataFrame:
    """Last activity between ``longest`` and ``shortest`` minutes before the run, both included."""
    lo = ctx.run_ts - dt.timedelta(minutes=longest)
    hi = ctx.run_ts - dt.timedelta(minutes=shortest)
    return _rows(df.filter(F.col("dropoff_time").between(F.lit(lo).cast("timestamp_ntz"),
                                                         F.lit(hi).cast("timestamp_ntz"))),
                 ctx, module, offers)


def list_abandoned_daily(df: DataFrame, offers: DataFrame, ctx: RunContext,
                         module: str = "ACD") -> DataFrame:
    """Last activity yesterday, up to the first instant of today."""
    today = dt.datetime.combine(ctx.run_date, dt.time())
    lo = today - dt.timedelta(days=1)
    return _rows(df.filter(F.col("dropoff_time").between(F.lit(lo).cast("timestamp_ntz"),
                                                         F.lit(today).cast("timestamp_ntz"))),
                 ctx, module, offers)


def list_abandoned_aged(df: DataFrame, ctx: RunContext, days: int = 30,
                        module: str = "ACB") -> DataFrame:
    """Last activity at least ``days`` days before the run date."""
    hi = dt.datetime.combine(ctx.run_date, dt.time()) - dt.timedelta(days=days)
    return _rows(df.filter(F.col("dropoff_time") <= F.lit(hi).cast("timestamp_ntz")), ctx, module,
                 None)
