"""Business calendar: run days, target dates, received windows, holiday rollover.

A calendar has one row per day; every rule here is a join or filter on it, so a back-fill
over many run dates is the same plan as a single run.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Holidays on which nothing runs.
NO_RUN_HOLIDAYS = ("Thanksgiving Day", "Christmas", "New Year's Day")


def days(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    return spark.range(1).select(
        F.explode(F.sequence(F.lit(start), F.lit(end))).alias("ori_date"))


def build_calendar(all_days: DataFrame, holidays: DataFrame) -> DataFrame:
    """Weekend and holiday marks, the business day a date is worked on, and the nearest
    business day before and after it, however long the closure. Where the calendar ends before an open
    day is found, the day itself stands."""
    cal = (all_days.join(holidays.select(F.col("holiday").alias("_h")),
                         F.col("ori_date") == F.col("_h"), "left")
           .select("ori_date", F.when(F.weekday("ori_date") >= 5, 1).otherwise(0).alias("weekend"),
                   F.when(F.col("_h").isNotNull(), 1).otherwise(0).alias("holiday")))
    # one row a day, however large the data: a few thousand rows in one ordered window
    opened = F.when((F.col("weekend") == 0) & (F.col("holiday") == 0), F.col("ori_date"))
    upto = W.orderBy("ori_date").rowsBetween(W.unboundedPreceding, 0)
    since = W.orderBy("ori_date").rowsBetween(0, W.unboundedFollowing)
    cal = cal.withColumns({"_pre": F.max(opened).over(upto), "_post": F.min(opened).over(since)})
    before = F.coalesce("_pre", "ori_date")
    return (cal.select("ori_date", "weekend", "holiday", before.alias("operation_date"),
                    before.alias("pre_target_date"),
                    F.coalesce("_post", "ori_date").alias("post_target_date")))


def next_weekday(cal: DataFrame, run_dates: DataFrame) -> DataFrame:
    """The first non-weekend day after each run date."""
    week = cal.filter("weekend = 0").select(F.col("ori_date").alias("next_date"),
                                            F.col("holiday").alias("next_is_holiday"))
    near = run_dates.withColumn("_day", F.explode(F.sequence(
        F.date_add("run_date", 1), F.date_add("run_date", 7))))
    hit = near.join(week, F.col("_day") == F.col("next_date"))
    return (hit.groupBy("run_date")
            .agg(F.min(F.struct("next_date", "next_is_holiday")).alias("_n"))
            .select("run_date", "_n.next_date", "_n.next_is_holiday"))


def run_allowed(cal: DataFrame, holidays: DataFrame, run_dates: DataFrame,
                policy: str) -> DataFrame:
    """Which run dates may run.

    ``weekday``: no weekend, no holiday. ``named``: no weekend, no Thanksgiving, Dec 25 or
    Jan 1. ``biweekly``: first and third Wednesday.
    """
    d = run_dates.join(cal, F.col("run_date") == F.col("ori_date"))
    if policy == "weekday":
        ok = (F.col("weekend") + F.col("holiday")) < 1
    elif policy == "named":
        thanks = (holidays.filter(F.col("description").startswith("Thanksgiving"))
                  .select(F.col("holiday").alias("_t")))
        d = d.join(thanks, F.col("run_date") == F.col("_t"), "left")
        fixed = F.date_format("run_date", "MMdd").isin("0101", "1225")
        ok = (F.col("weekend") == 0) & F.col("_t").isNull() & ~fixed
    elif policy == "biweekly":
        week = F.floor((F.dayofmonth("run_date") - 1) / 7) + 1
        ok = (F.weekday("run_date") == 2) & week.isin(1, 3)
    else:
        raise ValueError(f"unknown policy {policy}")
    return d.select("run_date", F.when(ok, 1).otherwise(0).alias("allowed"))


def is_biweekly(day: dt.date) -> bool:
    """First or third Wednesday of the month."""
    return day.weekday() == 2 and (day.day - 1) // 7 + 1 in (1, 3)


def allowed_dates(cal: DataFrame, holidays: DataFrame, run_dates: DataFrame,
                  policy: str) -> DataFrame:
    return run_allowed(cal, holidays, run_dates, policy).filter("allowed = 1").select("run_date")


def due_targets(run_dates: DataFrame, first: int = 3, second: int = 11,
                third: int = 7) -> DataFrame:
    """Three target dates per run date; weekends have none."""
    day = F.weekday("run_date")
    work = day < 5

    def target(n: int, short: Column) -> Column:
        return F.when(work, F.when(short, F.date_add("run_date", n))
                      .otherwise(F.date_add("run_date", n + 2)))
    return run_dates.select("run_date", target(first, day.isin(0, 1)).alias("first_date"),
                            target(second, day == 0).alias("second_date"),
                            F.when(work, F.date_add("run_date", third)).alias("third_date"))


def received_window(cal: DataFrame, run_dates: DataFrame, before: int = 1, after: int = -1,
                    before_early: int | None = None, after_early: int | None = None,
                    ) -> DataFrame:
    """Received window per run date: from the business day ``before`` days back to ``after``.

    The early-week variants apply to Monday and Tuesday (start) and Monday (end).
    """
    day = F.weekday("run_date")
    b = F.lit(before) if before_early is None else F.when(day.isin(2, 3, 4), before).otherwise(
        before_early)
    a = F.lit(after) if after_early is None else F.when(day == 0, after_early).otherwise(after)
    d = (run_dates.filter(day < 5).withColumn("_from", F.date_sub("run_date", b))
         .withColumn("end_date", F.date_add("run_date", a)))
    return (d.join(cal.select("ori_date", "operation_date"), F.col("_from") == F.col("ori_date"))
            .select("run_date", F.col("operation_date").alias("std_date"), "end_date")
            .filter("std_date <= end_date"))


def rollover_dates(cal: DataFrame, holidays: DataFrame, run_dates: DataFrame) -> DataFrame:
    """Business dates to build on each run date: the date itself, and the next weekday when
    that is a holiday on which lists still go out."""
    closed = (holidays.filter(F.col("description").isin(list(NO_RUN_HOLIDAYS)))
              .select(F.col("holiday").alias("_h")))
    extra = (next_weekday(cal, run_dates).filter("next_is_holiday = 1")
             .join(closed, F.col("next_date") == F.col("_h"), "left_anti")
             .select("run_date", F.col("next_date").alias("business_date")))
    return run_dates.select("run_date", F.col("run_date").alias("business_date")).unionByName(extra)


def target_date(df: DataFrame, cal: DataFrame, day: str, after_flag: str, out: str) -> DataFrame:
    """Business day a date moves to: after it when the row's flag is 1, else before."""
    c = cal.select(F.col("ori_date").alias("_o"), "pre_target_date", "post_target_date")
    return (df.join(c, F.to_date(F.col(day)) == F.col("_o"), "left")
            .withColumn(out, F.when(F.col(after_flag) == 1, F.col("post_target_date"))
                        .otherwise(F.col("pre_target_date")))
            .drop("_o", "pre_target_date", "post_target_date"))


def rota(entries: list[tuple[int, str, str]], spark: SparkSession) -> DataFrame:
    """(weekday, group, state) rows of a weekday rota."""
    return spark.createDataFrame(entries, "rota_weekday int, rota_group string, rota_state string")


def weekday_rota(df: DataFrame, table: DataFrame, run_date: str, group: str,
                 state: str) -> DataFrame:
    """Keep rows whose group and state run on the weekday of their run date."""
    cond = ((F.weekday(F.col(run_date)) == F.col("rota_weekday"))
            & (F.col(group) == F.col("rota_group")) & (F.col(state) == F.col("rota_state")))
    return df.join(table, cond, "left_semi")
