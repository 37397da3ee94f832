"""Dates, times and durations."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def shift(c: Column, n: int, unit: str) -> Column:
    """Add ``n`` units: days and months keep the type, minutes and hours give a timestamp."""
    if unit == "day":
        return F.date_add(c, n)
    if unit == "month":
        return F.add_months(c, n)
    return F.timestamp_add(unit.upper(), F.lit(n), c)


def elapsed(start: Column, end: Column, unit: str) -> Column:
    """Whole minutes between instants, or whole calendar days."""
    if unit == "day":
        return F.datediff(end, start)
    return F.timestamp_diff(unit.upper(), start, end)


def day_bucket_flags(start: Column, end: Column, suffix: str) -> list[Column]:
    """Same day, 1, 2, 3 and more than 3 days, each as 0/1 (0 when an end is missing)."""
    days = F.datediff(end, start)
    flags = [F.when(days == n, 1).otherwise(0).alias(f"day{n}_{suffix}") for n in range(4)]
    return flags + [F.when(days > 3, 1).otherwise(0).alias(f"day3plus_{suffix}")]


def date_parts(c: Column, prefix: str = "") -> list[Column]:
    return [
        F.year(c).alias(prefix + "year"), F.month(c).alias(prefix + "month"),
        F.dayofmonth(c).alias(prefix + "day"), F.hour(c).alias(prefix + "hour"),
        F.weekday(c).alias(prefix + "weekday"),
        F.date_format(c, "EEEE").alias(prefix + "day_name"),
        F.date_format(c, "MMMM").alias(prefix + "month_name"),
        F.date_format(c, "yyyy MMMM").alias(prefix + "year_month"),
    ]


def week_of_month(c: Column) -> Column:
    return (F.floor((F.dayofmonth(c) - 1) / 7) + 1).cast("int")


def long_date(c: Column, style: str = "mail") -> Column:
    """``notice``: Monday , March 5 , 2020; ``mail``: March 5, 2020."""
    return F.date_format(c, "EEEE , MMMM d , yyyy" if style == "notice" else "MMMM d, yyyy")


def dwell_seconds(start: Column, end: Column) -> Column:
    return F.timestamp_diff("SECOND", start, end)


def hour_between(ts: Column, lo: int, hi: int) -> Column:
    """Hour of day within [lo, hi]."""
    return F.hour(ts).between(lo, hi)


def call_centre_open(ts: Column) -> Column:
    """1 on weekdays 8h to 22h and weekends 11h to 18h."""
    day, hour = F.weekday(ts), F.hour(ts)
    return F.when((day <= 4) & hour.between(8, 22), 1).when(
        (day >= 5) & hour.between(11, 18), 1).otherwise(0)


def delinquency_due(days: Column, run_date: Column) -> Column:
    """Eleven days late; a Monday run also takes what fell due over the weekend."""
    return F.when(F.weekday(run_date) == 0, days.isin(11, 12, 13)).otherwise(days == 11)


def instant(day: dt.date) -> Column:
    """First instant of a day, as a zone-free timestamp."""
    return F.lit(dt.datetime.combine(day, dt.time())).cast("timestamp_ntz")


def within_days(c: Column, first: dt.date | None = None, last: dt.date | None = None) -> Column:
    """Time falls on a day in [first, last]; compares the bare column, so scans can skip files."""
    keep = F.lit(True)
    if first is not None:
        keep = keep & (c >= instant(first))
    if last is not None:
        keep = keep & (c < instant(last + dt.timedelta(days=1)))
    return keep
