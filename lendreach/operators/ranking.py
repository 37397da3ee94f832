"""One row per group, latest rows, numbering.

Ranks filtered to the first row are cut per map task before the shuffle (Spark's window
group limit). Numberings that need a whole group are split by time bucket, so a group that
holds a third of all rows is still spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def pick_one(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One whole row per group, first in a declared order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def latest_per(df: DataFrame, keys: Sequence[str], ts: str, ties: str = "keep",
               order: Sequence[Column] = ()) -> DataFrame:
    """Latest rows per key. ``ties="keep"`` keeps all rows of the last instant."""
    if ties != "keep":
        return pick_one(df, keys, [F.col(ts).desc(), *order])
    w = Window.partitionBy(*keys).orderBy(F.col(ts).desc())
    return (df.filter(F.col(ts).isNotNull())
            .withColumn("_rk", F.rank().over(w)).filter("_rk = 1").drop("_rk"))


def latest_in_runs(df: DataFrame, keys: Sequence[str], day: Column, ts: str, back: int, until: int) -> DataFrame:
    """``first_run`` and ``last_run`` of every row: the run dates on which it is the latest of its key, ties kept.

    A run sees the days [run - back, run - until]. A row is seen from its day + ``until`` to its day + ``back``; a
    later row of an earlier day hides it until that day is out of sight, one of a later day as soon as it is seen.
    So what is left is one span of run dates, and no row is opened into them. Rows that no run takes are left out.
    """
    reach = max(back - until, 0)
    rows = latest_per(df.withColumn("_day", day).filter("_day is not null"), [*keys, "_day"], ts)
    near = (Window.partitionBy(*keys).orderBy(F.unix_date("_day")).rangeBetween(-reach, reach))
    later = F.filter("_near", lambda x: x["ts"] > F.col(ts))
    before = F.array_max(F.transform(F.filter(later, lambda x: x["day"] < F.col("_day")), lambda x: x["day"]))
    after = F.array_min(F.transform(F.filter(later, lambda x: x["day"] > F.col("_day")), lambda x: x["day"]))
    rows = rows.withColumn("_near", F.collect_set(F.struct(F.col("_day").alias("day"), F.col(ts).alias("ts"))).over(near))
    rows = rows.withColumns({
        "first_run": F.greatest(F.date_add("_day", until), F.date_add(before, back + 1)),
        "last_run": F.least(F.date_add("_day", back), F.date_add(after, until - 1))})
    return rows.filter("first_run <= last_run").drop("_day", "_near")


def latest_value(df: DataFrame, keys: Sequence[str], ts: str, tie: str, value: str,
                 out: str) -> DataFrame:
    """Value of the latest row per key; equal times are settled by ``tie``."""
    return df.groupBy(*keys).agg(F.max_by(value, F.struct(ts, tie)).alias(out))


def current_version(df: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """Rows carrying the highest version of their key."""
    return latest_per(df, keys, version, "keep")


def _bucket(ts: str, grain: str) -> Column:
    return F.date_trunc(grain, F.col(ts))


def sequence_number(df: DataFrame, keys: Sequence[str], ts: str, ties: Sequence[str],
                    out: str, grain: str = "day") -> DataFrame:
    """1, 2, 3 ... per key in time order, computed one time bucket at a time.

    Buckets are numbered on their own; each adds the count of the key's earlier buckets. The
    bucket totals are one small row per key and bucket, so the only window over a whole key
    sees at most one row per bucket. Each bucket's count goes in front of its rows as one more row, so the rows
    themselves are moved and sorted once. Rows without a key or time are numbered too.
    """
    rows = df.withColumn("_m", _bucket(ts, grain))
    totals = rows.groupBy(*keys, "_m").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_m").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, "_m", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_o"))
    inside = Window.partitionBy(*keys, "_m").orderBy(F.col("_o").isNull(), ts, *ties)
    numbered = (rows.unionByName(offsets, allowMissingColumns=True).repartition(*keys, "_m")
                .withColumns({"_i": F.row_number().over(inside) - 1, "_s": F.first("_o").over(
                    inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))}))
    return (numbered.filter(F.col("_o").isNull()).withColumn(out, (F.col("_i") + F.col("_s")).cast("int"))
            .drop("_m", "_o", "_i", "_s"))


def bucketed_last(df: DataFrame, keys: Sequence[str], ts: str, values: Sequence[str],
                  grain: str = "day") -> DataFrame:
    """Each value column becomes its last non-null value strictly before the row, computed one
    time bucket at a time. Expects one row per key and time."""
    rows = df.withColumn("_m", _bucket(ts, grain))
    lasts = rows.groupBy(*keys, "_m").agg(*[
        F.max_by(v, F.when(F.col(v).isNotNull(), F.col(ts))).alias(v) for v in values])
    before = Window.partitionBy(*keys).orderBy("_m").rowsBetween(Window.unboundedPreceding, -1)
    carry = lasts.select(*keys, "_m", *[F.last(v, ignorenulls=True).over(before).alias(f"_c_{v}")
                                        for v in values])
    inside = (Window.partitionBy(*keys, "_m").orderBy(ts)
              .rowsBetween(Window.unboundedPreceding, -1))
    near = rows.repartition(*keys, "_m").withColumns(
        {f"_p_{v}": F.last(v, ignorenulls=True).over(inside) for v in values})
    out = near.join(carry, [*keys, "_m"])
    return out.withColumns({v: F.coalesce(f"_p_{v}", f"_c_{v}") for v in values}).drop(
        "_m", *[f"_{x}_{v}" for x in "pc" for v in values])


def last_before(df: DataFrame, keys: Sequence[str], ts: str, values: Sequence[str]) -> DataFrame:
    """The rows of :func:`bucketed_last` by one window a key, for keys that are known to have few rows."""
    before = Window.partitionBy(*keys).orderBy(ts).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumns({v: F.last(v, ignorenulls=True).over(before) for v in values})


def first_payment(items: DataFrame, loan: str, item_id: str, order: Sequence[str]) -> DataFrame:
    """First settled payment per loan, with default, amount and paid flags.

    ``items`` holds settled, non-collection payments only.
    """
    bad = F.col("status").isin("return", "missed")
    paid = F.col("status").isin("cleared", "correction")
    zero = F.lit(0).cast("decimal(18,2)")
    first = pick_one(items, [loan], [F.col(item_id), *[F.col(c) for c in order]])
    return first.select(
        loan, F.col("item_date").alias("debit_date"),
        F.when(bad, 1).otherwise(0).alias("is_defaulted"),
        F.col("total_amount").alias("debit_amount"),
        F.when(bad, F.col("total_amount")).otherwise(zero).alias("uncollected_amount"),
        F.when(bad, F.col("amount_prin")).otherwise(zero).alias("defaulted_principal"),
        F.when(paid, F.col("amount_prin")).otherwise(zero).alias("principal_paid"),
        F.when(paid, F.col("total_amount") - F.col("amount_prin")).otherwise(zero)
        .alias("fees_paid"))


def page_dwell(events: DataFrame, keys: Sequence[str], page: str, ts: str,
               groups: dict[str, str]) -> DataFrame:
    """First and last time and dwell per key and page group; pages outside the map are dropped."""
    pairs = [x for kv in groups.items() for x in (F.lit(kv[0]), F.lit(kv[1]))]
    return (events.withColumn("page_group", F.create_map(*pairs)[F.col(page)])
            .filter("page_group is not null")
            .groupBy(*keys, "page_group")
            .agg(F.min(ts).alias("start_time"), F.max(ts).alias("end_time"))
            .withColumn("seconds_spent",
                        F.timestamp_diff("SECOND", F.col("start_time"), F.col("end_time"))))


def first_visit(visits: DataFrame, keys: Sequence[str], start: str = "start_time") -> DataFrame:
    """The earliest visit per key, ties kept."""
    w = Window.partitionBy(*keys).orderBy(start)
    return visits.withColumn("_rk", F.rank().over(w)).filter("_rk = 1").drop("_rk")


def draw_sequence(items: DataFrame, keys: Sequence[str], until: Column | None = None) -> DataFrame:
    """Number of draws and last draw date per key; draws are negative settled amounts."""
    draws = items.filter((F.col("total_amount") < 0) & F.col("status").isin("cleared", "sent"))
    if until is not None:
        draws = draws.filter(F.col("item_date") <= until)
    return draws.groupBy(*keys).agg(F.max("item_date").alias("last_draw_date"),
                                    F.count("item_date").alias("draw_sequence"))


def cycle_number(items: DataFrame, schedule: str, day: str, qualifies: Column) -> DataFrame:
    """Per schedule and date: how many earlier distinct qualifying dates there are, plus one.

    Dates are made distinct first, so a window group is at most one row per calendar day.
    """
    dates = (items.groupBy(schedule, day)
             .agg(F.max(F.when(qualifies, 1).otherwise(0)).alias("_q")))
    w = (Window.partitionBy(schedule).orderBy(day)
         .rowsBetween(Window.unboundedPreceding, -1))
    return dates.select(schedule, day,
                        (F.coalesce(F.sum("_q").over(w), F.lit(0)) + 1).alias("cycle_number"))


def resolve_codes(log: DataFrame, code: str, email: str, first_ts: str, last_ts: str,
                  tie: str) -> DataFrame:
    """One mail address per code (its first application), then one code per address (its last)."""
    by_code = pick_one(log, [code], [F.col(first_ts), F.col(tie)])
    return pick_one(by_code, [email], [F.col(last_ts).desc(), F.col(tie)])


def top_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)
