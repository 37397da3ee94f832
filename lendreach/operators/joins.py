"""Joins. None hints a broadcast: Spark broadcasts a side only when its own size
estimate (or, at run time, its measured size) is under the threshold, and sorts or
splits otherwise. Every join here has an equality key, so it stays hashable."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendreach.functions.dates import within_days
from lendreach.operators.ranking import bucketed_last, pick_one

SALTS = 16
MAX_BUCKET = 6 * 3600


@dataclass(frozen=True)
class Lookup:
    """A right side for :func:`enrich`: key columns, carried columns, order for one row per key."""

    df: DataFrame
    on: Sequence[str]
    take: Sequence[str]
    order: Sequence[Column] = field(default_factory=tuple)
    unique: bool = False


def enrich(base: DataFrame, lookups: Sequence[Lookup]) -> DataFrame:
    """Chain of left joins that cannot multiply the base."""
    for look in lookups:
        right = look.df.select(*look.on, *look.take)
        if not look.unique:
            right = pick_one(look.df, look.on, look.order).select(*look.on, *look.take)
        base = base.join(right, list(look.on), "left")
    return base


def with_root_id(df: DataFrame, own: str = "id", original: str = "original_id",
                 out: str = "root_id") -> DataFrame:
    """The first loan of a renewal chain: its own id when ``original`` is 0."""
    return df.withColumn(out, F.when(F.col(original) == 0, F.col(own)).otherwise(F.col(original)))


def exclude(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys are made distinct first: a key with very many rows then ships one per map task,
    and the join re-uses that shuffle."""
    return df.join(other.select(*keys).distinct(), list(keys), "left_anti")


def keep_in(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.join(other.select(*keys).distinct(), list(keys), "left_semi")


def exclude_later(df: DataFrame, other: DataFrame, key: str, base_date: Column,
                  other_date: Column) -> DataFrame:
    """Drop rows whose key has any ``other`` row dated on or after the row's own date.

    Only the latest date per key matters, so ``other`` is reduced before the shuffle.
    """
    latest = (other.groupBy(F.col(key).alias("_k")).agg(F.max(other_date).alias("_d")))
    left = df.withColumn("_b", base_date)
    return left.join(latest, (left[key] == latest["_k"]) & (latest["_d"] >= left["_b"]),
                     "left_anti").drop("_b")


def exclude_cross_system(df: DataFrame, apps: DataFrame, email: str, system: str,
                         base_date: Column, active_date: Column) -> DataFrame:
    """Drop rows whose mail address is active on or after ``base_date`` in another system."""
    latest = (apps.groupBy(F.lower(F.col(email)).alias("_e"), F.col(system).alias("_s"))
              .agg(F.max(active_date).alias("_d")).filter("_d is not null"))
    left = df.withColumn("_b", base_date)
    cond = ((F.lower(left[email]) == latest["_e"]) & (left[system] != latest["_s"])
            & (latest["_d"] >= left["_b"]))
    return left.join(latest, cond, "left_anti").drop("_b")


def lookup_one(df: DataFrame, dim: DataFrame, on: Sequence[str], value: str,
               order: Sequence[Column]) -> DataFrame:
    """Scalar lookup: the first value per key in a declared order."""
    return df.join(pick_one(dim, on, order).select(*on, value), list(on), "left")


def link_sequence(df: DataFrame, keys: Sequence[str], seq: str, step: int,
                  take: Sequence[str], prefix: str, how: str = "left") -> DataFrame:
    """Attach columns of the row ``step`` places along in the same sequence."""
    other = df.select(*[F.col(k).alias(f"_{k}") for k in keys], (F.col(seq) - step).alias("_seq"),
                      *[F.col(c).alias(prefix + c) for c in take])
    cond = F.col(seq) == F.col("_seq")
    for k in keys:
        cond = cond & (F.col(k) == F.col(f"_{k}"))
    return df.join(other, cond, how).drop("_seq", *[f"_{k}" for k in keys])


def _days_in(start: Column, end: Column) -> Column:
    return F.explode(F.sequence(start, end))


def in_windows(df: DataFrame, day: Column, windows: DataFrame, start: str, end: str) -> DataFrame:
    """Rows whose day lies in a window, once per window (back-fills pass many windows).

    Windows are opened into days first: a plain equality join, no range comparison. A window that
    ends before it starts, or has no start or end, holds no day.
    """
    days = windows.filter(F.col(start) <= F.col(end)).withColumn("_day", _days_in(F.col(start), F.col(end)))
    return df.withColumn("_day", day).join(days, "_day").drop("_day")


def bounded(df: DataFrame, column: str, rows: DataFrame, start: str, end: str) -> DataFrame:
    """Rows whose bare time column lies between the first ``start`` and the last ``end`` day of ``rows``.

    ``rows`` is a table of run dates or windows. Its two extremes become literals, so that the limit
    reaches the scan; the exact match is left to the join that follows.
    """
    lo, hi = rows.agg(F.min(start), F.max(end)).first()
    if lo is None or hi is None:
        return df.filter(F.lit(False))
    return df.filter(within_days(F.col(column), lo, hi))


def interval_join(a: DataFrame, events: DataFrame, key: str, a_ts: str, e_ts: str,
                  lo_minutes: int, hi_minutes: int) -> DataFrame:
    """Events of the same key within [a_ts + lo, a_ts + hi].

    The key is joined together with a time bucket as wide as the interval, at most six hours,
    so the events of one very active key spread over many partitions.
    """
    width = min(max((hi_minutes - lo_minutes) * 60, 60), MAX_BUCKET)

    def bucket(c: Column) -> Column:
        return F.floor(F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), c)
                       / width)
    left = (a.withColumn("_lo", F.timestamp_add("MINUTE", F.lit(lo_minutes), F.col(a_ts)))
            .withColumn("_hi", F.timestamp_add("MINUTE", F.lit(hi_minutes), F.col(a_ts)))
            .withColumn("_b", F.explode(F.sequence(bucket(F.col("_lo")), bucket(F.col("_hi"))))))
    right = events.withColumn("_b", bucket(F.col(e_ts)))
    hit = (left.join(right, [key, "_b"])
           .filter(F.col(e_ts).between(F.col("_lo"), F.col("_hi"))))
    return hit.drop("_b", "_lo", "_hi")


def pattern_range_join(a: DataFrame, dim: DataFrame, code: str, pattern: str, day: Column,
                       start: str, end: str, pad_before: int = 0, pad_after: int = 0,
                       key_len: int = 3) -> DataFrame:
    """Rows whose code is LIKE a pattern and whose day lies in the padded window.

    Keys: the first ``key_len`` letters and the month, salted, as many codes share few beginnings:
    each pattern goes to every salt, each code to one. Patterns that start with fewer plain letters
    (a leading wildcard, say) meet every code of the month. A mapping whose padded window ends before
    it starts matches nothing.
    """
    plain = F.regexp_extract(F.lower(F.trim(F.col(pattern))), r"^[^%_]*", 0)
    narrow = F.length(plain) >= key_len
    d = (dim.withColumn("_from", F.date_sub(F.col(start), pad_before))
         .withColumn("_to", F.date_add(F.col(end), pad_after))
         .filter("_from <= _to")
         .withColumn("_pat", F.lower(F.trim(F.col(pattern))))
         .withColumn("_key", F.when(narrow, F.substring(plain, 1, key_len)).otherwise(""))
         .withColumn("_m", F.explode(F.sequence(F.trunc("_from", "month"), F.trunc("_to", "month"),
                                                F.expr("interval 1 month"))))
         .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))))
    text = F.lower(F.col(code))
    salt = F.pmod(F.xxhash64(code, day), F.lit(SALTS)).cast("int")
    left = (a.withColumn("_day", day).withColumn("_m", F.trunc("_day", "month"))
            .withColumn("_slot", F.explode(F.array(
                F.struct(F.substring(text, 1, key_len).alias("_key"), salt.alias("_salt")),
                F.struct(F.lit("").alias("_key"), salt.alias("_salt")))))
            .select("*", "_slot._key", "_slot._salt").drop("_slot"))
    hit = left.join(d, ["_key", "_m", "_salt"]).filter(
        F.like(text, F.col("_pat")) & F.col("_day").between(F.col("_from"), F.col("_to")))
    return hit.drop("_key", "_m", "_salt", "_pat", "_from", "_to", "_day")


def _grams(text: Column, least: int = 1, most: int = 3) -> Column:
    """All different runs of ``least`` to ``most`` characters."""
    n = F.length(text)

    def of(k: int) -> Column:
        return F.when(n >= k, F.transform(F.sequence(F.lit(1), n - k + 1), lambda i: F.substr(text, i, F.lit(k)))
                      ).otherwise(F.array().cast("array<string>"))
    runs = [of(k) for k in range(least, most + 1)]
    return F.array_distinct(F.concat(*runs))


def pattern_index(codes: DataFrame, dim: DataFrame, code: str, pattern: str, key: str) -> DataFrame:
    """(code, key): which different codes are LIKE which patterns, wherever the wildcards stand.

    Codes and patterns carry marks for their beginning and end; a pattern is looked up through its rarest run of
    three plain characters (of two or one where it has none of three) among the codes, counted over their index
    lists, and only the codes in that list are compared. Lists are kept for the runs that some pattern has, and a
    code is compared with a pattern once. A pattern without a plain character meets every code, as it must.
    Patterns and codes are compared trimmed (patterns) and in lower case; null ones match nothing.
    """
    begin, end = "\x02", "\x03"
    plain = F.filter(F.split(F.concat(F.lit(begin), F.col("_pat"), F.lit(end)), "[%_]"), lambda x: F.length(x) > 0)
    pats = (dim.filter(F.col(pattern).isNotNull()).select(F.lower(F.trim(F.col(pattern))).alias("_pat")).distinct()
            .withColumn("_gram", F.explode(F.array_distinct(F.flatten(F.transform(plain, lambda x: _grams(x)))))))
    # a backslash changes what the next character means: such patterns meet every code
    pats = pats.withColumn("_gram", F.when(F.contains("_pat", F.lit("\\")), begin).otherwise(F.col("_gram"))).distinct()
    words = codes.select(F.col(code).alias("_code")).filter(F.col(code).isNotNull()).distinct()
    marked = F.concat(F.lit(begin), F.lower("_code"), F.lit(end))
    wanted = pats.select("_gram").distinct()
    lists = words.withColumn("_gram", F.explode(_grams(marked))).join(wanted, "_gram", "left_semi")
    sizes = lists.groupBy("_gram").agg(F.count("*").alias("_n"))
    # a run that no code has proves that the pattern matches nothing, so the inner join may drop its other runs
    best = pick_one(pats.join(sizes, "_gram", "left").fillna(0, ["_n"]), ["_pat"],
                    [F.least(F.length("_gram"), F.lit(3)).desc(), F.col("_n"), F.col("_gram")])
    hit = lists.join(best.filter("_n > 0").select("_gram", "_pat"), "_gram").filter(F.like(F.lower("_code"), F.col("_pat")))
    keys = dim.select(F.lower(F.trim(F.col(pattern))).alias("_pat"), key)
    return hit.select("_code", "_pat").join(keys, "_pat").select(F.col("_code").alias(code), key)


def pattern_index_join(a: DataFrame, dim: DataFrame, code: str, pattern: str, key: str, day: Column, start: str,
                       end: str, pad_before: int = 0, pad_after: int = 0) -> DataFrame:
    """The rows of :func:`pattern_range_join`, for patterns with wildcards anywhere: each different code meets
    the patterns once, through their index lists, and rows then join the pairs by code."""
    pairs = pattern_index(a, dim, code, pattern, key).withColumnRenamed(code, "_code")
    spans = dim.withColumn("_from", F.date_sub(F.col(start), pad_before)).withColumn("_to", F.date_add(F.col(end), pad_after))
    pairs = pairs.join(spans, key)
    return (a.withColumn("_day", day).join(pairs, F.col(code) == F.col("_code"))
            .filter(F.col("_day").between(F.col("_from"), F.col("_to"))).drop("_day", "_from", "_to", "_code"))


def first_match(a: DataFrame, dim: DataFrame, row_keys: Sequence[str], order: Sequence[Column],
                take: Sequence[str], **kwargs) -> DataFrame:
    """First pattern-range match per row in a declared order; rows without one keep nulls."""
    hit = pattern_range_join(a, dim, **kwargs)
    best = pick_one(hit, row_keys, order).select(*row_keys, *take)
    return a.join(best, list(row_keys), "left")


def asof_previous(df: DataFrame, keys: Sequence[str], ts: str,
                  wanted: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Latest earlier values: for each name, the value of the most recent row of its history
    (same keys, strictly before ``ts``).

    One value per key and time is kept (the largest). All histories share one pass, which
    carries values forward by time bucket so that no key is sorted in one task. ``df`` is read
    twice; call this before it has been enriched.
    """
    names = list(wanted)
    marks = df.select(*keys, ts, F.lit(1).alias("_w"))
    for name, (history, value) in wanted.items():
        marks = marks.unionByName(history.select(*keys, ts, F.col(value).alias(name)), allowMissingColumns=True)
    marks = marks.groupBy(*keys, ts).agg(F.max("_w").alias("_w"),
                                         *[F.max(n).alias(n) for n in names])
    filled = bucketed_last(marks, keys, ts, names).filter("_w = 1").select(*keys, ts, *names)
    return df.join(filled, [*keys, ts], "left")


def join_sparse(df: DataFrame, right: DataFrame, key: str, row: str | Column) -> DataFrame:
    """Left join on a key that is null in many rows.

    Null keys never match but would all hash to one partition; a second part of the join key, made from the
    row's id where the key is null and 0 elsewhere, spreads them. Both parts are compared as one struct: a bare 0
    on the right is a constant to Spark, which takes it out of the join's keys. ``right`` has one row per key.
    """
    spread = F.when(F.col(key).isNull(), F.xxhash64(row)).otherwise(F.lit(0).cast("bigint"))
    other = right.filter(F.col(key).isNotNull()).withColumnRenamed(key, "_key").withColumn(
        "_there", F.struct(F.col("_key"), F.lit(0).cast("bigint").alias("_spread")))
    left = df.withColumn("_here", F.struct(F.col(key).alias("_key"), spread.alias("_spread")))
    return left.join(other, F.col("_here") == F.col("_there"), "left").drop("_key", "_here", "_there")


CALL_DAYS = 16


def match_calls(lst: DataFrame, calls: DataFrame, phone: str, called: str, call_ts: str,
                start: str, end: str, not_before: str | None = None) -> DataFrame:
    """First call per list row on a cleaned number within [start, end] days, and not before the row's
    ``not_before`` instant where one is named.

    Calls are gathered per number and day, days per number and block of ``CALL_DAYS``, before the join, so a list
    row meets the few blocks of its days instead of every day. List rows that are equal in every column come out
    as often as they went in.
    """
    def block(day: Column) -> Column:
        return F.floor(F.unix_date(day) / CALL_DAYS)
    times = F.collect_set(call_ts) if not_before else F.array(F.min(call_ts))
    blocks = (calls.withColumn("_phone", F.regexp_replace(F.col(called), "[^0-9]", ""))
              .groupBy("_phone", F.to_date(call_ts).alias("_day")).agg(times.alias("_times"))
              .groupBy("_phone", block(F.col("_day")).alias("_block"))
              .agg(F.flatten(F.collect_list("_times")).alias("_times"))
              .select(F.when(F.col("_phone").isNotNull() & F.col("_block").isNotNull(),
                             F.struct("_phone", "_block")).alias("_call_key"), "_times"))
    there = F.when(F.col(start) <= F.col(end), F.sequence(block(F.col(start)), block(F.col(end))))
    left = (lst.withColumn("_phone", F.regexp_replace(F.col(phone), "[^0-9]", ""))
            .select("*", F.posexplode_outer(there).alias("_place", "_block"))
            .withColumn("_call_key", F.when(F.col("_phone").isNotNull() & F.col("_block").isNotNull(),
                                            F.struct("_phone", "_block"))))

    def hit(t: Column) -> Column:
        inside = F.to_date(t).between(F.col(start), F.col(end))
        return inside & (t >= F.col(not_before)) if not_before else inside
    return (join_sparse(left, blocks, "_call_key", F.struct(*lst.columns, "_block"))
            .withColumn("_first", F.array_min(F.filter("_times", hit)))
            .groupBy(*lst.columns).agg(F.min("_first").alias("first_called_time"),
                                       F.count_if(F.coalesce("_place", F.lit(0)) == 0).alias("_copies"))
            .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "_copies")))
            .drop("_copy", "_copies"))
