"""Grouping: period grouping, duplicate keys, relabelled totals, rates, balances."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendreach.functions.money import rate


def by_period(df: DataFrame, ts: str, aggs: Sequence[Column], grain: str = "year_month",
              extra: Sequence[str] = ()) -> DataFrame:
    """Group by year and month, or by month only (which merges years)."""
    parts = [F.month(ts).alias("received_month")]
    if grain != "month":
        parts.insert(0, F.year(ts).alias("received_year"))
    return df.groupBy(*parts, *extra).agg(*aggs)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("cnt")).filter("cnt > 1")


def rates(df: DataFrame, pairs: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Add quotient columns: name -> (numerator, denominator)."""
    return df.select("*", *[rate(F.col(n), F.col(d)).alias(out) for out, (n, d) in pairs.items()])


def regroup(df: DataFrame, column: str, mapping: DataFrame, out: str,
            default: str | None = "same") -> DataFrame:
    """Map many names to one through a (name, label) table; unmapped names stay or become null."""
    m = mapping.select(F.col("name").alias("_name"), F.col("label").alias("_label"))
    label = F.coalesce("_label", column) if default == "same" else F.col("_label")
    return (df.join(m, F.col(column) == F.col("_name"), "left")
            .withColumn(out, label).drop("_name", "_label"))


def rollup_labels(df: DataFrame, keys: Sequence[str], column: str, mapping: DataFrame,
                  inner: Sequence[Column], outer: Sequence[Column]) -> DataFrame:
    """Group by the raw name, relabel, group again by the label."""
    fine = df.groupBy(*keys, column).agg(*inner)
    return regroup(fine, column, mapping, "label", None).groupBy(*keys, "label").agg(*outer)


def balance(txns: DataFrame, loan: str, amounts: Mapping[str, str]) -> DataFrame:
    """Outstanding amounts per loan (name -> column): transactions summed with the sign turned."""
    return txns.groupBy(loan).agg(*[F.sum(-F.col(c)).alias(out) for out, c in amounts.items()])


def union_distinct(first: DataFrame, *rest: DataFrame) -> DataFrame:
    for df in rest:
        first = first.unionByName(df)
    return first.distinct()


ID_BUCKETS = 4_096


def dense_ids(df: DataFrame, column: str, out: str = "dense_id", known: DataFrame | None = None) -> DataFrame:
    """(column, out): every different value, not null, with a number from 1 without gaps.

    Values are ranked inside hash buckets and shifted by the counts of the buckets before, a table of at most
    ``ID_BUCKETS`` rows, so no task ranks them all. Values in ``known`` (column, out), as an earlier call gave
    them, keep their numbers and new ones go on behind, so that states stored earlier still add up.
    """
    values = df.select(column).filter(F.col(column).isNotNull()).distinct()
    if known is not None:
        values = values.join(known, column, "left_anti")
        last = known.agg(F.coalesce(F.max(out), F.lit(0)).alias("n")).first()["n"]
        fresh = dense_ids(values, column, out)
        return known.select(column, out).unionByName(fresh.withColumn(out, F.col(out) + last))
    values = (values.withColumn("_b", F.pmod(F.xxhash64(column), F.lit(ID_BUCKETS))))
    before = values.groupBy("_b").count().select("_b", F.coalesce(F.sum("count").over(
        Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_o"))
    rank = F.row_number().over(Window.partitionBy("_b").orderBy(column))
    return values.withColumn("_i", rank).join(before, "_b").select(column, (F.col("_i") + F.col("_o")).alias(out))


def distinct_bitmaps(df: DataFrame, number: str, by: Sequence[str], wanted: Mapping[str, Column]) -> DataFrame:
    """(by, _bucket, names): for each condition a bitmap of the numbers it holds for; partial states of exact
    distinct counts, all taken in one pass without a row being multiplied, to be stored and merged."""
    at = F.bitmap_bit_position(F.col(number))
    return df.filter(F.col(number).isNotNull()).groupBy(*by, F.bitmap_bucket_number(F.col(number)).alias("_bucket")).agg(
        *[F.bitmap_construct_agg(F.when(c, at)).alias(n) for n, c in wanted.items()])


def merge_bitmaps(bitmaps: DataFrame, by: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Partial states of wider groups: bits of the same bucket are put together."""
    return bitmaps.groupBy(*by, "_bucket").agg(*[F.bitmap_or_agg(n).alias(n) for n in names])


def bitmap_counts(bitmaps: DataFrame, by: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Exact distinct counts of the groups ``by`` from the partial states of those or of finer groups."""
    return merge_bitmaps(bitmaps, by, names).groupBy(*by).agg(*[F.sum(F.bitmap_count(n)).alias(n) for n in names])
