"""Column functions on literal rows, with the awkward cases."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lendreach.functions import dates, flags, money, text


def values(spark, schema, rows, *cols):
    df = spark.createDataFrame(rows, schema)
    return [tuple(r) for r in df.select(*cols).collect()]


def test_name_case_is_one_rule_for_the_whole_text(spark):
    got = values(spark, "a string", [("mARY ann",), ("",), (None,)], text.name_case(F.col("a")))
    assert got == [("Mary ann",), ("",), (None,)]


def test_full_name_is_null_when_a_part_is(spark):
    got = values(spark, "a string, b string", [("ann", "LEE"), (None, "LEE")],
                 text.full_name(F.col("a"), F.col("b")))
    assert got == [("Ann Lee",), (None,)]


def test_domain_is_read_after_the_last_at_sign(spark):
    rows = [("a.b.c@Internal.example.com",), ("a@b@example.com",), ("nobody",), (None,)]
    assert values(spark, "e string", rows, text.email_domain(F.col("e"))) == [
        ("internal.example.com",), ("example.com",), (None,), (None,)]


def test_external_email_catches_dotted_local_parts(spark):
    df = spark.createDataFrame([("a.b@internal.example.com",), ("x@seed9.example.com",),
                                ("x@mail.example.com",)], "e string")
    keep = df.filter(text.external_email(F.col("e"), ["internal.example.com"], ["seed"]))
    assert [r.e for r in keep.collect()] == ["x@mail.example.com"]


def test_usd_and_padding(spark):
    got = values(spark, "m decimal(18,2), i bigint", [(Decimal("1234.50"), 12), (Decimal("-3.00"), 123456789)],
                 text.usd(F.col("m")), text.pad_id(F.col("i")))
    assert got == [("$1234.50", "0000012"), ("$-3.00", "1234567")]


def test_clean_money_gives_null_for_text(spark):
    got = values(spark, "t string", [("$1,234.5",), ("n/a",), (None,)], text.clean_money(F.col("t")))
    assert got == [(Decimal("1234.50"),), (None,), (None,)]


def test_norm_key_strips_zeros(spark):
    assert values(spark, "k string", [("000120",), ("x",)], text.norm_key(F.col("k"))) == [(120,), (None,)]


def test_changed_flag_is_null_safe_and_reads_the_last_part(spark):
    rows = [("a:12", "12"), (None, ""), (None, None), ("1", "2"), ("x:1", "y:1")]
    got = values(spark, "a string, b string", rows, text.changed_flag(F.col("a"), F.col("b")))
    assert [g[0] for g in got] == [0, 0, 0, 1, 0]


@pytest.mark.parametrize("row,label", [
    ((1, 1, 0, 0), "RC"), ((0, 0, 0, 0), "BV"), ((0, None, 0, 0), "BV"), ((0, 1, 1, 0), "BV"),
    ((0, 1, 0, 0), "NBV"), ((0, 1, None, None), None)])
def test_bank_verification(spark, row, label):
    got = values(spark, "r int, n int, a int, b int", [row], text.bank_verification(
        F.col("r"), F.col("n"), F.col("a"), F.col("b")))
    assert got == [(label,)]


def test_job_id_takes_the_first_matching_case(spark):
    d = dt.date(2020, 3, 5)
    got = values(spark, "s string, d date", [("TN", d), ("TX", d)], text.job_id(
        F.col("d"), [(F.col("s") == "TN", "ALOC", "DDR")], ("INS", "DDR")))
    assert got == [("ALOC03052020DDR",), ("INS03052020DDR",)]


def test_recency_borders(spark):
    got = values(spark, "d int", [(45,), (46,), (180,), (181,), (None,)], money.recency_group(F.col("d")))
    assert [g[0] for g in got] == ["GC Active", "GC Engaged", "GC Engaged", "GC Dormant", None]


def test_capped_is_null_when_either_side_is(spark):
    got = values(spark, "a double, b double", [(5.0, 3.0), (None, 3.0), (5.0, None)],
                 money.capped(F.col("a"), F.col("b")))
    assert got == [(3.0,), (None,), (None,)]


def test_max_limit_defaults_without_a_rate(spark):
    got = values(spark, "p decimal(18,2), r decimal(18,2), c decimal(18,2)",
                 [(Decimal(1000), Decimal("0.33"), Decimal(500)), (Decimal(1000), None, None),
                  (Decimal(9000), Decimal("0.33"), Decimal(500))],
                 money.max_limit(F.col("p"), F.col("r"), F.col("c")))
    assert got == [(350.0,), (1000.0,), (500.0,)]


def test_credit_bands_partition_the_range(spark):
    rows = [(Decimal(n), Decimal(100)) for n in range(0, 130)]
    got = values(spark, "a decimal(18,2), l decimal(18,2)", rows,
                 money.credit_band(F.col("a"), F.col("l"), 60))
    want = ["<60%"] * 60 + sum([[f"{p}%-{p + 9}%"] * 10 for p in range(60, 100, 10)], []) + ["100%"] * 30
    assert [g[0] for g in got] == want


def test_bid_band_borders(spark):
    got = values(spark, "b double", [(10.0,), (10.5,), (40.0,), (40.01,), (None,)], money.bid_band(F.col("b")))
    assert [g[0] for g in got] == ["$3-$10", "$11-$20", "$31-$40", "$41+", None]


def test_rate_with_zero_denominator_is_null(spark):
    assert values(spark, "a int, b int", [(1, 0), (1, 2), (1, None)], money.rate(F.col("a"), F.col("b"))) == [
        (None,), (0.5,), (None,)]


def test_optin_drops_unknown_answers(spark):
    df = spark.createDataFrame([(0,), (1,), (None,)], "o int")
    assert df.filter(flags.optin_filter(F.col("o"), False)).count() == 2
    assert df.filter(flags.optin_filter(F.col("o"), True)).count() == 1


def test_carve_out_keeps_unknown_places(spark):
    df = spark.createDataFrame([("CA", "SEP"), ("CA", None), (None, "SEP"), ("TX", "SEP")], "s string, p string")
    keep = df.filter(flags.carve_out(F.col("s"), F.col("p"), [(("CA",), ("SEP",))]))
    assert keep.count() == 3


def test_usable_phone_falls_back(spark):
    rows = [("9999999999", "h"), (" ", "h"), (None, "h"), ("5551234567", "h")]
    got = values(spark, "c string, h string", rows, flags.usable_phone(F.col("c"), F.col("h"), ["9999999999"]))
    assert [g[0] for g in got] == ["h", "h", "h", "5551234567"]


def test_delinquency_on_monday_takes_the_weekend(spark):
    mon, tue = dt.date(2020, 2, 3), dt.date(2020, 2, 4)
    df = spark.createDataFrame([(d, r) for d in (10, 11, 12, 13, 14) for r in (mon, tue)], "n int, r date")
    got = df.filter(dates.delinquency_due(F.col("n"), F.col("r"))).orderBy("r", "n").collect()
    assert [(r.n, r.r) for r in got] == [(11, mon), (12, mon), (13, mon), (11, tue)]


def test_week_of_month_and_long_dates(spark):
    got = values(spark, "d date", [(dt.date(2020, 3, 5),), (dt.date(2020, 3, 29),)],
                 dates.week_of_month(F.col("d")), dates.long_date(F.col("d"), "notice"),
                 dates.long_date(F.col("d")))
    assert got[0] == (1, "Thursday , March 5 , 2020", "March 5, 2020") and got[1][0] == 5


def test_call_centre_hours(spark):
    t = [dt.datetime(2020, 2, 3, 22), dt.datetime(2020, 2, 3, 23), dt.datetime(2020, 2, 1, 11),
         dt.datetime(2020, 2, 1, 19)]
    df = spark.createDataFrame([(x,) for x in t], "t timestamp_ntz")
    assert [r[0] for r in df.select(dates.call_centre_open(F.col("t"))).collect()] == [1, 0, 1, 0]


def test_day_buckets_are_zero_without_an_end(spark):
    a = dt.datetime(2020, 1, 1, 23)
    ends = [dt.datetime(2020, 1, 1, 23, 59), dt.datetime(2020, 1, 2), dt.datetime(2020, 1, 5), None]
    got = values(spark, "a timestamp_ntz, b timestamp_ntz", [(a, b) for b in ends],
                 *dates.day_bucket_flags(F.col("a"), F.col("b"), "x"))
    assert got == [(1, 0, 0, 0, 0), (0, 1, 0, 0, 0), (0, 0, 0, 0, 1), (0, 0, 0, 0, 0)]
