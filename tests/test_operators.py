"""Operators on small hand-made tables: ties, null keys, hot keys, borders, re-runs."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lendreach.context import RunContext
from lendreach.operators import aggregates, calendar, consent, history, joins, limits, ranking
from lendreach.plans import abandoned, credit_line, measure
from lendreach.sources import writers
from lendreach.sources.catalog import snake_name
from lendreach.sources.schemas import TABLES
from lendreach.session import fresh_path

T0 = dt.datetime(2020, 1, 1)


def rows(df, *cols):
    return sorted(tuple(r) for r in (df.select(*cols) if cols else df).collect())


def hot(n=4000, seed=3):
    """A third of all rows belong to one key; times repeat."""
    rnd = random.Random(seed)
    return [(1 if rnd.random() < 0.34 else rnd.randint(2, 200), i,
             T0 + dt.timedelta(minutes=rnd.randint(0, 200_000))) for i in range(n)]


def test_anti_and_semi_make_the_input_even_with_null_keys(spark):
    df = spark.createDataFrame([(1,), (2,), (None,), (2,)], "k int")
    other = spark.createDataFrame([(2,), (None,), (2,)], "k int")
    assert rows(joins.keep_in(df, other, ["k"])) == [(2,), (2,)]
    left = joins.exclude(df, other, ["k"])
    assert left.count() == 2 and left.count() + joins.keep_in(df, other, ["k"]).count() == df.count()


def test_exclude_later_counts_the_same_day(spark):
    d = dt.date(2020, 1, 5)
    base = spark.createDataFrame([(1, d), (2, d), (3, d)], "k int, d date")
    other = spark.createDataFrame([(1, d), (2, d - dt.timedelta(1)), (2, d - dt.timedelta(9))], "k int, d date")
    assert rows(joins.exclude_later(base, other, "k", F.col("d"), F.col("d")), "k") == [(2,), (3,)]


def test_join_sparse_matches_a_plain_left_join(spark):
    df = spark.createDataFrame([(i, i if i % 3 == 0 else None) for i in range(30)], "row bigint, key bigint")
    right = spark.createDataFrame([(k, k * 10) for k in range(0, 30, 6)], "key bigint, v bigint")
    plain = df.join(right, "key", "left").select("row", "v")
    assert rows(joins.join_sparse(df, right, "key", "row").select("row", F.coalesce("v", F.lit(-1)))) == \
        rows(plain.select("row", F.coalesce("v", F.lit(-1))))


def test_sequence_number_on_a_hot_key(spark):
    odd = [(None, 9001, T0), (None, 9002, T0), (1, 9003, None)]
    df = spark.createDataFrame(hot() + odd, "k int, id int, t timestamp_ntz")
    w = Window.partitionBy("k").orderBy("t", "id")
    want = rows(df.withColumn("n", F.row_number().over(w)), "id", "n")
    assert rows(ranking.sequence_number(df, ["k"], "t", ["id"], "n"), "id", "n") == want


def test_asof_previous_against_brute_force(spark):
    data = hot(1500)
    hist = [(k, t + dt.timedelta(minutes=7), i) for k, i, t in hot(1500, 9) if i % 2]
    df = spark.createDataFrame(data, "k int, id int, t timestamp_ntz")
    h = spark.createDataFrame(hist, "k int, t timestamp_ntz, v int")
    got = {r.id: r.prev for r in joins.asof_previous(df, ["k"], "t", {"prev": (h, "v")}).collect()}
    by_key = {}
    for k, t, v in hist:
        by_key.setdefault(k, {}).setdefault(t, []).append(v)
    for k, i, t in data:
        older = [x for x in by_key.get(k, {}) if x < t]
        assert got[i] == (max(by_key[k][max(older)]) if older else None)


def test_interval_join_against_brute_force(spark):
    a = [(k, i, t) for k, i, t in hot(300)]
    e = [(k, i, t) for k, i, t in hot(900, 5)]
    got = rows(joins.interval_join(spark.createDataFrame(a, "k int, ai int, at timestamp_ntz"),
                                   spark.createDataFrame(e, "k int, ei int, et timestamp_ntz"),
                                   "k", "at", "et", -60, 3000), "ai", "ei")
    lo, hi = dt.timedelta(minutes=-60), dt.timedelta(minutes=3000)
    want = sorted((ai, ei) for k, ai, at in a for k2, ei, et in e if k == k2 and at + lo <= et <= at + hi)
    assert got == want and want


def test_pattern_join_with_wildcards_blanks_and_padding(spark):
    d = dt.date(2020, 1, 31)
    a = spark.createDataFrame([(1, "MKT0001", d), (2, "mkt2", d + dt.timedelta(6)), (3, "XKT9", d), (4, "A", d)],
                              "id int, code string, day date")
    dim = spark.createDataFrame([("p", " MKT% ", d - dt.timedelta(9), d), ("q", "%KT_", d, d), ("r", "A", d, d)],
                                "name string, pat string, s date, e date")
    got = rows(joins.pattern_range_join(a, dim, "code", "pat", F.col("day"), "s", "e", 0, 5), "id", "name")
    assert got == [(1, "p"), (3, "q"), (4, "r")]
    again = rows(joins.pattern_range_join(a, dim, "code", "pat", F.col("day"), "s", "e", 0, 6), "id", "name")
    assert again == [(1, "p"), (2, "p"), (2, "q"), (3, "q"), (4, "r")]


def test_latest_keeps_or_settles_ties(spark):
    df = spark.createDataFrame([(1, 1, T0), (1, 2, T0), (1, 3, T0 - dt.timedelta(1)), (2, 4, None)],
                               "k int, id int, t timestamp_ntz")
    assert rows(ranking.latest_per(df, ["k"], "t"), "id") == [(1,), (2,)]
    assert rows(ranking.latest_per(df, ["k"], "t", "one", [F.col("id").desc()]).filter("k = 1"), "id") == [(2,)]


def test_resolve_codes(spark):
    log = spark.createDataFrame([
        ("c1", "a@x", T0, T0, 1), ("c1", "b@x", T0 + dt.timedelta(1), T0 + dt.timedelta(1), 2),
        ("c2", "a@x", T0 + dt.timedelta(2), T0 + dt.timedelta(2), 3)],
        "code string, email string, made timestamp_ntz, valid timestamp_ntz, id int")
    got = ranking.resolve_codes(log, "code", "email", "made", "valid", "id")
    assert rows(got, "email", "code") == [("a@x", "c2")]


def test_cycle_number_counts_distinct_earlier_dates(spark):
    d = [dt.date(2020, 1, n) for n in (1, 1, 2, 3)]
    items = spark.createDataFrame([(1, x, s) for x, s in zip(d, ("sent", "sent", "scheduled", "scheduled"))],
                                  "ps int, day date, status string")
    got = ranking.cycle_number(items, "ps", "day", F.col("status") == "sent")
    assert rows(got, "day", "cycle_number") == [(d[0], 1), (d[2], 2), (d[3], 2)]


def test_upsert_is_idempotent(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    s = spark.createDataFrame([(2, "B"), (3, "c")], "k int, v string")
    once = history.upsert(t, s, ["k"])
    assert rows(once) == [(1, "a"), (2, "B"), (3, "c")] == rows(history.upsert(once, s, ["k"]))


def test_update_leaves_unmatched_and_unselected_rows(spark):
    t = spark.createDataFrame([(1, "x", "old"), (2, "x", "old"), (3, "y", "old")], "k int, g string, v string")
    s = spark.createDataFrame([(1, None), (3, "new")], "k int, v string")
    got = history.update_from(t, s, ["k"], ["v"], F.col("g") == "x")
    assert {r.k: r.v for r in got.collect()} == {1: None, 2: "old", 3: "old"}


def test_unknown_columns_fail(spark):
    df = spark.createDataFrame([(1, 2)], "lms_customer_id bigint, surprise int")
    with pytest.raises(ValueError):
        writers.conform(df, TABLES["campaign_history"])
    with pytest.raises(ValueError):
        history.map_load(df, {"surprise": "surprise"}, TABLES["campaign_history"])


def test_seed_rows_carry_sentinels(spark):
    lst = writers.conform(spark.createDataFrame([(5,)], "lms_customer_id bigint"), TABLES["campaign_history"])
    seeds = spark.createDataFrame([("s@example.com", "S", "T", Decimal(1), Decimal(2), "c", 1),
                                   ("off@example.com", "S", "T", Decimal(1), Decimal(2), "c", 0)],
                                  TABLES["campaign_list_test_email"])
    got = history.with_seed_rows(lst, seeds, {"list_module": "PA"}).filter("lms_customer_id = -9").collect()
    assert [(r.email, r.state, r.loan_sequence, r.list_module) for r in got] == [("s@example.com", "test", -9, "PA")]


def test_running_a_list_again_changes_nothing(spark):
    path = fresh_path(spark, "rerun")
    cols = "lms_customer_id bigint, business_date date, list_module string"
    a = spark.createDataFrame([(1, dt.date(2020, 1, 1), "PA"), (2, dt.date(2020, 1, 1), "WAD")], cols)
    for _ in range(3):
        writers.replace_run(writers.gathered(a), path)
    writers.replace_run(a.filter("list_module = 'PA'").withColumn("lms_customer_id", F.lit(9).cast("bigint")), path)
    assert rows(spark.read.parquet(path), "lms_customer_id", "list_module") == [(2, "WAD"), (9, "PA")]


def test_audit_counts_and_errors(spark):
    ctx = RunContext(T0)
    df, obs = history.audited(spark.range(7).toDF("n"), "n7")
    writers.overwrite(df, fresh_path(spark, "audit"))
    ok = history.audit_row(df, ctx, "p", "l", "Insert", obs.get["rows"]).first()
    bad = history.audit_row(df, ctx, "p", "l", "Insert", None, "boom").first()
    assert ok.message.endswith("= 7") and ok.status_flag == 1
    assert "boom" in bad.message and bad.status_flag == 0


def holidays(spark):
    return spark.createDataFrame([(dt.date(2020, 1, 1), "New Year's Day"), (dt.date(2020, 1, 20), "MLK Day")],
                                 "holiday date, description string")


def cal(spark):
    return calendar.build_calendar(calendar.days(spark, dt.date(2019, 12, 20), dt.date(2020, 2, 10)), holidays(spark))


def test_calendar_moves_over_weekends_and_holidays(spark):
    got = {r.ori_date: r for r in cal(spark).collect()}
    mlk = got[dt.date(2020, 1, 20)]
    assert (mlk.pre_target_date, mlk.post_target_date) == (dt.date(2020, 1, 17), dt.date(2020, 1, 21))
    assert got[dt.date(2020, 1, 18)].post_target_date == dt.date(2020, 1, 21)


def test_rollover_skips_the_named_holidays(spark):
    runs = spark.createDataFrame([(dt.date(2020, 1, 17),), (dt.date(2019, 12, 31),), (dt.date(2020, 1, 21),)], "run_date date")
    got = rows(calendar.rollover_dates(cal(spark), holidays(spark), runs))
    assert got == [(dt.date(2019, 12, 31),) * 2, (dt.date(2020, 1, 17),) * 2,
                   (dt.date(2020, 1, 17), dt.date(2020, 1, 20)), (dt.date(2020, 1, 21),) * 2]


def test_weekend_runs_have_no_targets_and_no_window(spark):
    runs = spark.createDataFrame([(dt.date(2020, 1, 18),), (dt.date(2020, 1, 21),)], "run_date date")
    got = rows(calendar.due_targets(runs).na.fill("none"))
    t = calendar.due_targets(runs).filter("run_date = date'2020-01-18'").first()
    assert (t.first_date, t.second_date, t.third_date) == (None, None, None) and len(got) == 2
    win = rows(calendar.received_window(cal(spark), runs))
    assert win == [(dt.date(2020, 1, 21), dt.date(2020, 1, 17), dt.date(2020, 1, 20))]


def test_two_flag_rows_give_one_consent_row(spark):
    f = spark.createDataFrame([(1, 2, 0), (1, 6, 1), (2, 2, 1), (3, 1, 1)], "c int, flag_id int, flag_value int")
    assert rows(consent.email_consent(f, "flags", "c")) == [(1, 1, 0), (2, 0, 0), (3, 1, 1)]


def test_stop_message_ends_consent(spark):
    n = spark.createDataFrame([(1, 1, 1, T0), (2, 1, 1, T0), (3, 1, None, T0)], TABLES["notifications"])
    names = spark.createDataFrame([(1, "SMS_TRANSACTIONAL")], TABLES["notification_names"])
    log = spark.createDataFrame([(1, 1, 1, "Stop", T0), (2, 1, 1, "Yes", T0), (3, 2, 1, "Yes", T0),
                                 (4, 2, 1, "Stop", T0)], TABLES["sms_events"])
    got = {r.customer_id: r.is_transactional_optin for r in consent.sms_consent(n, names, log).collect()}
    assert got == {1: 1, 2: 0, 3: 0}


def test_rate_card_caps_the_sequence(spark):
    rates = spark.createDataFrame([("TX", "P", s, "B", Decimal(s), Decimal(1), Decimal(1)) for s in range(1, 8)],
                                  TABLES["loan_limit_rates"])
    df = spark.createDataFrame([(s, "TX", "P", "s", "B") for s in (5, 6, 7, 8)],
                               "loan_sequence int, state string, product string, storename string, f string")
    got = limits.rate_card_join(df, rates, F.col("f"), step=1)
    assert rows(got, "loan_sequence", "rpp") == [(5, Decimal(6)), (6, Decimal(7)), (7, Decimal(7)), (8, Decimal(7))]


def test_abandonment_borders(spark):
    ctx = RunContext(dt.datetime(2020, 1, 5, 12))
    ago = [(f"u{m}@x", 1, "page", ctx.run_ts - dt.timedelta(minutes=m), None) for m in (44, 45, 105, 106)]
    ev = spark.createDataFrame(ago, "user_name string, id bigint, page string, event_ts timestamp_ntz, known_id bigint")
    info = spark.createDataFrame([(u[0], "f", "TX", Decimal(1)) for u in ago],
                                 "email string, firstname string, state string, amount decimal(18,2)")
    leads = spark.createDataFrame([], "emailaddress string")
    offers = spark.createDataFrame([], "email string, promo_code string, offer decimal(18,2), expire_date date")
    df = abandoned.abandoned(ev, info, leads, dt.date(2020, 1, 2), ())
    assert rows(abandoned.list_abandoned_hourly(df, offers, ctx), "email") == [("u105@x",), ("u45@x",)]


def test_reconcile_tolerance_border(spark):
    d = dt.date(2020, 1, 1)
    sent = spark.createDataFrame([("A", d, 105), ("B", d, 106), ("C", d, 3)], "list_name string, report_date date, total_sent bigint")
    listed = spark.createDataFrame([("A", d, 100), ("B", d, 100), ("D", d, 7)], "list_name string, business_date date, total_listed bigint")
    got = {r.list_name: (r.is_matched, r.is_ran, r.is_more) for r in measure.reconcile(sent, listed, 5).collect()}
    assert got == {"A": (1, 1, 1), "B": (0, 1, 1), "C": (0, 0, 1), "D": (0, 0, 0)}


def test_state_floor_replaces_the_general_rule(spark):
    cols = "state string, days_since_last_draw int, total_default_count bigint, avail_credit_rate double, available_credit_limit double, total_payment_count bigint"
    df = spark.createDataFrame([("SC", 20, 0, 0.9, 609.0, 5), ("SC", 20, 0, 0.1, 610.0, 5), ("TX", 20, 0, 0.1, 100.0, 3),
                                ("TX", 14, 0, 0.9, 900.0, 9)], cols)
    assert rows(credit_line.list_loc_good_items(df, {"SC": 610}), "state", "available_credit_limit") == [("SC", 610.0), ("TX", 100.0)]
    assert rows(credit_line.list_loc_good_items(df, {}, 3), "available_credit_limit") == [(609.0,), (610.0,)]


def test_month_only_grouping_merges_years(spark):
    df = spark.createDataFrame([(dt.datetime(2019, 1, 5),), (dt.datetime(2020, 1, 5),)], "t timestamp_ntz")
    n = [F.count("*").alias("n")]
    assert rows(aggregates.by_period(df, "t", n)) == [(2019, 1, 1), (2020, 1, 1)]
    assert rows(aggregates.by_period(df, "t", n, "month")) == [(1, 2)]


def test_lookback_and_names():
    assert RunContext(dt.datetime(2020, 1, 1, 5)).lookback_days() == 60
    assert RunContext(dt.datetime(2020, 1, 1, 18, 30)).lookback_days() == 10
    assert RunContext(dt.datetime(2020, 1, 1, 19)).lookback_days() == 60
    assert snake_name("1st/Payment Date#") == "c_1st_payment_date"


# ---- edges found by probing ------------------------------------------------------------------------

def test_reversed_and_open_windows_hold_no_day(spark):
    d = dt.date(2020, 1, 9)
    df = spark.createDataFrame([(1, d)], "id int, d date")
    windows = spark.createDataFrame([(dt.date(2020, 1, 12), dt.date(2020, 1, 8)), (None, d), (d, d)], "a date, z date")
    assert rows(joins.in_windows(df, F.col("d"), windows, "a", "z"), "a") == [(d,)]


def test_a_reversed_mapping_matches_nothing_and_stops_nothing(spark):
    df = spark.createDataFrame([("abc1", dt.date(2020, 2, 3))], "code string, d date")
    dim = spark.createDataFrame([("abc%", dt.date(2020, 3, 1), dt.date(2020, 1, 1), 1),
                                 ("abc%", dt.date(2020, 2, 1), dt.date(2020, 2, 5), 2)], "p string, a date, z date, id int")
    assert rows(joins.pattern_range_join(df, dim, "code", "p", F.col("d"), "a", "z"), "id") == [(2,)]


def test_one_beginning_with_a_third_of_all_codes_is_spread(spark):
    df = spark.range(3000).select(F.col("id"), F.when(F.col("id") % 3 == 0, F.concat(F.lit("abc"), F.col("id")))
                                  .otherwise(F.concat(F.col("id"), F.lit("x"))).alias("code"), F.lit(dt.date(2020, 2, 3)).alias("d"))
    dim = spark.createDataFrame([("abc%", dt.date(2020, 1, 1), dt.date(2020, 3, 1), 1)], "p string, a date, z date, m int")
    hit = joins.pattern_range_join(df, dim, "code", "p", F.col("d"), "a", "z")
    assert hit.count() == 1000 and hit.select("id").distinct().count() == 1000


def test_a_null_sequence_has_no_rate_and_no_cap_leaves_it(spark):
    df = spark.createDataFrame([(1, None), (2, 9), (3, 7)], "id int, loan_sequence int").withColumns(
        {"state": F.lit("A"), "product": F.lit("P"), "storename": F.lit("s")})
    card = spark.createDataFrame([("A", "P", 7, "M", 1, 7, 1), ("A", "P", 9, "M", 1, 9, 1)],
                                 "state_code string, product_code string, loan_sequence int, pay_frequency string, rpp int, hardcap int, min_amt int")
    for cap, want in ((7, [(1, None), (2, 7), (3, 7)]), (None, [(1, None), (2, 9), (3, 7)])):
        got = limits.rate_card_join(df, card, F.lit("M"), cap=cap).orderBy("id").select("id", "hardcap").collect()
        assert [tuple(r) for r in got] == want


def test_no_stand_in_can_meet_a_real_key(spark):
    df = spark.createDataFrame([(8, None), (9, -9)], "row bigint, key bigint")
    right = spark.createDataFrame([(-9, "seed")], "key bigint, v string")
    assert sorted((r.row, r.v) for r in joins.join_sparse(df, right, "key", "row").collect()) == [(8, None), (9, "seed")]


def test_calls_keep_equal_rows_and_see_later_calls(spark):
    day = dt.datetime(2020, 1, 1)
    lst = spark.createDataFrame([("5551", day.replace(hour=12), day.date(), day.date())] * 2 + [("5552", day, day.date(), None)],
                                "phone string, sent timestamp_ntz, a date, z date")
    calls = spark.createDataFrame([("(555)1", day.replace(hour=9)), ("555-1", day.replace(hour=15))], "ani string, t timestamp_ntz")
    first = joins.match_calls(lst, calls, "phone", "ani", "t", "a", "z").collect()
    assert [r.first_called_time for r in first if r.phone == "5551"] == [day.replace(hour=9)] * 2 and len(first) == 3
    later = joins.match_calls(lst, calls, "phone", "ani", "t", "a", "z", not_before="sent").collect()
    assert [r.first_called_time for r in later if r.phone == "5551"] == [day.replace(hour=15)] * 2


def test_a_long_closure_is_looked_across(spark):
    first, shut = dt.date(2020, 1, 1), [dt.date(2020, 1, 6) + dt.timedelta(i) for i in range(26)]
    days = spark.createDataFrame([(first + dt.timedelta(i),) for i in range(60)], "ori_date date")
    holidays = spark.createDataFrame([(d, "closed") for d in shut], "holiday date, description string")
    got = {r.ori_date: r for r in calendar.build_calendar(days, holidays).collect()}
    middle = got[dt.date(2020, 1, 25)]
    assert middle.operation_date == dt.date(2020, 1, 3) and middle.post_target_date == dt.date(2020, 2, 3)


PRUNED = {"L05_list_pending_today": "received_time", "L06_list_pending_esign": "received_time", "L07_list_checklist": "received_time",
          "L08_list_pending_first": "received_time", "L09_list_pending_second": "received_time", "L10_list_withdrawn_range": "withdrawn_time",
          "L11_list_withdrawn_on_days": "withdrawn_time", "L14_list_cross_brand": "withdrawn_time", "L28_list_pending_by_hour": "created_date"}


@pytest.mark.parametrize("name,column", PRUNED.items())
def test_time_bounds_reach_the_table(spark, name, column):
    """The plan compares the bare column with two instants, whatever the view under it derives it from."""
    import __spark_entry__ as contract
    df = contract.queries()[name](spark, "/root/testdata/sf0.001")
    plans = df._jdf.queryExecution()
    # created_date is worked out in the query itself: the optimizer puts its expression in the place of the name
    text = (plans.analyzed() if column == "created_date" else plans.optimizedPlan()).toString()
    assert any(column in x and ">=" in x and "<" in x for x in text.splitlines()), text[:3000]


def test_bounds_are_pushed_into_a_parquet_scan(spark):
    path = fresh_path(spark, "bounded")
    spark.createDataFrame([(1, T0), (2, T0 + dt.timedelta(days=5))], "id int, t timestamp_ntz").write.parquet(path)
    runs = spark.createDataFrame([(T0.date(),)], "d date")
    df = joins.bounded(spark.read.parquet(path), "t", runs, "d", "d")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(t" in plan and "LessThan(t" in plan and rows(df, "id") == [(1,)]
    assert joins.bounded(df, "t", runs.limit(0), "d", "d").count() == 0


@pytest.mark.parametrize("name,target", [
    ("L02_list_due_legacy", "campaign_history"), ("L04_list_due_payoff", "campaign_history"), ("L06_list_pending_esign", "campaign_history_esig"),
    ("L07_list_checklist", "campaign_history_esig"), ("L13_list_winback", "campaign_history"), ("L15_list_pays_off", "campaign_history"),
    ("L17_list_good_customers", "campaign_history_monthly"), ("L18_list_loc_good", "campaign_history_loc"),
    ("L19_list_loc_good_items", "campaign_history_loc"), ("L20_list_sms_good", "campaign_history_monthly"),
    ("L20_list_sms_loc", "campaign_history_loc"), ("L21_list_abandoned_hourly", "campaign_history"), ("L28_list_pending_by_hour", "campaign_history")])
def test_every_list_fits_its_history(spark, name, target):
    import __spark_entry__ as contract
    lst = contract.queries()[name](spark, "/root/testdata/sf0.001")
    ctx = RunContext(T0)
    df = history.to_history(lst, ctx, target, "email", name, "daily")
    assert df.columns == TABLES[target].names and [f.dataType for f in df.schema] == [f.dataType for f in TABLES[target]]
