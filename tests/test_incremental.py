"""Keyed streams, refreshes, indexes and merged states on small hand-made tables."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from lendreach.context import RunContext
from lendreach.operators import aggregates, joins
from lendreach.plans import abandoned, daily, funnel
from lendreach.plans.refresh import Refreshed, StoredFact
from lendreach.session import fresh_path
from lendreach.sources import quarantine, writers
from lendreach.streaming import jobs, keyed

T0 = dt.datetime(2024, 1, 1, 12)
CTX = RunContext(dt.datetime(2024, 3, 4, 9))
EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string"


def at(minute):
    return T0 + dt.timedelta(minutes=minute)


class Clocked:
    """A stream over rows that arrive in parts, each part followed by a tick."""

    def __init__(self, spark, build, out_schema):
        self.spark, self.build, self.schema = spark, build, out_schema
        self.src, self.clock, self.state, self.out = (fresh_path(spark, x) for x in ("src", "clock", "state", "out"))

    def step(self, rows, minute):
        frame = self.spark.createDataFrame([(i, at(m), u, e) for i, m, u, e in rows], EVENTS)
        frame.coalesce(1).write.mode("append").parquet(self.src)
        keyed.tick(self.spark, self.clock, RunContext(at(minute)))
        events = jobs.read_events(self.spark, self.src, frame.schema)
        jobs.run_available(self.build(events, keyed.read_ticks(self.spark, self.clock)), self.state, self.out)
        return sorted(map(tuple, self.spark.read.schema(self.schema).parquet(self.out).collect()))


def test_idle_users_are_reported_by_the_clock_and_opened_again(spark):
    s = Clocked(spark, keyed.idle_users, "user_id bigint, dropoff_time timestamp_ntz, record_cnt bigint, report int")
    got = s.step([(1, 0, 1, "view"), (2, 30, 1, "view"), (3, 50, 2, "view"), (4, 0, 3, "error"), (5, 0, None, "view")], 60)
    assert got == []                                                # nobody is idle for 45 minutes yet
    got = s.step([], 80)                                            # no event at all: the clock alone moves
    assert got == [(1, at(30), 2, 1)]
    # user 1 comes back within the gap of what was told, user 2 submits, user 4 comes in out of order
    got = s.step([(6, 70, 1, "view"), (7, 90, 2, "purchase"), (8, 20, 4, "view"), (9, 5, 4, "view")], 200)
    assert got == [(1, at(30), 2, 1), (1, at(70), 3, 2), (4, at(20), 2, 1)]
    # a late event bridges two sessions of user 4; one of user 5 is rejected late, before it is told
    got = s.step([(10, 100, 4, "view"), (11, 60, 4, "view"), (12, 0, 5, "view"), (13, 10, 5, "error")], 400)
    assert got[-1] == (4, at(100), 4, 2) and len(got) == 4


def test_forgotten_sessions_begin_anew(spark):
    s = Clocked(spark, lambda e, t: keyed.idle_users(e, t, keep_days=1),
                "user_id bigint, dropoff_time timestamp_ntz, record_cnt bigint, report int")
    s.step([(1, 0, 1, "view")], 100)
    s.step([], 3000)                                                # two days on: the session leaves the state
    assert s.step([(2, 10, 1, "view")], 6000) == [(1, at(0), 1, 1), (1, at(10), 1, 1)]


def test_contacts_are_limited_in_the_order_of_time(spark):
    rnd = random.Random(5)
    rows = [(i, rnd.randint(0, 4000), rnd.choice([1, 1, 1, 2, 3]), rnd.choice("abcd")) for i in range(120)]
    want, sent = [], {}
    for i, m, u, name in sorted(rows, key=lambda r: (r[2], r[1], r[3], r[0])):
        near = [x for x in sent.setdefault(u, []) if m - x[0] < 1440]
        if len(near) < 2 and name not in [x[1] for x in near]:
            sent[u].append((m, name))
            want.append((u, name, at(m), i))

    def build(e, t):
        return keyed.contact_limit(e, t, "user_id", "event_type", "ts", "event_id", most=2, period_days=1, late_minutes=5000)
    s = Clocked(spark, build, "user_id bigint, event_type string, ts timestamp_ntz, event_id bigint")
    assert s.step([(i, m, u, n) for i, m, u, n in rows if i % 2], 4000) == []     # all still wait for late rows
    s.step([(i, m, u, n) for i, m, u, n in rows if i % 2 == 0], 6000)
    assert s.step([], 20_000) == sorted(want)
    # later than the bound: decided when it comes, against what was sent on either side
    got = s.step([(900, want[0][2].hour * 0 + 1, 9, "a"), (901, 3, 9, "a"), (902, 2, 1, want[0][1])], 20_001)
    assert (9, "a", at(1), 900) in got and all(r[3] != 901 for r in got)


def test_ordered_steps_of_a_user_with_very_many_events(spark):
    rnd = random.Random(9)
    pages = ["a", "b", "c", "x", "reject"]
    rows = [(i, u, T0 + dt.timedelta(minutes=rnd.randint(0, 9000)), rnd.choice(pages))
            for i, u in enumerate([1] * 3000 + [rnd.randint(2, 60) for _ in range(400)])]
    rows += [(9000, 70, T0, "c"), (9001, 70, T0, "b"), (9002, 70, T0, "a")]         # equal times follow the id
    df = spark.createDataFrame(rows, "id long, u long, t timestamp_ntz, page string")
    for grain in ("day", "hour"):
        got = {r.u: tuple(r)[1:] for r in funnel.funnel_ordered(df, ["a", "b", "c"], "u", "t", "id", grain).collect()}
        for u in {r[1] for r in rows}:
            mine = [r for r in sorted((r for r in rows if r[1] == u), key=lambda r: (r[2], r[0]))]
            times = []
            for r in mine:
                if len(times) < 3 and r[3] == "abc"[len(times)]:
                    times.append(r[2])
            if any(r[3] in "abc" for r in mine):
                assert got[u] == (len(times), *times, *[None] * (3 - len(times)))
    assert got[70] == (1, T0, None, None)


def test_reject_positions(spark):
    def flags(*events):
        rows = [(1, T0 + dt.timedelta(minutes=m), p, None if lead is None else at(lead)) for m, p, lead in events]
        df = spark.createDataFrame(rows, "user_name long, event_ts timestamp_ntz, page string, lead timestamp_ntz")
        r = funnel.funnel_internal(df, "create_password_submit", F.lit(T0).cast("timestamp_ntz"), received="lead").first()
        return r.reject_before_offer, r.reject_after_offer, r.reject_after_lead
    begin = (0, "create_password_submit", None)
    assert flags(begin, (1, "reject", None)) == (1, 0, 0)
    assert flags(begin, (1, "pre_approved_submit", None), (2, "reject", None)) == (0, 1, 0)
    assert flags(begin, (1, "pre_approved_submit", None), (2, "reject", None), (3, "kyc_submit", None)) == (0, 0, 0)
    bank = (5, "banking_info_submit", None)
    assert flags(begin, bank, (6, "reject", 10)) == (1, 0, 0)        # rejected before the lead came in
    assert flags(begin, bank, (10, "reject", 10)) == (1, 0, 1)


def test_nobody_is_listed_twice_for_two_forms(spark):
    info = spark.createDataFrame([("a@x", "Zoe", "S1", 5), ("a@x", "Ann", "S2", 7), ("a@x", None, "S2", 7)],
                                 "email string, firstname string, state string, amount int")
    events = spark.createDataFrame([(1, "a@x", T0, "welcome", None)], "id long, user_name string, event_ts timestamp_ntz, page string, known_id long")
    got = abandoned.last_activity(events, info, T0.date(), ("i.com",)).collect()
    assert len(got) == 1 and got[0].state == "S2" and got[0].firstname is None


def test_daily_activity_equals_one_pass(spark):
    rnd = random.Random(2)
    rows = [(i, f"u{rnd.randint(0, 40)}@x", T0 + dt.timedelta(minutes=rnd.randint(0, 7000)),
             "reject" if rnd.random() < 0.01 else "welcome", 5 if rnd.random() < 0.005 else None) for i in range(600)]
    events = spark.createDataFrame(rows, "id long, user_name string, event_ts timestamp_ntz, page string, known_id long")
    info = spark.createDataFrame([("u1@x", "A", "S", 1)], "email string, firstname string, state string, amount int")
    days = abandoned.DailyActivity(spark, fresh_path(spark, "days"))
    first, last = T0.date(), T0.date() + dt.timedelta(days=5)
    days.refresh(events, first, last - dt.timedelta(days=2), ("i.com",))
    for d in (1, 0, 0):
        days.refresh(events, last - dt.timedelta(days=d), last - dt.timedelta(days=d), ("i.com",))
    since = last - dt.timedelta(days=3)
    for known in (None, since):
        want = abandoned.last_activity(events, info, since, ("i.com",), known)
        got = days.last_activity(info, since, last, known)
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str) and got.count() > 5
    plan = days.activity.read().filter(F.col("day") >= F.lit(last))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_patterns_meet_codes_through_their_rarest_run(spark):
    rnd = random.Random(4)
    codes = ["".join(rnd.choice("abcAB01_%") for _ in range(rnd.randint(1, 9))) for _ in range(300)] + [None, "", "abc", "ABC"]
    patterns = ["%abc%", "a_c%", "%", "_", "abc", "%a%b%", "__", "%zz%", "zq%", " ab% ", "a\\_%", "%%", "b%1", None, ""]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(codes)], "id int, code string")
    dim = spark.createDataFrame(list(enumerate(patterns)), "k int, pattern string")
    got = sorted(map(tuple, joins.pattern_index(df, dim, "code", "pattern", "k").collect()))
    plain = df.select("code").distinct().crossJoin(dim).filter(F.like(F.lower("code"), F.lower(F.trim("pattern"))))
    assert got == sorted(map(tuple, plain.select("code", "k").collect())) and len(got) > 500
    days = [dt.date(2024, 1, 1 + i % 20) for i in range(len(codes))]
    df = spark.createDataFrame([(i, c, d) for i, (c, d) in enumerate(zip(codes, days))], "id int, code string, d date")
    span = dim.withColumns({"s": F.lit(dt.date(2024, 1, 5)), "e": F.expr("date_add(date'2024-01-05', k)")})
    got = joins.pattern_index_join(df, span, "code", "pattern", "k", F.col("d"), "s", "e", 1, 1)
    assert sorted((r.id, r.k) for r in got.collect()) == sorted((r.id, r.k) for r in df.crossJoin(span).filter(
        F.like(F.lower("code"), F.lower(F.trim("pattern"))) & F.expr("d between date_sub(s, 1) and date_add(e, 1)")).collect())


def test_bitmaps_add_up(spark):
    rnd = random.Random(6)
    rows = [(rnd.randint(1, 12), rnd.choice([f"m{rnd.randint(0, 99_000)}", "hot", None]), rnd.random() < 0.3) for _ in range(3000)]
    df = spark.createDataFrame(rows, "month int, mail string, ok boolean")
    ids = aggregates.dense_ids(df, "mail")
    numbers = sorted(r.dense_id for r in ids.collect())
    assert numbers == list(range(1, len({r[1] for r in rows} - {None}) + 1))
    states = aggregates.distinct_bitmaps(df.join(ids, "mail"), "dense_id", ["month"], {"all": F.lit(True), "some": F.col("ok")})
    for by in (["month"], []):
        got = {(r["month"] if by else 0): (r["all"], r["some"]) for r in aggregates.bitmap_counts(states, by, ["all", "some"]).collect()}
        for g in got:
            mine = [r for r in rows if r[1] is not None and (not by or r[0] == g)]
            assert got[g] == (len({r[1] for r in mine}), len({r[1] for r in mine if r[2]}))
    # later values go on behind the stored numbers, so that states of both times add up
    late = spark.createDataFrame([(13, "hot", True), (13, "new", True)], df.schema)
    more = aggregates.dense_ids(late, "mail", known=ids)
    assert more.count() == ids.count() + 1 and more.filter("mail = 'new'").first().dense_id == len(numbers) + 1
    both = states.unionByName(aggregates.distinct_bitmaps(late.join(more, "mail"), "dense_id", ["month"], {"all": F.lit(True), "some": F.col("ok")}))
    assert aggregates.bitmap_counts(both, [], ["all"]).first()["all"] == len(numbers) + 1


def test_refresh_writes_only_what_differs(spark):
    schema = "code string, lead long, day date, a string, b string"
    d = [dt.date(2024, m, 3) for m in (1, 2, 3)]
    first = [("J", i, d[i % 3], f"a{i}", None) for i in range(9)] + [("J", None, d[0], "no lead", None)]
    fact = StoredFact(spark, fresh_path(spark, "fact"), spark.createDataFrame([], schema).schema, ["code", "lead"], "day")
    assert fact.refresh(spark.createDataFrame(first, schema)) == Refreshed(10, 0, 0, 3)
    assert fact.refresh(spark.createDataFrame(first, schema)) == Refreshed(0, 0, 10, 0)
    later = [("J", 1, d[1], None, "a1"), ("J", 4, d[1], "a4", None), ("J", 90, d[1], "new", None)]    # 1: the value moved over
    assert fact.refresh(spark.createDataFrame(later, schema)) == Refreshed(1, 1, 1, 1)
    twice = [("J", 2, d[2], "a2", None)] * 2 + [("J", 5, d[2], "a5", None)] * 2
    assert fact.refresh(spark.createDataFrame(twice, schema)) == Refreshed(0, 4, 0, 1)
    leads = spark.createDataFrame([("J", 2, 0, 1), ("J", 5, 0, 0), ("J", 8, 0, 0), ("J", 0, 1, 1)],
                                  "code string, lead long, isapplicationtest int, isuniqueaccept int")
    fact.purge_tests(leads, ["code", "lead"])
    fact.purge_doubles(leads, ["code", "lead"])
    left = sorted(str(r.lead) for r in fact.read().collect())
    assert left == sorted(["1", "2", "2", "3", "4", "6", "7", "8", "90", "None"])
    assert fact.null_where("a", F.col("lead") == 3).partitions == 1 and fact.read().filter("a is null").count() == 2


def test_broken_lines_are_put_apart(spark, tmp_path):
    (tmp_path / "in.csv").write_text(
        "loan,day,amount,state\n1,2024-01-05,100.50,A\nx,soon,7,B\n,2024-01-05,99999,A\n4,2024-01-05,50\n"
        "5,2024-01-05,50,A,more\n6, 2024-01-05 ,,\n\"7\",2024-02-30,1,\"A\"\n")
    schema = spark.createDataFrame([], "loan long, day date, amount decimal(18,2), state string").schema
    rules = (quarantine.ImportRule("loan", required=True), quarantine.ImportRule("amount", highest=1000),
             quarantine.ImportRule("state", allowed=("A",)))
    for _ in range(2):
        out = quarantine.load_import(spark, str(tmp_path / "in.csv"), schema, str(tmp_path / "out"), CTX, "list", rules)
        assert sorted(r.loan for r in out.good.collect()) == [1, 6] and out.good.schema == schema
        bad = {tuple(x.split(":")[0] + ":" + x.split(":")[1] for x in r.reasons) for r in out.bad.collect()}
        assert ("loan: not a bigint", "day: not a date", "state: unknown value") in bad and ("day: not a date",) in bad
        assert ("loan: missing", "amount: over 1000") in bad and sum(b[0].startswith("line") for b in bad) >= 1
        assert out.audit.first().message == "Insert succeeded, total row count = 2, quarantined = 5"
    with pytest.raises(ValueError):
        quarantine.read_lines(spark, str(tmp_path / "in.csv"), schema, (quarantine.ImportRule("nothing"),))


def test_a_run_that_stops_between_its_steps_loses_no_rows(spark, monkeypatch):
    path = fresh_path(spark, "lists")
    def rows(*pairs):
        return spark.createDataFrame(pairs, "list_module string, n int")
    writers.replace_run(rows(("PA", 1), ("WAD", 2), ("POL", 3)), path, ["list_module"])
    def stop(*args):
        raise RuntimeError("driver lost")
    monkeypatch.setattr(writers, "_clear", stop)
    with pytest.raises(RuntimeError):
        writers.replace_run(rows(("PA", 9)), path, ["list_module"], runs=[("PA",), ("WAD",), ("NEW",)])
    assert {tuple(r) for r in spark.read.parquet(path).select("list_module", "n").collect()} == {("PA", 9), ("WAD", 2), ("POL", 3)}
    monkeypatch.undo()
    writers.replace_run(rows(("PA", 9)), path, ["list_module"], runs=[("PA",), ("WAD",), ("NEW",)])
    assert {tuple(r) for r in spark.read.parquet(path).select("list_module", "n").collect()} == {("PA", 9), ("POL", 3)}


def test_a_broken_step_is_logged_and_passed_over(spark):
    def broken():
        return spark.range(1).select("nothing")
    (bad,) = daily.run_step("populate X", "Insert", CTX, spark, lambda: broken().count()).collect()
    (good,) = daily.run_step("populate Y", "Insert", CTX, spark, lambda: 7).collect()
    assert bad.status_flag == 0 and bad.message.startswith("Insert failed, error message = AnalysisException")
    assert good.status_flag == 1 and good.message == "Insert succeeded, total row count = 7"
