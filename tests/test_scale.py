"""Work that must not gather in one task, nor be repeated for every timer or day."""

import datetime as dt
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from lendreach.operators import joins, ranking
from lendreach.plans import service, withdrawn
from lendreach.plans.common import Rules
from lendreach.sources.colocated import settings
from lendreach.streaming import keyed

T0 = dt.datetime(2020, 1, 1)
HOUR = 3_600_000_000


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def shuffled(spark):
    """Plans with the joins of large tables, not changed at run time."""
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}):
        yield spark


class Store:
    """State and timers of one key, in memory."""

    def __init__(self):
        self.timers, self.calls, self.states = set(), 0, {}

    def _state(self, name, _schema):
        held = self.states.setdefault(name, [])

        def write(rows):
            self.calls += 1
            held[:] = rows
        return SimpleNamespace(get=lambda: iter(held), put=write, clear=lambda: write([]), exists=lambda: bool(held),
                               appendList=lambda rows: write([*held, *rows]))

    def getListState(self, name, schema):
        return self._state(name, schema)

    def getValueState(self, name, schema):
        s = self._state(name, schema)
        return SimpleNamespace(get=lambda: next(s.get(), None), update=lambda v: s.put([v]), clear=s.clear)

    def getMapState(self, name, keys, values):
        held = self.states.setdefault(name, {})

        def write(k, v):
            self.calls += 1
            held[k] = v
        return SimpleNamespace(iterator=lambda: iter(list(held.items())), updateValue=write, removeKey=held.pop)

    def registerTimer(self, at):
        self.calls += 1
        self.timers.add(at)

    def run_until(self, job, key, now):
        """Fire what is due as the engine does; rows told and calls of the handler."""
        told, fired = [], 0
        clock = SimpleNamespace(getCurrentWatermarkInMs=lambda: now)
        for at in sorted(t for t in self.timers if t <= now):
            self.timers.discard(at)
            fired += 1
            told += job.handleExpiredTimer(key, clock, None)
        return told, fired


def test_a_user_with_many_sessions_has_one_timer():
    job, store = keyed.IdleUsers(HOUR, 100 * 24 * HOUR), Store()
    job.init(store)
    rows = [SimpleNamespace(us=i * 3 * HOUR, closes=int(i % 5 == 0)) for i in range(200)]
    list(job.handleInputRows((1,), iter(rows), None))
    told, fired = store.run_until(job, (1,), 400 * HOUR // 1000)
    assert (len(told), fired) == (len([i for i in range(200) if i % 5 and (i * 3 + 1) <= 400]), 1)
    assert store.calls <= 4 and len(store.timers) == 1
    told, _ = store.run_until(job, (1,), 700 * HOUR // 1000)
    assert len(told) == len([i for i in range(200) if i % 5 and (i * 3 + 1) > 400])


def test_a_customer_with_many_sends_has_one_timer():
    job, store = keyed.ContactLimit(3, 48 * HOUR, HOUR), Store()
    job.init(store)
    rows = [SimpleNamespace(us=i * 5 * HOUR, list=f"l{i % 7}", id=i) for i in range(200)]
    list(job.handleInputRows((1,), iter(rows), None))
    told, fired = store.run_until(job, (1,), 500 * HOUR // 1000)
    more, again = store.run_until(job, (1,), 2000 * HOUR // 1000)
    assert fired == again == 1 and store.calls < 20
    sent = []
    for r in rows:      # the rule as it is written
        near = [s for s in sent if r.us - s.us < 48 * HOUR]
        if len(near) < 3 and r.list not in {s.list for s in near}:
            sent.append(r)
    assert [r.id for r in [*told, *more]] == [r.id for r in sent]


def test_null_keys_of_a_sparse_join_are_spread(shuffled):
    df = shuffled.createDataFrame([(i, None if i % 10 else i) for i in range(400)], "row bigint, key bigint")
    right = shuffled.createDataFrame([(k, "v") for k in range(0, 400, 20)] + [(None, "x")], "key bigint, v string")
    out = joins.join_sparse(df, right, "key", "row").select("row", "key", "v", F.spark_partition_id().alias("p")).collect()
    assert len({r.p for r in out if r.key is None}) > 1
    assert sorted((r.row, r.v) for r in out) == [(i, "v" if i % 20 == 0 else None) for i in range(400)]


def test_a_numbering_moves_its_rows_once(shuffled):
    rows = [(i % 3 or None, i, T0 + dt.timedelta(hours=i * 7 % 50) if i % 11 else None, "x" * 9) for i in range(90)]
    df = shuffled.createDataFrame(rows, "k int, id int, t timestamp_ntz, wide string")
    out = ranking.sequence_number(df, ["k"], "t", ["id"], "n")
    assert plan(out).count("wide#") and "Join" not in plan(out) and out.columns == [*df.columns, "n"]
    first = dt.datetime.min
    for k in (None, 1, 2):
        mine = sorted((r for r in rows if r[0] == k), key=lambda r: (r[2] or first, r[1]))
        got = {r.id: r.n for r in out.collect() if r.k == k}
        assert got == {r[1]: n for n, r in enumerate(mine, 1)}


@pytest.mark.parametrize("not_before", [None, "sent"])
def test_calls_are_met_by_blocks_of_days(shuffled, not_before):
    days = [T0 + dt.timedelta(i) for i in range(0, 120, 3)]
    lst = [(f"555{i % 4}" if i % 9 else None, d.date(), (d + dt.timedelta(i % 50)).date(), d + dt.timedelta(1), i)
           for i, d in enumerate(days)]
    calls = [(f"(555){i % 4}", T0 + dt.timedelta(days=i * 2.3, hours=i)) for i in range(60)]
    a = shuffled.createDataFrame(lst, "phone string, a date, z date, sent timestamp_ntz, id int")
    c = shuffled.createDataFrame(calls, "ani string, t timestamp_ntz")
    out = joins.match_calls(a, c, "phone", "ani", "t", "a", "z", not_before)
    assert plan(out).count("Exchange hashpartitioning(phone") == 1
    got = {r.id: r.first_called_time for r in out.collect()}
    for phone, first, last, sent, i in lst:
        hits = [t for n, t in calls if phone and n == f"(555){phone[3]}" and first <= t.date() <= last
                and (not not_before or t >= sent)]
        assert got[i] == min(hits, default=None)


def test_segment_rules_meet_a_module_in_many_tasks(shuffled):
    day = dt.datetime(2020, 1, 10, 9)
    rows = [(day, dt.datetime(2020, 1, 7), None, "PA", "TX", "P", 0, f"n{i}", f"m{i}", 1) for i in range(300)]
    h = shuffled.createDataFrame(rows, """list_generation_time timestamp_ntz, withdrawn_time timestamp_ntz, last_repayment_date date,
        list_module string, state string, product string, extra1 int, customer_firstname string, email string, approved_amount int""")
    spec = shuffled.createDataFrame([("S", "PA", 3, None, None, None), ("S", "PA", None, "P", None, None), ("Z", "WAD", None, None, None, None)],
                                    "segment string, list_module string, days_since int, product string, in_carve int, extra1 int")
    out = service.segment(h, spec)
    line = next(x for x in plan(out).splitlines() if "Exchange hashpartitioning(list_module" in x)
    assert "_salt" in line
    assert sorted(r.email for r in out.collect()) == sorted(r[8] for r in rows)


@pytest.mark.parametrize("back,until", [(6, 1), (4, 0), (0, 0), (1, 3), (3, -2)])
def test_runs_that_take_a_row_are_one_span(spark, back, until):
    days = [None, *[dt.date(2020, 1, 1) + dt.timedelta(i) for i in (0, 1, 1, 2, 4, 9, 14, 15)]]
    rows = [(k, i, days[i * 5 % 9], T0 + dt.timedelta(hours=i * 7 % 13) if i % 8 else None)
            for k in ("a", "b", None) for i in range(4 if k == "a" else 18)]
    df = spark.createDataFrame(rows, "k string, id int, day date, t timestamp_ntz")
    got = {(r.k, r.id, r.first_run + dt.timedelta(n)) for r in ranking.latest_in_runs(
        df, ["k"], F.col("day"), "t", back, until).collect() for n in range((r.last_run - r.first_run).days + 1)}
    want = set()
    for run in (dt.date(2019, 12, 20) + dt.timedelta(n) for n in range(60)):
        seen = [r for r in rows if r[2] and r[3] and run - dt.timedelta(back) <= r[2] <= run - dt.timedelta(until)]
        want |= {(r[0], r[1], run) for r in seen if r[3] == max(x[3] for x in seen if x[0] == r[0])}
    assert got == want


def test_a_withdrawn_list_sorts_no_row_per_run_date(shuffled):
    base = {"application_status": "withdrawn", "withdrawn_reason_code": 1, "loan_sequence": 1, "isreturning": 0, "isapplicationtest": 0,
            "emailaddress": "a@mail.example.com", "email_marketingoptin": 1, "state": "TX", "product": "P", "origination_time": None,
            "customer_firstname": "ANN", "customer_lastname": "B", "requested_amount": 1.0, "approved_amount": 1.0, "maxloanlimit": 1.0,
            "withdrawn_reason": "r", "campaign_name": None, "lms_code": "INST"}
    schema = """application_status string, withdrawn_reason_code int, loan_sequence int, isreturning int, isapplicationtest int, emailaddress string,
        email_marketingoptin int, state string, product string, origination_time timestamp_ntz, customer_firstname string, customer_lastname string,
        requested_amount double, approved_amount double, maxloanlimit double, withdrawn_reason string, campaign_name string, lms_code string,
        lms_customer_id long, lms_application_id long, received_time timestamp_ntz, withdrawn_time timestamp_ntz"""
    own = [(1, 1, 0, 3), (1, 2, 2, 8), (1, 2, 2, 8), (None, 3, 1, 4), (None, 4, 1, 4), (2, 5, 0, 1)]
    leads = shuffled.createDataFrame([{**base, "lms_customer_id": c, "lms_application_id": a, "received_time": T0 + dt.timedelta(r),
                                       "withdrawn_time": T0 + dt.timedelta(w, hours=5)} for c, a, r, w in own], schema)
    runs = [dt.date(2020, 1, 1) + dt.timedelta(n) for n in range(20)]
    out = withdrawn.list_withdrawn_range(leads, shuffled.createDataFrame([(d,) for d in runs * 2], "run_date date"),
                                         Rules(job_suffix={"INST": "PAJ"}), F.lit("w"), back=6)
    assert not any("run_date" in x for x in plan(out).splitlines() if "Window " in x or "WindowGroupLimit " in x)
    got = sorted((r.business_date, r.lms_application_id) for r in out.collect())
    first = dt.date(2020, 1, 1)
    want = []
    for run in (d for d in runs if d.weekday() < 5):
        seen = [(c, a, r) for c, a, r, w in set(own) if 1 <= (run - first).days - w <= 6]
        want += [(run, a) for c, a, r in seen if r == max(x[2] for x in seen if x[0] == c)]
    assert got == sorted(want) and got


def test_wide_rows_are_not_fused_into_one_method(spark):
    wide = [(F.rand() * i).alias(f"c{i}") for i in range(60)]
    assert plan(spark.range(3).select(*wide)).startswith("Project")
    assert plan(spark.range(3).select(*wide[:9])).startswith("*(1) Project")
