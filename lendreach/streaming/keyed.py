"""Streams with state per key and timers: idle users, and a limit on contacts.

Time moves with the rows of a clock, not with traffic and not with the wall clock: every run adds one row with its
instant, so a user is reported even when nobody else is active, and a replay gives the same rows.
"""

from __future__ import annotations

import bisect
import math
import struct
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from lendreach.context import RunContext

TICKS = "clock timestamp"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def tick(spark: SparkSession, path: str, ctx: RunContext) -> None:
    """Say on the clock at ``path`` that it is now the instant of the run."""
    ctx.run_dates(spark).select(ctx.ts().cast("timestamp").alias("clock")).coalesce(1).write.mode("append").parquet(path)


def read_ticks(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema(TICKS).parquet(path)


def micros(c: Column) -> Column:
    return F.unix_micros(c.cast("timestamp"))


def from_micros(c: Column) -> Column:
    return F.timestamp_micros(c).cast("timestamp_ntz")


def _clocked(rows: DataFrame, ticks: DataFrame) -> DataFrame:
    """Rows and ticks as one stream in which only ticks carry the clock, so no row is ever late for it."""
    spark = rows.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", _ROCKS)
    return (rows.withColumn("clock", F.lit(None).cast("timestamp"))
            .unionByName(ticks.select("clock"), allowMissingColumns=True).withWatermark("clock", "0 seconds"))


def _millis(us: int) -> int:
    """The first whole millisecond at or after an instant."""
    return math.ceil(us / 1000)


def _at(sent: tuple) -> int:
    return sent[0]


class Session:
    """First and last event, number of events, whether one closed it, and how often it was reported."""
    __slots__ = ("first", "last", "n", "closed", "told", "fresh")

    def __init__(self, first: int, last: int, n: int, closed: int, told: int, fresh: int):
        self.first, self.last, self.n, self.closed, self.told, self.fresh = first, last, n, closed, told, fresh

    def add(self, o: "Session") -> None:
        self.first, self.last = min(self.first, o.first), max(self.last, o.last)
        self.n, self.closed = self.n + o.n, max(self.closed, o.closed)
        self.told, self.fresh = max(self.told, o.told), 1


_SESSION = struct.Struct(f"<{len(Session.__slots__)}q")     # as the state store holds a session


class IdleUsers(StatefulProcessor):
    """Sessions of one user, oldest first, read and written as a whole; one timer a user stands at the earliest
    instant at which a session has to be looked at."""

    def __init__(self, gap: int, keep: int):
        self.gap, self.keep = gap, keep

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("sessions", "packed binary")

    def _load(self) -> list[Session]:
        held = self.state.get()
        return [Session(*s) for s in _SESSION.iter_unpack(held[0])] if held else []

    def _next(self, sessions: list[Session]) -> int | None:
        return min((_millis(s.last + (self.gap if s.fresh else self.keep)) for s in sessions), default=None)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        if key[0] is None:      # ticks, and events of nobody
            return iter(())
        sessions = self._load()
        before = self._next(sessions)
        for r in rows:
            if r.us is not None:
                self._place(sessions, Session(r.us, r.us, 1, r.closes, 0, 1))
        if sessions:
            at = self._next(sessions)
            if before is None or at < before:   # a timer that comes too early finds nothing to do and is set anew
                self.handle.registerTimer(at)
            self._store(sessions)
        return iter(())

    def _place(self, sessions: list[Session], s: Session) -> None:
        """Join an event with every session it is within the gap of."""
        at = bisect.bisect_right(sessions, s.first, key=lambda x: x.first)
        if at and s.first - sessions[at - 1].last <= self.gap:
            at -= 1
            sessions[at].add(s)
        else:
            sessions.insert(at, s)
        while at + 1 < len(sessions) and sessions[at + 1].first - sessions[at].last <= self.gap:
            sessions[at].add(sessions.pop(at + 1))

    def _store(self, sessions: list[Session]) -> None:
        if sessions:
            self.state.update((b"".join(_SESSION.pack(*(getattr(s, c) for c in Session.__slots__)) for s in sessions),))
        else:
            self.state.clear()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = timerValues.getCurrentWatermarkInMs() * 1000
        sessions = self._load()
        out, left = [], []
        for s in sessions:
            if s.last + self.gap <= now:
                if s.fresh and not s.closed:
                    s.told += 1
                    out.append(Row(user_id=key[0], dropoff_us=s.last, record_cnt=s.n, report=s.told))
                s.fresh = 0
            if s.fresh or s.last + self.keep > now:
                left.append(s)
        if sessions:
            self._store(left)
        if left:
            self.handle.registerTimer(self._next(left))
        return iter(out)

    def close(self) -> None:
        pass


def idle_users(events: DataFrame, ticks: DataFrame, user: str = "user_id", ts: str = "ts", page: str = "event_type",
               gap_minutes: int = 45, keep_days: int = 3, rejected: str = "error",
               submitted: str = "purchase") -> DataFrame:
    """(user, dropoff_time, record_cnt, report): a user's sessions without rejection or submission, each reported
    once the clock has passed its last event by the gap, whoever else is active.

    An event that comes later, of any age, joins the sessions it is within the gap of and re-opens them: they are
    reported again (``report`` 2, 3, …) with the new end and count, unless the event rejects or submits. A session
    is forgotten ``keep_days`` after its last event; what comes for it then begins a new one. Events without a
    user or time are left out; repeated events count each. State goes on over restarts.
    """
    closes = F.when(F.col(page).isin(rejected, submitted), 1).otherwise(0)
    rows = events.select(F.col(user).cast("long").alias("user_id"), micros(F.col(ts)).alias("us"), closes.alias("closes"))
    minute = 60_000_000
    out = _clocked(rows, ticks).groupBy("user_id").transformWithState(
        IdleUsers(gap_minutes * minute, keep_days * 1440 * minute),
        "user_id long, dropoff_us long, record_cnt long, report int", "Append", "EventTime")
    return out.select(F.col("user_id").alias(user), from_micros(F.col("dropoff_us")).alias("dropoff_time"),
                      "record_cnt", "report")


class ContactLimit(StatefulProcessor):
    """Sends of one customer: those that wait for the clock, those let through within the period, and the instant
    of the customer's one timer."""

    def __init__(self, most: int, period: int, late: int):
        self.most, self.period, self.late = most, period, late

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "us long, list string, id long")
        self.sent = handle.getListState("sent", "us long, id long, list string")
        self.timer = handle.getValueState("timer", "at long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        if key[0] is None:
            return iter(())
        fresh = [(r.us, r.list, r.id) for r in rows if r.us is not None]
        if fresh:
            self.waiting.appendList(fresh)
            set_for, at = self.timer.get(), _millis(min(r[0] for r in fresh) + self.late)
            if set_for is None or at < set_for[0]:
                self._set(at)
        return iter(())

    def _set(self, at: int) -> None:
        self.handle.registerTimer(at)
        self.timer.update((at,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        """Decide all that the clock has passed, in the order of time, list and id; drop what is too old to matter."""
        now = timerValues.getCurrentWatermarkInMs() * 1000
        waiting = [tuple(r) for r in self.waiting.get()]
        due = sorted((r for r in waiting if _millis(r[0] + self.late) * 1000 <= now), key=lambda r: (r[0], r[1] or "", r[2]))
        if not due:
            return iter(())
        rest = [r for r in waiting if _millis(r[0] + self.late) * 1000 > now]
        sent = sorted((tuple(r) for r in self.sent.get()), key=_at)
        out = []
        for us, name, number in due:
            near = sent[bisect.bisect_right(sent, us - self.period, key=_at):bisect.bisect_left(sent, us + self.period, key=_at)]
            if len(near) < self.most and all(s[2] != name for s in near):
                bisect.insort(sent, (us, number, name), key=_at)
                out.append(Row(customer=key[0], list=name, us=us, id=number))
        sent = [s for s in sent if s[0] + self.period + self.late > due[-1][0]]
        for state, left in ((self.waiting, rest), (self.sent, sent)):
            if left:
                state.put(left)
            else:
                state.clear()
        if rest:
            self._set(min(_millis(r[0] + self.late) for r in rest))
        else:
            self.timer.clear()
        return iter(out)

    def close(self) -> None:
        pass


def contact_limit(sends: DataFrame, ticks: DataFrame, customer: str, list_name: str, ts: str, key: str,
                  most: int = 3, period_days: int = 7, late_minutes: int = 60) -> DataFrame:
    """(customer, list, ts, key) of the sends let through: a customer gets each list at most once, and at most
    ``most`` sends of any list, within any ``period_days``; the earlier send wins, ties by list and key.

    A send waits until the clock has passed it by ``late_minutes`` and is then decided in the order of time, so
    rows that come out of order within that bound give the same result as rows in order. A row later still is
    decided when it comes, against all sends less than a period away on either side. What is older than the
    period (and the bound) leaves the state. Rows without a customer or time are left out.
    """
    rows = sends.select(F.col(customer).cast("long").alias("customer"), micros(F.col(ts)).alias("us"),
                        F.col(list_name).alias("list"), F.col(key).cast("long").alias("id"))
    minute = 60_000_000
    out = _clocked(rows, ticks).groupBy("customer").transformWithState(
        ContactLimit(most, period_days * 1440 * minute, late_minutes * minute),
        "customer long, list string, us long, id long", "Append", "EventTime")
    return out.select(F.col("customer").alias(customer), F.col("list").alias(list_name),
                      from_micros(F.col("us")).alias(ts), F.col("id").alias(key))
