"""Streams over the events table, run until all input is processed."""

import datetime as dt

from pyspark.sql import functions as F

from lendreach.checks.registry import query
from lendreach.context import RunContext
from lendreach.operators.ranking import pick_one
from lendreach.session import fresh_path
from lendreach.streaming import jobs, keyed


def _parts(v):
    """The events in two parts by time, as they would arrive around a restart."""
    middle = v.events.agg(F.expr("percentile_approx(ts, 0.5)")).first()[0]
    return [v.events.filter(F.col("ts") < F.lit(middle)), v.events.filter(F.col("ts") >= F.lit(middle))]


def _restarted(v, build, name, mode="append", write=None):
    """Run a job, let more events arrive, and run it again on the same state; the output path."""
    src, state, out = (fresh_path(v.spark, f"{name}-{x}") for x in ("src", "state", "out"))
    for part in _parts(v):
        part.write.mode("append").parquet(src)
        events = jobs.read_events(v.spark, src, v.events.schema)
        jobs.run_available(build(events), state, out, mode, write(out) if write else None)
    return out


@query("R01_abandoned_stream", "", """WITH g AS (SELECT *, CASE WHEN lag(ts) OVER w IS NULL OR ts - lag(ts) OVER w > INTERVAL 45 MINUTE THEN 1 ELSE 0 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
  s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM g)
  SELECT user_id, max(ts) AS dropoff_time, count(*) AS record_cnt FROM s GROUP BY user_id, sid
  HAVING max(CASE WHEN event_type IN ('error', 'purchase') THEN 1 ELSE 0 END) = 0 AND max(ts) + INTERVAL 45 MINUTE <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)""")
def _(v):
    return v.spark.read.parquet(_restarted(v, jobs.abandoned_stream, "abandoned"))


def _windows(v, width, slide, name):
    path = _restarted(v, lambda e: jobs.funnel_stream(e, width, slide), name, "update",
                      lambda out: jobs.foreach_batch_writer(out, [], name))
    out = v.spark.read.parquet(path)
    return pick_one(out, ["window_start"], [F.col("batch_id").desc()]).drop("job", "batch_id")


COUNTS = ", ".join(f"count(*) FILTER (event_type = '{p}') AS n_{p}" for p in ("signup", "view", "click", "purchase", "error"))


@query("R02_funnel_stream", "", f"""SELECT 'tumbling' AS kind, date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 60 MINUTE AS window_end, {COUNTS} FROM events GROUP BY 2
  UNION ALL SELECT 'sliding', time_bucket(INTERVAL 15 MINUTE, ts) - k * INTERVAL 15 MINUTE AS ws, time_bucket(INTERVAL 15 MINUTE, ts) - k * INTERVAL 15 MINUTE + INTERVAL 60 MINUTE, {COUNTS} FROM events, (SELECT unnest([0, 1, 2, 3]) AS k) z GROUP BY ws, 3""")
def _(v):
    a = _windows(v, "60 minutes", None, "tumbling").withColumn("kind", F.lit("tumbling"))
    b = _windows(v, "60 minutes", "15 minutes", "sliding").withColumn("kind", F.lit("sliding"))
    return a.unionByName(b)


@query("R03_dedupe_stream", "", "SELECT DISTINCT user_id, event_type, CAST(ts AS DATE) AS day FROM events")
def _(v):
    def build(events):
        rows = events.select("user_id", "event_type", F.to_date("ts").alias("day"), "ts")
        return jobs.dedupe_stream(rows, ["user_id", "event_type", "day"], "ts", "2 days")
    return v.spark.read.parquet(_restarted(v, build, "deduped")).select("user_id", "event_type", "day")


@query("R04_foreach_batch_writer", "", "SELECT event_id, user_id, event_type, CAST(ts AS DATE) AS business_date FROM events WHERE event_type <> 'error'")
def _(v):
    def build(events):
        return events.filter("event_type <> 'error'").select(
            "event_id", "user_id", "event_type", F.to_date("ts").alias("business_date"))

    def twice(out):
        """A batch that is delivered again must not change the table."""
        write = jobs.foreach_batch_writer(out, ["event_type"], "lists")

        def run(batch, batch_id):
            write(batch, batch_id)
            write(batch, batch_id)
        return run
    out = v.spark.read.parquet(_restarted(v, build, "stream-lists", write=twice))
    return out.select("event_id", "user_id", "event_type", "business_date")


def _clocked(v, parts, instants, build, name):
    """Run a job over parts that arrive one after the other, each before a tick of the clock; the output path."""
    src, clock, state, out = (fresh_path(v.spark, f"{name}-{x}") for x in ("src", "clock", "state", "out"))
    for part, at in zip(parts, instants, strict=True):
        part.write.mode("append").parquet(src)
        keyed.tick(v.spark, clock, RunContext(at))
        events = jobs.read_events(v.spark, src, v.events.schema)
        jobs.run_available(build(events, keyed.read_ticks(v.spark, clock)), state, out)
    return out


FIRST_RUN, LAST_RUN = dt.datetime(2024, 1, 20, 12), dt.datetime(2024, 3, 1)
LATE = "event_id % 10 = 3"      # these arrive with the second run, weeks late


def _arrivals(v):
    now = F.col("ts") < F.lit(FIRST_RUN).cast("timestamp_ntz")
    late = F.expr(LATE)
    return [v.events.filter(now & ~late), v.events.filter(~now | late)]


@query("R01_idle_users", "", f"""WITH a AS (SELECT *, NOT (ts < TIMESTAMP '{FIRST_RUN}' AND NOT {LATE}) AS fresh FROM events),
  g1 AS (SELECT *, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 45 MINUTE THEN 0 ELSE 1 END AS b FROM a WHERE NOT fresh WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
  s1 AS (SELECT *, sum(b) OVER (PARTITION BY user_id ORDER BY ts) AS sid FROM g1),
  r1 AS (SELECT user_id, max(ts) AS dropoff_time, count(*) AS record_cnt, max(event_type IN ('error', 'purchase')) AS closed, min(ts) AS first FROM s1 GROUP BY user_id, sid
    HAVING max(ts) + INTERVAL 45 MINUTE <= TIMESTAMP '{FIRST_RUN}'),
  g2 AS (SELECT *, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 45 MINUTE THEN 0 ELSE 1 END AS b FROM a WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
  s2 AS (SELECT *, sum(b) OVER (PARTITION BY user_id ORDER BY ts) AS sid FROM g2),
  r2 AS (SELECT user_id, max(ts) AS dropoff_time, count(*) AS record_cnt, min(ts) AS first, max(event_type IN ('error', 'purchase')) AS closed, bool_or(fresh) AS fresh FROM s2 GROUP BY user_id, sid)
  SELECT user_id, dropoff_time, record_cnt, 1::INT AS report FROM r1 WHERE NOT closed
  UNION ALL SELECT user_id, dropoff_time, record_cnt, 1 + coalesce((SELECT max(1) FROM r1 WHERE r1.user_id = r2.user_id AND NOT r1.closed AND r1.first >= r2.first AND r1.dropoff_time <= r2.dropoff_time), 0)
  FROM r2 WHERE NOT closed AND (fresh OR dropoff_time + INTERVAL 45 MINUTE > TIMESTAMP '{FIRST_RUN}')""")
def _(v):
    out = _clocked(v, _arrivals(v), [FIRST_RUN, LAST_RUN], lambda e, t: keyed.idle_users(e, t, keep_days=90), "idle")
    return v.spark.read.parquet(out)


@query("R03_contact_limit", "", f"""WITH RECURSIVE s AS (SELECT user_id, event_type, ts, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_type, event_id) AS rn FROM events),
  run AS (SELECT user_id, 0::BIGINT AS rn, []::STRUCT(t TIMESTAMP, l VARCHAR)[] AS sent, NULL::BIGINT AS event_id, false AS ok FROM (SELECT DISTINCT user_id FROM events)
    UNION ALL SELECT s.user_id, s.rn, CASE WHEN len(near) < 3 AND len(list_filter(near, lambda x: x.l = s.event_type)) = 0 THEN list_append(near, {{'t': s.ts, 'l': s.event_type}}) ELSE near END,
      s.event_id, len(near) < 3 AND len(list_filter(near, lambda x: x.l = s.event_type)) = 0
    FROM (SELECT run.user_id, run.rn, s.ts AS at, list_filter(run.sent, lambda x: s.ts - x.t < INTERVAL 2 DAY) AS near FROM run JOIN s ON s.user_id = run.user_id AND s.rn = run.rn + 1) r
    JOIN s ON s.user_id = r.user_id AND s.rn = r.rn + 1)
  SELECT s.user_id, s.event_type, s.ts, s.event_id FROM run JOIN s ON run.event_id = s.event_id AND run.user_id = s.user_id WHERE ok""")
def _(v):
    by_hash = [v.events.filter(f"event_id % 3 {op} 1") for op in ("=", "<>")]      # out of order in both runs
    late = 90 * 1440
    out = _clocked(v, by_hash, [FIRST_RUN, dt.datetime(2024, 6, 1)], lambda e, t: keyed.contact_limit(
        e, t, "user_id", "event_type", "ts", "event_id", most=3, period_days=2, late_minutes=late), "limit")
    return v.spark.read.parquet(out)
