"""Streams on a file source in a fresh folder."""

import datetime as dt

from pyspark.sql import functions as F

from lendreach.session import fresh_path
from lendreach.sources.writers import replace_run
from lendreach.streaming import jobs

SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string"
T0 = dt.datetime(2024, 1, 1, 12)


def write(spark, path, rows):
    spark.createDataFrame([(i, T0 + dt.timedelta(minutes=m), u, e) for i, (m, u, e) in enumerate(rows)],
                          SCHEMA).coalesce(1).write.mode("append").parquet(path)


def stream(spark, path):
    return jobs.read_events(spark, path, spark.createDataFrame([], SCHEMA).schema)


def test_sessions_close_only_when_later_events_arrive(spark):
    src = fresh_path(spark, "src")
    write(spark, src, [(0, 1, "view"), (30, 1, "view"), (0, 2, "error"), (5, 3, "view"), (50, 3, "view"), (200, 9, "view")])
    out = jobs.run_available(jobs.abandoned_stream(stream(spark, src)), fresh_path(spark, "state"), fresh_path(spark, "out"))
    got = spark.read.schema("user_id bigint, dropoff_time timestamp_ntz, record_cnt bigint").parquet(out)
    want = {1: (T0 + dt.timedelta(minutes=30), 2), 3: (T0 + dt.timedelta(minutes=50), 2)}
    assert {r.user_id: (r.dropoff_time, r.record_cnt) for r in got.collect()} == want


def test_funnel_counts_every_window(spark):
    src, out = fresh_path(spark, "src"), fresh_path(spark, "out")
    write(spark, src, [(0, 1, "view"), (59, 2, "signup"), (61, 2, "view")])
    jobs.run_available(jobs.funnel_stream(stream(spark, src)), fresh_path(spark, "state"), out, "update",
                       jobs.foreach_batch_writer(out, [], "funnel"))
    got = {r.window_start: (r.n_view, r.n_signup) for r in spark.read.parquet(out).collect()}
    assert got == {T0: (1, 1), T0 + dt.timedelta(hours=1): (1, 0)}


def test_repeats_are_dropped(spark):
    src = fresh_path(spark, "src")
    write(spark, src, [(0, 1, "view"), (3, 1, "view"), (4, 1, "click"), (4, 2, "view")])
    df = jobs.dedupe_stream(stream(spark, src), ["user_id", "event_type"], "ts", "1 day")
    out = jobs.run_available(df, fresh_path(spark, "state"), fresh_path(spark, "out"))
    assert spark.read.schema(df.schema).parquet(out).count() == 3


def test_a_batch_delivered_twice_is_written_once(spark):
    out = fresh_path(spark, "twice")
    write_batch = jobs.foreach_batch_writer(out, ["event_type"], "lists")
    batch = spark.createDataFrame([(1, "view"), (2, "click")], "event_id int, event_type string")
    write_batch(batch, 0)
    write_batch(batch, 0)
    write_batch(batch.filter("event_id = 1"), 1)
    assert spark.read.parquet(out).groupBy("batch_id").agg(F.count("*").alias("n")).orderBy("batch_id").collect() == [
        (0, 2), (1, 1)]


def test_a_restart_keeps_output_and_state(spark):
    src, state, out = (fresh_path(spark, x) for x in ("src", "state", "out"))
    for rows in ([(0, 1, "view"), (1, 2, "view")], [(2, 1, "view"), (3, 3, "view")]):
        write(spark, src, rows)
        df = jobs.dedupe_stream(stream(spark, src), ["user_id", "event_type"], "ts", "1 day")
        jobs.run_available(df, state, out, writer=jobs.foreach_batch_writer(out, [], "lists"))
    got = spark.read.parquet(out)
    assert sorted(r.user_id for r in got.collect()) == [1, 2, 3]
    assert got.select("batch_id").distinct().count() >= 2


def test_an_empty_run_clears_its_own_partition(spark):
    path = fresh_path(spark, "lists")
    rows = spark.createDataFrame([("2024-01-02", "A", 1), ("2024-01-02", "B", 2)],
                                 "business_date string, list_module string, x int")
    replace_run(rows, path, runs=[("2024-01-02", "A"), ("2024-01-02", "B")])
    replace_run(rows.filter("x = 0"), path, runs=[("2024-01-02", "A"), ("2024-01-03", "A")])
    assert [(r.list_module, r.x) for r in spark.read.parquet(path).collect()] == [("B", 2)]
