"""What a job leaves on disk: shuffles, frames stored on the way, copies of wide rows."""

import datetime as dt
import re
import time
from pathlib import Path

from pyspark.sql import functions as F

from lendreach.checks import q_measure as q
from lendreach.checks.views import Views
from lendreach.operators import joins
from lendreach.session import Scratch, cut_lean
from lendreach.sources.colocated import settings

SMALL = "/root/testdata/sf0.001"
LARGE_JOINS = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().toString()
    return set(re.findall(r"shuffle_\d+_\d+_\d+\.data", files))


def test_shuffles_leave_the_disk_with_the_write(spark):
    df = spark.range(2000).repartition(3).withColumn("k", F.col("id") % 7)
    before = shuffle_files(spark)
    out = cut_lean(df.groupBy("k").count())
    until = time.time() + 20        # they are removed on the side
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert sorted(map(tuple, out.collect())) == [(k, len(range(k, 2000, 7))) for k in range(7)]


def test_scratch_is_deleted_when_the_block_ends(spark):
    with Scratch(spark) as near:
        a = near.cut(spark.range(5), "near")
        b = cut_lean(a.withColumn("x", F.lit(1)), "kept")
        assert Path(near.paths[0]).exists()
        at = near.paths[0]
    assert not Path(at).exists() and b.count() == 5


def test_wide_rows_of_the_fact_are_moved_once(spark):
    fact = q.fact(Views(spark, SMALL))
    with settings(spark, LARGE_JOINS):
        plan = fact.filter("true")._jdf.queryExecution().executedPlan()
    exchanges = [x for x in re.findall(r"Exchange hashpartitioning\(([a-z_]+)#", plan.toString())]
    assert set(exchanges) == {"_row"} and len(exchanges) == 5       # the stored rows and what was found by four keys


def test_values_as_of_a_time_are_the_largest_before_it(spark):
    def at(m):
        return dt.datetime(2024, 3, 4) + dt.timedelta(minutes=m)
    a = spark.createDataFrame([(k, None if m is None else at(m)) for k, m in [(1, 10), (1, 20), (1, 20), (2, 5), (None, 5), (1, None)]], "k int, t timestamp_ntz")
    h = spark.createDataFrame([(k, at(m), v) for k, m, v in [(1, 9, 3), (1, 9, 4), (1, 15, None), (2, 5, 8), (None, 1, 7)]], "k int, t timestamp_ntz, v int")
    with settings(spark, LARGE_JOINS):
        got = joins.asof_previous(a, ["k"], "t", {"v": (h, "v"), "w": (h.filter("v <> 4"), "v")})
        plan = got._jdf.queryExecution().executedPlan().toString()
    want = [(1, at(10), 4, 3), (1, at(20), 4, 3), (1, at(20), 4, 3), (2, at(5), None, None), (None, at(5), None, None), (1, None, None, None)]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert len(re.findall(r"Exchange hashpartitioning\(k#\d+, t#\d+", plan)) <= 4     # the histories are not grouped one by one
