"""Tables in buckets of a key: no shuffle where all have few rows a key, heavy keys apart, equal rows."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from lendreach.checks import q_measure as q
from lendreach.checks.views import Views
from lendreach.plans import facts
from lendreach.sources.colocated import KEEP_BUCKETS, CoLocated, settings

SMALL = "/root/testdata/sf0.001"
NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
ARGS = ("Own Web", ("Provider 1",), q.FIRST_DAY)


def bag(df):
    return Counter(map(tuple, df.collect()))


@pytest.fixture(scope="module")
def tables(spark):
    return q.fact_tables(Views(spark, SMALL))


def test_heavy_keys_stand_apart_and_no_row_is_lost(spark):
    rows = [(1, i) for i in range(100)] + [(None, i) for i in range(100)] + [(2 + i % 50, i) for i in range(100)]
    df = spark.createDataFrame(rows, "k bigint, x bigint")
    buckets = CoLocated(spark, 8, least=10)
    heavy = buckets.heavy_keys([(df, "k")])
    assert {r[0] for r in heavy.collect()} == {1, None}
    part = buckets.split(df, "t", "k", heavy)
    assert bag(part.heavy) == Counter(rows[:200]) and bag(part.even) == Counter(rows[200:])
    assert bag(part.all()) == Counter(rows)
    none = buckets.split(df.limit(0), "none", "k", buckets.heavy_keys([(df.limit(0), "k")]))
    assert none.all().count() == 0
    assert buckets.heavy_keys([(df, "k"), (df.filter("k > 3"), "k")]).count() == 2
    assert CoLocated(spark, 8).heavy_keys([(df, "k")]).count() == 0     # no key has 100,000 rows


def test_settings_come_back(spark):
    key = next(iter(KEEP_BUCKETS))
    before = spark.conf.get(key, None)
    with pytest.raises(ZeroDivisionError), settings(spark, KEEP_BUCKETS):
        assert spark.conf.get(key) == "false"
        1 / 0
    assert spark.conf.get(key, None) == before


def test_customer_joins_do_not_shuffle(spark, tables):
    store = facts.ColocatedFact.write(tables, CoLocated(spark, 4))
    base = store.buckets.write(store.even.leads.filter("isuniqueaccept = 1"), "base", "lms_customer_id")
    with settings(spark, KEEP_BUCKETS | NO_BROADCAST):
        plan = facts.by_customer(base, store.even, even=True)._jdf.queryExecution().executedPlan().toString()
        plain = facts.by_customer(base, tables)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert "Exchange" in plain


@pytest.mark.parametrize("least", [100_000, 6])
def test_fact_equals_the_plain_one(spark, tables, least):
    store = facts.ColocatedFact.write(tables, CoLocated(spark, 4, share=0.001, least=least))
    assert bool(store.heavy.leads.count()) == (least == 6)
    want = facts.application_fact(q.FACT_CTX, tables, *ARGS)
    got = store.fact(q.FACT_CTX, *ARGS)
    assert got.columns == want.columns and bag(got) == bag(want)
    assert got.filter(F.col("is_originated") == 1).count() > 0
