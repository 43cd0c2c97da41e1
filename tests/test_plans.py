"""Plan shape: the scale properties the design relies on are in the plans."""

import datetime as dt

from pyspark.sql import functions as F

from helpers import SPEC, log
from tidemark.operators.keys import assign_keys
from tidemark.operators.latest import latest_events
from tidemark.operators.merge import empty_target, merge_changes
from tidemark.plans import catalog as C

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_has_partial_limit_before_shuffle(spark):
    p = plan(C.latest_item(spark, SF))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_small_delta_merge_is_broadcast_and_target_not_shuffled(spark):
    df = log(spark, [(1, k, "I", 1, "a") for k in range(5)])
    latest = latest_events(df, SPEC)
    target = empty_target(spark, SPEC, latest.schema)
    merged = merge_changes(target, latest, SPEC, dt.datetime(2024, 1, 1))
    p = plan(merged)
    assert p.count("BroadcastHashJoin") >= 2 and "SortMergeJoin" not in p


def test_window_filter_reaches_scan(spark):
    p = plan(C.last_24h(spark, SF))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in p


def test_star_aggregates_below_joins(spark):
    p = plan(C.star_revenue(spark, SF))
    # aggregates sit below the joins: one partial aggregate per level
    assert p.count("HashAggregate") >= 6


def test_surrogate_keys_unique_across_batches(spark):
    a = spark.range(0, 1000).withColumnRenamed("id", "k")
    b = spark.range(1000, 1500).withColumnRenamed("id", "k")
    ka = assign_keys(a, ["k"], "sk", 0, slots=16)
    top = ka.agg(F.max("sk")).first()[0]
    assert top <= 0 + 1000 * 16
    kb = assign_keys(b, ["k"], "sk", 1000 * 16, slots=16)
    both = ka.unionByName(kb)
    assert both.select("sk").distinct().count() == 1500
    again = assign_keys(a.orderBy(F.desc("k")), ["k"], "sk", 0, slots=16)
    assert sorted(ka.collect()) == sorted(again.collect())  # stable for a key set
