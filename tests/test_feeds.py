"""Load and changes as one log, change feeds, reconciliation, layers, roll-ups."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from helpers import SPEC, T0, log
from test_typed import write
from tidemark.operators.capture import apply_feed, change_feed, cut_over, snapshot_diff
from tidemark.operators.latest import latest_events
from tidemark.operators.marts import key_path, total_by
from tidemark.operators.quality import layer_counts, layer_totals
from tidemark.operators.reconcile import differing_ranges, reconcile
from tidemark.operators.replay import replay_changes
from tidemark.plans import catalog
from tidemark.sources.changes import landing_path, layer_path, read_raw
from tidemark.spec import CUSTOMERS, ORDERS, SPECS, Field, TableSpec
from tidemark.streaming.typed import start_tables

COLS = "k bigint, v string, n int"


def state(df):
    last = latest_events(df, SPEC, method="agg").where("op <> 'D'")
    return sorted((r.k, r.v) for r in last.collect())


@pytest.mark.parametrize("seed", range(2))
def test_any_interleaving_of_load_and_log(spark, seed):
    """Chunks are read at any moment of their windows; the log begins with the first."""
    rnd = random.Random(seed)
    rows = [(0, rnd.randrange(25), rnd.choice("IUUUD"), rnd.randrange(100), f"v{i}") for i in range(250)]
    rows += [(0, 3, "U", rnd.randrange(40, 60), f"hot{i}") for i in range(100)]
    df = log(spark, rows).drop("b", "_bts")
    lows = {c: rnd.randrange(20, 60) for c in range(4)}
    highs = {c: lows[c] + rnd.randrange(0, 30) for c in range(4)}
    load = []
    for k in range(25):
        c = k % 4
        at = rnd.randint(lows[c], highs[c])  # the chunk is read somewhere in its window
        past = sorted(((m, {"D": 3, "U": 2, "I": 1}[op], i, op, v) for i, (_, x, op, m, v) in enumerate(rows) if x == k and m <= at))
        if past and past[-1][3] != "D":
            load.append((k, past[-1][4], -1))
    minute = lambda m: T0 + dt.timedelta(minutes=m)
    marks = spark.createDataFrame([(c, minute(lows[c]), minute(highs[c])) for c in range(4)],
                                  "_chunk int, _low timestamp_ntz, _high timestamp_ntz")
    loaded = spark.createDataFrame(load, "k bigint, v string, seq bigint")
    since = df.where(F.col("ts") >= F.lit(minute(min(lows.values()))))
    whole = cut_over(loaded, since, marks, "CAST(k % 4 AS INT)", SPEC)
    assert state(whole) == state(df)
    assert whole.columns == since.columns


def test_load_rows_give_way_inside_the_window_only(spark):
    df = log(spark, [(0, 1, "U", 10, "in"), (0, 2, "D", 10, None), (0, 3, "U", 5, "before"), (0, 4, "U", 30, "after")]).drop("b", "_bts")
    marks = spark.createDataFrame([(0, T0 + dt.timedelta(minutes=10), T0 + dt.timedelta(minutes=20))],
                                  "_chunk int, _low timestamp_ntz, _high timestamp_ntz")
    load = spark.createDataFrame([(k, "load") for k in range(1, 6)], "k bigint, v string")
    kept = cut_over(load, df, marks, "0", SPEC).where("v = 'load'")
    assert sorted(r.k for r in kept.collect()) == [3, 4, 5]
    assert {(r.op, r.ts) for r in kept.collect()} == {("I", T0 + dt.timedelta(minutes=10))}


def two_states(spark, seed, n=400, changes=25):
    rnd = random.Random(seed)
    a = {k: (rnd.choice([None, "a", "b"]), rnd.choice([None, 1, 2])) for k in range(n)}
    b = dict(a)
    for k in rnd.sample(range(n + 50), changes):
        if k in b and rnd.random() < .4:
            del b[k]
        else:
            b[k] = (rnd.choice([None, "a", "b"]), rnd.choice([None, 1, 2]))
    return [spark.createDataFrame([(k, *v) for k, v in s.items()], COLS).repartition(3) for s in (a, b)] + [a, b]


@pytest.mark.parametrize("seed", [1])
def test_feed_leads_from_one_state_to_the_other(spark, seed):
    prev, curr, a, b = two_states(spark, seed)
    feed = change_feed(prev, curr, ["k"], ["v", "n"])
    got = {r.k: (r.v, r.n) for r in apply_feed(prev, feed, ["k"]).collect()}
    assert got == b
    rows = feed.collect()
    updates = [k for k in a if k in b and a[k] != b[k]]
    assert sorted(r.k for r in rows if r.is_update and r.action == "DELETE") == sorted(updates)
    assert {r.k: (r.v, r.n) for r in rows if r.action == "DELETE"} == {k: a[k] for k in a if a[k] != b.get(k, 0)}
    assert sorted(r.k for r in rows if r.action == "INSERT" and not r.is_update) == sorted(set(b) - set(a))
    assert change_feed(prev, prev, ["k"], ["v", "n"]).count() == 0


@pytest.mark.parametrize("seed", [3])
def test_reconcile_equals_the_join(spark, seed):
    prev, curr, *_ = two_states(spark, seed)
    at = dt.datetime(2024, 1, 1)
    want = snapshot_diff(prev, curr, ["k"], ["v", "n"], at)
    for levels in ((10, 18), (3,), (1, 4, 9)):
        got = reconcile(prev, curr, ["k"], ["v", "n"], at, levels)
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_only_differing_ranges_reach_the_join(spark):
    prev = spark.range(20_000).selectExpr("id AS k", "CAST(id AS STRING) AS v", "CAST(NULL AS INT) AS n")
    curr = prev.withColumn("v", F.when(F.col("k") == 77, "changed").otherwise(F.col("v")))
    assert differing_ranges(prev, curr, ["k"], ["v", "n"], 10).count() == 1
    # A null that moves to another column is a difference, a copy of a row too.
    moved = prev.withColumns({"v": F.when(F.col("k") == 5, F.lit(None).cast("string")).otherwise(F.col("v")),
                              "n": F.when(F.col("k") == 5, F.lit(5)).otherwise(F.col("n"))})
    assert differing_ranges(prev, moved, ["k"], ["v", "n"], 10).count() == 1
    assert differing_ranges(prev, prev.union(prev.where("k = 9")), ["k"], ["v", "n"], 10).count() == 1
    assert differing_ranges(prev, prev.repartition(5), ["k"], ["v", "n"], 10).count() == 0
    out = reconcile(prev, curr, ["k"], ["v", "n"], dt.datetime(2024, 1, 1))
    assert [(r.op, r.k) for r in out.collect()] == [("U", 77)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftSemi") == 4  # two levels on both sides, below the one full outer join
    left = reconcile(prev, curr, ["k"], ["v", "n"], dt.datetime(2024, 1, 1))
    assert left.count() == 1


def test_layers_from_one_scan(spark):
    plan = catalog.layer_counts(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1 and "Join" not in plan
    rnd = random.Random(9)
    df = log(spark, [(rnd.randrange(3), rnd.randrange(30), rnd.choice("IUDD"), rnd.randrange(9), "v") for _ in range(120)])
    table = replay_changes(df, SPEC, "b", "_bts")
    want = layer_counts({"raw": df, "latest": df.select("k").distinct(), "live": table.where("not is_deleted"),
                         "deleted": table.where("is_deleted")})
    got = layer_totals(df, SPEC, "b")
    assert got.columns == want.columns and sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert sorted(r.n for r in layer_totals(df.where("false"), SPEC, "b").collect()) == [0, 0, 0, 0]


def test_totals_along_foreign_keys(spark):
    tables = {
        "customers": spark.createDataFrame([(1, "NY"), (2, "CA"), (3, None)], "customer_id bigint, state string"),
        "orders": spark.createDataFrame([(10, 1), (11, 2), (12, 2), (13, 3), (14, 99), (15, None)], "order_id bigint, customer_id bigint"),
        "order_items": spark.createDataFrame([(10, 5), (10, 6), (11, 7), (12, 8), (13, 9), (14, 10), (15, 11), (77, 12), (None, 1)],
                                             "order_id bigint, a int")}
    assert [p for _, p, _ in key_path("order_items", "state", tables, SPECS)] == ["orders", "customers"]
    got = total_by("order_items", F.col("a"), "state", tables, SPECS)
    assert {r.state: r.total for r in got.collect()} == {"NY": 11, "CA": 15, None: 9}
    assert {r.customer_id: r.total for r in total_by("order_items", F.col("a"), "customer_id", tables, SPECS).collect()} == {
        1: 11, 2: 15, 3: 9, 99: 10, None: 11}
    assert sum(r.total for r in total_by("order_items", F.col("a"), "order_id", tables, SPECS).collect()) == 69
    with pytest.raises(ValueError):
        key_path("orders", "a", tables, SPECS)
    plan = total_by("order_items", F.col("a"), "state", tables, SPECS)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") >= 3


def test_tables_under_one_root_by_their_prefixes(spark, scratch):
    root, base = f"{scratch}/land", f"{scratch}/lake"
    write(spark, f"{landing_path(root, ORDERS)}/2024", [(1, 1.5), (2, 2.5)], "double")
    queries = start_tables(spark, root, base, [ORDERS, CUSTOMERS], f"{scratch}/ck", once=True)
    for q in queries.values():
        q.awaitTermination()
    assert set(queries) == {"orders", "customers"}
    assert sorted(r.order_id for r in read_raw(spark, layer_path(base, "raw", "orders"), ORDERS).collect()) == [1, 2]
    spark.createDataFrame([("I", T0, 7)], "Op string, _timestamp timestamp_ntz, customer_id bigint").write.parquet(
        f"{landing_path(root, CUSTOMERS)}/a")
    for q in start_tables(spark, root, base, [ORDERS, CUSTOMERS], f"{scratch}/ck", once=True).values():
        q.awaitTermination()
    assert read_raw(spark, layer_path(base, "raw", "customers"), CUSTOMERS).count() == 1
    assert read_raw(spark, layer_path(base, "raw", "orders"), ORDERS).count() == 2
    with pytest.raises(ValueError):
        landing_path(root, TableSpec(name="x", keys=("k",), fields=(Field("k", "int"),)))
