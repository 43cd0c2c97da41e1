"""What the queries over several replays and states read and carry."""

from helpers import log
from tidemark.operators.replay import replay_changes
from tidemark.plans import curated as C
from tidemark.spec import CUSTOMERS
from test_backlog import KEYED

SF = "/root/testdata/sf0.001"


def test_replay_of_some_columns(spark):
    df = log(spark, [(1, 1, "I", 1, "a"), (2, 1, "D", 2, "b"), (3, 1, "U", 3, None), (1, 2, "I", 1, "c"), (2, 3, "D", 1, "d")])
    whole = replay_changes(df, KEYED, "b", "_bts", dense=True)
    for columns in (("v",), ("src_created_at",), ("src_created_at", "v"), ()):
        part = replay_changes(df, KEYED, "b", "_bts", dense=True, columns=columns)
        assert [c for c in part.columns if c in ("v", "src_created_at", "src_updated_at")] == sorted(columns, reverse=True)
        assert sorted(map(tuple, part.collect())) == sorted(map(tuple, whole.select(*part.columns).collect()))
    assert "full_name" not in replay_changes(C.change_log(spark, SF, CUSTOMERS), CUSTOMERS, "b", "_bts", columns=["state"]).columns


def test_revenue_carries_only_what_it_sums(spark):
    plan = C.live_revenue(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "state" in plan and not [x for x in ("Main Street", "example.org", "USD") if x in plan]


def test_states_are_folded_once_for_all_levels(spark):
    files = C.reconcile_items(spark, SF).inputFiles()
    assert files and not [f for f in files if "lineitem" in f]
