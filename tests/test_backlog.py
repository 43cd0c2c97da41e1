"""Batches that are all at hand: applied in runs, equal to one MERGE a batch."""

import dataclasses
import random

import pytest
from pyspark.sql import functions as F

from helpers import SPEC, day, log
from tidemark.operators.latest import latest_events
from tidemark.operators.merge import empty_target, merge_changes
from tidemark.plans import catalog

KEYED = dataclasses.replace(SPEC, surrogate_key="sk")


def rows(seed, batches=7):
    """Unknown and null ops, null keys and values, ties of equal order apart from ``seq``."""
    rnd = random.Random(seed)
    return [(rnd.randrange(batches), rnd.choice([None, *range(15)]), rnd.choice(["I", "U", "U", "D", "X", None]),
             rnd.choice([None, *range(6)]), rnd.choice([None, "a", "b"])) for _ in range(220)]


def one_by_one(spark, df, spec, strategy):
    target = None
    for b in sorted(r[0] for r in df.select("b").distinct().collect()):
        latest = latest_events(df.where(F.col("b") == b), spec)
        target = empty_target(spark, spec, latest.schema) if target is None else target
        target = merge_changes(target, latest, spec, day(b), strategy=strategy, dense=True,
                               key_base=target.count() if spec.surrogate_key else 0).localCheckpoint()
    return target


def canon(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("run", [1, 3, 16])
@pytest.mark.parametrize("spec", [SPEC, KEYED], ids=["plain", "keyed"])
def test_runs_of_batches_equal_single_merges(spark, monkeypatch, spec, run):
    monkeypatch.setattr(catalog, "RUN", run, raising=False)
    df = log(spark, rows(run)).cache()
    want = canon(one_by_one(spark, df, spec, "shuffle"))
    got = catalog.merge_batches(df, spec)
    assert got.columns == spec.curated_columns
    assert canon(got) == want and len(want) > 15  # null keys never meet each other


def test_log_moves_once_and_the_table_is_not_written_between_batches(spark):
    out = catalog.merge_batches(log(spark, rows(9)), SPEC)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "tidemark-" not in plan and "parquet" not in plan.lower()
    initial = plan.split("Initial Plan")[-1]
    assert initial.count("Exchange hashpartitioning") == 1 and "Join" not in initial


def test_empty_log_gives_the_empty_table(spark):
    out = catalog.merge_batches(log(spark, rows(1)).where("false"), SPEC)
    assert out.columns == SPEC.curated_columns and out.count() == 0
