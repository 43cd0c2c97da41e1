"""Incremental replay and the stateful stream against the closed form."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from helpers import BASE, SPEC, T0, log, replay
from tidemark.functions.ordering import sortable
from tidemark.operators.replay import replay_changes
from tidemark.operators.state import advance, curated, fold_batches, merge_states
from tidemark.sources.changes import raw_columns, raw_schema
from tidemark.spec import ORDERS, Field, TableSpec
from tidemark.streaming.upsert import read_upserts, start_quarantine, start_upsert
from test_equivalence import canon, random_log


@pytest.mark.parametrize("seed", [4])
def test_any_grouping_of_batches(spark, seed):
    rnd = random.Random(seed)
    df = log(spark, random_log(seed, n=220, batches=6)).cache()
    want = canon(replay(df))
    folds = [fold_batches(df.where(F.col("b") == b), SPEC, "b", "_bts").cache() for b in range(6)]
    for _ in range(2):
        parts = list(folds)
        while len(parts) > 1:  # merge any two, in any order
            x, y = parts.pop(rnd.randrange(len(parts))), parts.pop(rnd.randrange(len(parts)))
            parts.append(merge_states(x.unionByName(y), SPEC).cache())
        assert canon(curated(parts[0], SPEC)) == want
    state = None
    for cut in ((0, 1), (2,), (3, 4, 5)):
        state = advance(state, df.where(F.col("b").isin(*cut)), SPEC, "b", "_bts")
    assert canon(curated(state, SPEC)) == want


def test_delete_before_insert_in_another_group(spark):
    df = log(spark, [(2, 1, "D", 5, None), (1, 1, "I", 1, "a"), (3, 2, "D", 1, None)])
    late = fold_batches(df.where("b > 1"), SPEC, "b", "_bts")  # holds deletes of unknown keys only
    assert curated(late, SPEC).count() == 0
    whole = advance(late, df.where("b = 1"), SPEC, "b", "_bts")
    assert [(r.k, r.v, r.is_deleted) for r in curated(whole, SPEC).collect()] == [(1, "a", True)]


def test_merging_states_combines_before_the_exchange(spark):
    state = fold_batches(log(spark, random_log(1)), SPEC, "b", "_bts")
    plan = merge_states(state, SPEC)._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan and "Join" not in plan


def test_sortable_text(spark):
    rnd = random.Random(3)
    pick = lambda make: None if rnd.random() < .15 else make()
    rows = [(pick(lambda: rnd.choice([-2 ** 63, 2 ** 63 - 1, -1, 0, 1, 10, 9])), pick(lambda: rnd.choice(["", "a", "a ", "ab", "é", "B"])),
             pick(lambda: T0 + dt.timedelta(microseconds=rnd.choice([0, 1, 50, 500_000, 10 ** 9]))),
             pick(lambda: dt.date(1960, 1, 1) + dt.timedelta(days=rnd.randrange(40_000))),
             pick(lambda: rnd.randrange(-999, 999) / 100), pick(lambda: rnd.random() < .5)) for _ in range(400)]
    df = spark.createDataFrame(rows, "a bigint, b string, c timestamp_ntz, d date, e double, f boolean").withColumn(
        "e", F.col("e").cast("decimal(8,2)"))
    for cols in (["a", "b"], ["b", "c"], ["c", "e"], ["d", "f"], ["e", "a"], ["f", "b", "d"]):
        x = df.select(*cols, sortable(df, [F.col(c) for c in cols]).alias("t"))
        a = [tuple(r[c] for c in cols) for r in x.orderBy(*[F.col(c).asc_nulls_first() for c in cols]).collect()]
        b = [tuple(r[c] for c in cols) for r in x.orderBy("t").collect()]
        assert a == b


ITEM = TableSpec(
    name="t", curated_name="dim_t", keys=("k",),
    fields=(Field("k", "bigint", nullable=False), Field("v", "string", 10), Field("amount", "decimal(20,4)"),
            Field("big", "bigint"), Field("created", "timestamp_ntz")),
    update_columns=("v", "amount", "big"), insert_only=("created",), has_first_seen=True,
    computed={"shout": "upper(v)"})


def raw_batch(spark, path, rows):
    """rows: (key, op, minute, v) -> one RAW file; the row number breaks ties."""
    import decimal
    data = [(op, None if m is None else T0 + dt.timedelta(minutes=m), k, v,
             None if m is None else decimal.Decimal(m) / 8, None if v is None else 2 ** 60 + (k or 0),
             T0 + dt.timedelta(microseconds=n), BASE, path, n, None) for n, (k, op, m, v) in enumerate(rows)]
    spark.createDataFrame(data, raw_schema(ITEM)).coalesce(1).write.parquet(path)


def table(df):
    return sorted(((r.k, r.v, r.amount, r.big, r.created, r.shout, r.is_deleted) for r in df.collect()), key=lambda r: r[0])


@pytest.mark.parametrize("seed", [1])
def test_stream_equals_replay(spark, scratch, seed):
    rnd = random.Random(seed)
    raw, out, ckpt = (f"{scratch}/{n}" for n in ("raw", "out", "ckpt"))
    batches = [[(rnd.randrange(12), rnd.choice("IIUUUD"), rnd.choice([None, *range(20)]), rnd.choice([None, "a", "b", "c"]))
                for _ in range(rnd.randrange(1, 60))] for _ in range(4)]
    batches[2] += [(None, "I", 1, "z"), (3, "X", 99, "z"), (3, None, 99, "z")]  # quarantined
    history = None
    for b, rows in enumerate(batches):
        raw_batch(spark, f"{raw}/f{b}", rows)
        start_upsert(spark, raw, out, ITEM, ckpt, once=True).awaitTermination()  # a restart each time
        one = spark.read.schema(raw_schema(ITEM)).parquet(f"{raw}/f{b}").select(*raw_columns(ITEM)).withColumns(
            {"b": F.lit(b), "_bts": F.lit(BASE + dt.timedelta(days=b))}).where("k is not null and op in ('I', 'U', 'D')")
        history = one if history is None else history.unionByName(one)
        assert table(read_upserts(spark, out, ITEM)) == table(replay_changes(history, ITEM, "b", "_bts"))
    times = read_upserts(spark, out, ITEM)
    assert times.where("dw_first_seen_at > dw_last_updated_at or dw_first_seen_at is null").count() == 0
    start_quarantine(spark, raw, f"{scratch}/bad", ITEM, f"{scratch}/ckpt2", once=True).awaitTermination()
    assert sorted(r._reject_reason for r in spark.read.parquet(f"{scratch}/bad").collect()) == ["bad_op", "null_key", "null_op"]


def test_batch_costs_its_own_keys(spark, scratch):
    raw, out, ckpt = (f"{scratch}/{n}" for n in ("raw", "out", "ckpt"))
    raw_batch(spark, f"{raw}/f0", [(k, "I", 1, "a") for k in range(300)])
    start_upsert(spark, raw, out, ITEM, ckpt, once=True).awaitTermination()
    raw_batch(spark, f"{raw}/f1", [(5, "U", 2, "b")] * 200 + [(6, "D", 2, None), (900, "D", 2, None)])
    start_upsert(spark, raw, out, ITEM, ckpt, once=True).awaitTermination()
    rows = spark.read.option("recursiveFileLookup", "true").parquet(out)
    assert sorted(r["count"] for r in rows.groupBy("_batch").count().collect()) == [2, 300]
    got = {r.k: (r.v, r.is_deleted) for r in read_upserts(spark, out, ITEM).where("k in (5, 6, 900)").collect()}
    assert got == {5: ("b", False), 6: ("a", True)}


def test_schema_of_a_real_table(spark):
    from tidemark.streaming.upsert import upsert_schema
    names = upsert_schema(ORDERS).fieldNames()
    assert names[0] == "order_id" and "order_status" in names and "dw_last_updated_at" in names
