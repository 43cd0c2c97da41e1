"""The three curated tables, dense keys, and constraints from the specs."""

import datetime as dt
import random
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from helpers import SPEC, log
from tidemark.operators.constraints import compile_rules, constraint_report, foreign_key_report
from tidemark.operators.keys import dense_keys
from tidemark.operators.merge import DEFAULT_BROADCAST_BYTES, broadcast_limit
from tidemark.operators.quality import total_mismatch
from tidemark.operators.state import advance, curated
from tidemark.plans import curated as C
from tidemark.plans.catalog import merge_batches
from tidemark.spec import CUSTOMERS, ORDER_ITEMS, ORDERS, SPECS

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("spec", [CUSTOMERS, ORDERS, ORDER_ITEMS], ids=lambda s: s.name)
def test_merge_replay_and_state_agree_with_keys(spark, spec):
    changes = C.change_log(spark, SF, spec)
    merged = merge_batches(changes, spec)
    assert merged.columns == spec.curated_columns
    want = sorted(map(tuple, merged.collect()), key=repr)
    assert sorted(map(tuple, C.replayed(spark, SF, spec).collect()), key=repr) == want
    first = advance(None, changes.where("b <= 1994"), spec, "b", "_bts")
    whole = advance(first, changes.where("b > 1994"), spec, "b", "_bts")
    assert sorted(map(tuple, curated(whole, spec).select(*merged.columns).collect()), key=repr) == want
    keys = sorted(r[0] for r in merged.select(spec.surrogate_key).collect())
    assert keys == list(range(1, len(keys) + 1)) and keys


def test_dense_keys_do_not_depend_on_settings(spark):
    rows = [(i % 3, random.Random(i).randrange(10 ** 9) * 1000 + i) for i in range(2000)]
    df = spark.createDataFrame(rows, "b int, k bigint").repartition(7)
    want = {k: n + 6 for n, (_, k) in enumerate(sorted(rows))}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for parts in ("1", "5", "40"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            assert {r.k: r.sk for r in dense_keys(df, ["b", "k"], "sk", 5).collect()} == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert dense_keys(df.where("false"), ["b", "k"], "sk").count() == 0


def test_broadcast_limit_is_the_users(spark):
    df, name = spark.range(1), "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    try:
        for text, size in (("-1", -1), ("200MB", 200 << 20), ("1048576", 1 << 20), ("10485760b", DEFAULT_BROADCAST_BYTES)):
            spark.conf.set(name, text)
            assert broadcast_limit(df) == size
        assert broadcast_limit(df, 7) == 7
    finally:
        spark.conf.set(name, before)


def customers(spark):
    base = dict(last_name="L", phone=None, created_at=dt.datetime(2024, 1, 1))
    rows = [
        (1, "A", "a@x", "ACTIVE", "US"), (2, None, "b@x", "CLOSED", "US"), (3, "C", "a@x", None, "x" * 60),
        (4, "D" * 101, None, "ACTIVE", None), (4, "E", None, "INACTIVE", "US"), (None, "F", "a@x", "SUSPENDED", "US")]
    df = spark.createDataFrame(rows, "customer_id bigint, first_name string, email string, customer_status string, country string")
    return df.withColumns({k: F.lit(v).cast("string" if k == "phone" else "timestamp" if k == "created_at" else "string")
                           for k, v in base.items()})


def test_constraint_report(spark):
    got = {(r.rule, r.col): (r.n_rows, r.n_bad) for r in constraint_report(customers(spark), CUSTOMERS).collect()}
    assert {v[0] for v in got.values()} == {6}
    bad = {k: v[1] for k, v in got.items() if v[1]}
    assert bad == {("not_null", "customer_id"): 1, ("not_null", "first_name"): 1, ("not_null", "email"): 2,
                   ("domain", "customer_status"): 1, ("too_long", "first_name"): 1, ("too_long", "country"): 1,
                   ("unique", "customer_id"): 1, ("unique", "email"): 2}
    assert ("not_null", "last_name") in got and ("too_long", "city") not in got  # no such column here
    empty = constraint_report(customers(spark).where("false"), CUSTOMERS).collect()
    assert len(empty) == len(got) and {(r.n_rows, r.n_bad) for r in empty} == {(0, 0)}


def test_unique_lists_of_several_columns(spark):
    rows, rnd = [], random.Random(4)
    for _ in range(500):
        rows.append((rnd.choice([None, 1, 2, 3]), rnd.choice([None, "a", 'a"', "b,c", ""]), rnd.randrange(5)))
    df = spark.createDataFrame(rows, "x int, y string, k bigint")
    from dataclasses import replace
    spec = replace(SPEC, fields=(), unique=(("x", "y"), ("y",)))
    got = {r.col: r.n_bad for r in constraint_report(df, spec).where("rule = 'unique'").collect()}
    both = Counter((x, y) for x, y, _ in rows if x is not None and y is not None)
    one = Counter(y for _, y, _ in rows if y is not None)
    assert got == {"k": 495, "x,y": sum(both.values()) - len(both), "y": sum(one.values()) - len(one)}


def test_one_scan_and_one_wide_shuffle_per_table(spark):
    df = spark.read.parquet(f"{SF}/orders.parquet").withColumnsRenamed(
        {"o_orderkey": "order_id", "o_custkey": "customer_id", "o_orderstatus": "status"})
    plan = constraint_report(df, ORDERS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1 and plan.count("Exchange hashpartitioning") == 1
    assert len(compile_rules(ORDERS, df.columns)[0]) >= 4


def test_foreign_keys(spark):
    o = spark.createDataFrame([(1, 10), (2, 10), (3, 99), (4, None), (5, 99)], "order_id bigint, customer_id bigint")
    c = spark.createDataFrame([(10,), (11,), (None,)], "customer_id bigint")
    got = foreign_key_report({"orders": o, "customers": c}, SPECS).collect()
    assert [tuple(r) for r in got] == [("fact_orders", "foreign_key", "customer_id", 5, 2)]


def test_every_kind_of_rule_bites_in_the_query(spark):
    bad = {r.rule for r in C.constraint_report(spark, "/root/testdata/sf0.01").where("n_bad > 0 and n_bad < n_rows").collect()}
    assert bad == {"not_null", "domain", "too_long", "unique", "foreign_key"}


def test_null_total_is_a_mismatch(spark):
    p = spark.createDataFrame([(1, Decimal("3.00")), (2, None), (3, Decimal("0.00"))], "k int, t decimal(12,2)")
    li = spark.createDataFrame([(1, 1), (1, 2), (2, 5)], "k int, a int")
    got = total_mismatch(p, li, "k", "t", F.col("a")).collect()
    assert [(r.k, r.stored_total, r.line_sum) for r in got] == [(2, None, Decimal("5.00"))]


def test_checks_find_some_rows_but_not_all(spark):
    for query, table in ((C.line_total_check, "lineitem"), (C.order_total_check, "orders")):
        n = spark.read.parquet(f"{SF}/{table}.parquet").count()
        assert 0 < query(spark, SF).count() < n


def test_log_of_literal_rows_needs_no_keys(spark):
    assert "customer_key" not in merge_batches(log(spark, [(1, 1, "I", 1, "a")]), SPEC).columns
