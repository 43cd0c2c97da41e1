"""Sources, the snapshot sink and the two streaming queries end to end."""

import datetime as dt
import os
from decimal import Decimal

from pyspark.sql import functions as F

from tidemark.operators.audit import ingest_status, load_history, run_history, table_counts
from tidemark.operators.latest import latest_events
from tidemark.operators.replay import replay_changes
from tidemark.sources.changes import (layer_path, list_files, read_changes, read_raw, to_raw)
from tidemark.sources.seed import seed_tables
from tidemark.sources.snapshot import SnapshotTable
from tidemark.spec import CUSTOMERS, ORDER_ITEMS
from tidemark.streaming.pipeline import read_audit, start_ingest, start_merge

NOW = dt.datetime(2024, 3, 1, 12)
TODAY = dt.date(2024, 3, 1)


def _change_file(spark, path, rows):
    """rows: (Op, minute, customer_id, first_name, last_name)"""
    df = spark.createDataFrame(
        [(op, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m), k, f, l, "x@y", "NY",
          NOW, NOW) for op, m, k, f, l in rows],
        "Op string, _timestamp timestamp_ntz, customer_id bigint, first_name string, "
        "last_name string, email string, state string, created_at timestamp, "
        "updated_at timestamp")
    df.coalesce(1).write.mode("overwrite").parquet(path)


def test_seed_counts(spark):
    seed = seed_tables(spark, TODAY, NOW)
    counts = {r["tbl"]: r["n"] for r in table_counts(seed).collect()}
    assert counts == {"customers": 5, "orders": 5, "order_items": 6}
    o = {r["order_id"]: r for r in seed["orders"].collect()}
    assert o[1]["order_date"] == TODAY - dt.timedelta(days=10) and o[1]["currency"] == "USD"
    items = seed["order_items"]
    assert items.agg(F.sum("line_total")).first()[0] == Decimal("879.74")
    assert set(items.columns) == set(ORDER_ITEMS.field_names)


def test_read_changes_parquet_and_csv(spark, scratch):
    land = f"{scratch}/public/customers"
    _change_file(spark, f"{land}/f1", [("I", 1, 1, "Ann", "Lee"), ("U", 2, 1, "Ann", "Kim")])
    raw = to_raw(read_changes(spark, land, CUSTOMERS), CUSTOMERS, NOW)
    rows = raw.orderBy("_source_file_row").collect()
    assert [r["op"] for r in rows] == ["I", "U"]
    assert [r["_source_file_row"] for r in rows] == [0, 1]
    assert rows[0]["_source_file"].endswith(".parquet") and rows[0]["phone"] is None
    csv_dir = f"{scratch}/csv"
    os.makedirs(csv_dir)
    with open(f"{csv_dir}/c.csv", "w") as fh:
        fh.write("Op,_timestamp,customer_id,first_name\nI,2024-01-01 00:00:00,9,Zed\n")
    c = read_changes(spark, csv_dir, CUSTOMERS, fmt="csv").first()
    assert (c["op"], c["customer_id"], c["first_name"]) == ("I", "9", "Zed")
    files = list_files(spark, land, "*.parquet")
    assert files.count() == 1
    st = ingest_status(files, raw).first()
    assert (st["landed"], st["loaded"], st["pending"]) == (1, 1, 0)
    hist = load_history(raw).collect()
    assert hist[0]["row_count"] == 2
    assert layer_path("hdfs://nn/lake/", "RAW", "customers") == "hdfs://nn/lake/raw/customers"


def test_snapshot_table_idempotent_and_keys(spark, scratch):
    land = f"{scratch}/land"
    _change_file(spark, f"{land}/a", [("I", 1, k, f"n{k}", "x") for k in range(20)])
    _change_file(spark, f"{land}/b", [("U", 5, 3, "new", "x"), ("D", 6, 4, None, None),
                                      ("I", 7, 99, "z", "z")])
    table = SnapshotTable(spark, f"{scratch}/dim", CUSTOMERS, n_buckets=4)
    for i, part in enumerate(("a", "b")):
        ch = read_changes(spark, f"{land}/{part}", CUSTOMERS)
        ch = to_raw(ch, CUSTOMERS, NOW).withColumnsRenamed(
            {"created_at": "src_created_at", "updated_at": "src_updated_at"})
        latest = latest_events(ch, CUSTOMERS)
        assert table.apply(latest, i, NOW + dt.timedelta(hours=i)) is True
        assert table.apply(latest, i, NOW) is False  # replayed batch: no-op
    out = {r["customer_id"]: r for r in table.read().collect()}
    assert len(out) == 21
    assert out[3]["first_name"] == "new" and out[3]["full_name"] == "new x"
    assert out[4]["is_deleted"] and out[4]["first_name"] == "n4"
    keys = [r["customer_key"] for r in out.values()]
    assert len(set(keys)) == 21 and min(keys) >= 1
    assert out[99]["customer_key"] > max(out[k]["customer_key"] for k in range(20))
    assert table.last_batch_id() == 1


def test_streaming_ingest_and_merge(spark, scratch):
    land, raw_path = f"{scratch}/land", f"{scratch}/raw"
    os.makedirs(land)
    table = SnapshotTable(spark, f"{scratch}/dim", CUSTOMERS, n_buckets=2)
    audit = f"{scratch}/audit"

    def run_both():
        q = start_ingest(spark, land, raw_path, CUSTOMERS, f"{scratch}/ck_in", once=True)
        q.awaitTermination()
        m = start_merge(spark, raw_path, table, CUSTOMERS, f"{scratch}/ck_merge", once=True,
                        audit_path=audit, quarantine_path=f"{scratch}/bad")
        m.awaitTermination()

    _change_file(spark, f"{land}/f1", [("I", 1, 1, "a", "a"), ("I", 1, 2, "b", "b"),
                                       (None, 1, 3, "c", "c")])
    run_both()
    _change_file(spark, f"{land}/f2", [("U", 2, 1, "a2", "a"), ("D", 3, 2, None, None)])
    run_both()
    run_both()  # nothing new: no batch, no change
    got = {r["customer_id"]: (r["first_name"], r["is_deleted"]) for r in table.read().collect()}
    assert got == {1: ("a2", False), 2: ("b", True)}
    raw = read_raw(spark, raw_path, CUSTOMERS)
    assert raw.count() == 5  # each file ingested once across restarts
    # same files, one closed-form replay with file order as batch order
    log = raw.withColumnsRenamed({"created_at": "src_created_at", "updated_at": "src_updated_at"})
    log = log.where(F.col("op").isNotNull()).withColumn(
        "_bn", F.dense_rank().over(__import__("pyspark.sql").sql.Window.orderBy("_source_file")))
    rep = replay_changes(log, CUSTOMERS, "_bn", "_bn", with_keys=False)
    assert {r["customer_id"]: (r["first_name"], r["is_deleted"]) for r in rep.collect()} == got
    a = read_audit(spark, audit)
    assert a.count() == 2 and a.agg(F.sum("rows_rejected")).first()[0] == 1
    assert run_history(a, limit=1).first()["batch_id"] == 1
