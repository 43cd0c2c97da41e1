"""Streams as they are run: repeats, early starts, several tables, failures."""

import datetime as dt
import os
import shutil
import time

import pytest
from pyspark.sql import functions as F

from test_pipeline import _change_file
from tidemark.operators.audit import run_history
from tidemark.operators.quality import orphans
from tidemark.sources.changes import file_schema, raw_schema, read_raw
from tidemark.sources.snapshot import SnapshotTable
from tidemark.spec import CUSTOMERS, ORDER_ITEMS, ORDERS
from tidemark.streaming.monitor import RunLog, read_runs
from tidemark.streaming.pipeline import merge_batch, read_audit, start_ingest, start_merge
from tidemark.streaming.references import open_orphans, start_orphan_watch


def names(spark, table):
    return {r.customer_id: (r.first_name, r.is_deleted) for r in table.read().collect()}


@pytest.mark.parametrize("stage", ["ingest", "merge"])
def test_a_file_delivered_twice_changes_nothing(spark, scratch, stage):
    land, raw, ck = f"{scratch}/land", f"{scratch}/raw", f"{scratch}/ck"
    table = SnapshotTable(spark, f"{scratch}/dim", CUSTOMERS)
    within = {"repeats_within": "2 hours"}

    def run():
        start_ingest(spark, land, raw, CUSTOMERS, f"{ck}/i", once=True, **(within if stage == "ingest" else {})).awaitTermination()
        start_merge(spark, raw, table, CUSTOMERS, f"{ck}/m", once=True, **(within if stage == "merge" else {})).awaitTermination()

    _change_file(spark, f"{land}/f1", [("I", 1, 1, "Ann", "Lee"), ("I", 1, 2, "Bob", "Ray")])
    run()
    _change_file(spark, f"{land}/f2", [("U", 5, 1, "Anna", "Lee"), ("D", 6, 2, "Bob", "Ray")])
    run()
    want = {1: ("Anna", False), 2: ("Bob", True)}
    assert names(spark, table) == want
    shutil.copytree(f"{land}/f1", f"{land}/f1-again")  # the first file once more, under another name
    run()
    assert names(spark, table) == want
    # An old event that comes late for the first time is no repeat.
    _change_file(spark, f"{land}/f3", [("I", 0, 3, "Cy", "Old"), ("U", 1, 1, "Annie", "Lee")])
    run()
    assert names(spark, table)[3] == ("Cy", False) and names(spark, table)[1] == ("Annie", False)
    assert read_raw(spark, raw, CUSTOMERS).count() == (6 if stage == "ingest" else 8)


def test_merge_starts_before_the_first_ingest_and_skips_empty_files(spark, scratch):
    land, raw = f"{scratch}/land", f"{scratch}/raw"
    table = SnapshotTable(spark, f"{scratch}/dim", CUSTOMERS)
    q = start_merge(spark, raw, table, CUSTOMERS, f"{scratch}/m", schedule="1 second", audit_path=f"{scratch}/audit")
    try:
        _change_file(spark, f"{land}/empty", [])
        start_ingest(spark, land, raw, CUSTOMERS, f"{scratch}/i", once=True).awaitTermination()
        q.processAllAvailable()
        assert not os.path.exists(f"{scratch}/audit")  # a file without rows is no run
        _change_file(spark, f"{land}/f1", [("I", 1, 1, "Ann", "Lee")])
        start_ingest(spark, land, raw, CUSTOMERS, f"{scratch}/i", once=True).awaitTermination()
        q.processAllAvailable()
        assert names(spark, table) == {1: ("Ann", False)} and q.isActive
    finally:
        q.stop()
    assert [r.state for r in read_audit(spark, f"{scratch}/audit").collect()] == ["SUCCEEDED"]


def _land(spark, path, spec, key, n):
    """A change file of ``n`` inserts with the spec's required columns."""
    df = spark.range(n).select(*[
        F.lit("I").alias("Op"), F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz").alias("_timestamp"),
        *[F.col("id").cast(f.dataType).alias(f.name) if f.name in (key, "customer_id", "order_id", "product_id")
          else F.lit(None).cast(f.dataType).alias(f.name) for f in spec.schema.fields]])
    df.coalesce(1).write.mode("overwrite").parquet(path)
    assert df.columns == file_schema(spec).fieldNames()


def test_three_tables_at_once_one_stopped_and_restarted(spark, scratch):
    specs = {s.name: s for s in (CUSTOMERS, ORDERS, ORDER_ITEMS)}
    tables = {n: SnapshotTable(spark, f"{scratch}/{s.curated_name}", s) for n, s in specs.items()}
    start = lambda n: start_merge(spark, f"{scratch}/raw/{n}", tables[n], specs[n], f"{scratch}/ck/{n}", schedule="1 second")
    queries = {n: start(n) for n in specs}

    def load(spec, key, n, name):
        _land(spark, f"{scratch}/land/{spec.source_prefix}/{name}", spec, key, n)
        start_ingest(spark, f"{scratch}/land/{spec.source_prefix}", f"{scratch}/raw/{spec.name}", spec,
                     f"{scratch}/ci/{spec.name}", once=True).awaitTermination()

    try:
        load(ORDER_ITEMS, "item_id", 6, "a")  # facts first: no table waits for another
        queries["order_items"].processAllAvailable()
        load(CUSTOMERS, "customer_id", 5, "a")
        queries["orders"].stop()
        load(ORDERS, "order_id", 4, "a")
        queries["customers"].processAllAvailable()
        assert tables["customers"].read().count() == 5 and tables["order_items"].read().count() == 6
        assert not queries["orders"].isActive and queries["customers"].isActive
        queries["orders"] = start("orders")
        queries["orders"].processAllAvailable()
        assert tables["orders"].read().count() == 4
    finally:
        for q in queries.values():
            q.stop()
    assert not any(q.isActive for q in queries.values())


def test_a_failed_run_is_in_the_history(spark, scratch):
    raw = spark.createDataFrame([], read_schema()).unionByName(
        spark.createDataFrame([("I", dt.datetime(2024, 1, 1), 1)], "op string, _captured_at timestamp_ntz, customer_id bigint"),
        allowMissingColumns=True)

    class Broken(SnapshotTable):
        def apply(self, *a, **k):
            raise RuntimeError("no space left")

    audit = f"{scratch}/audit"
    with pytest.raises(RuntimeError):
        merge_batch(raw, 0, Broken(spark, f"{scratch}/dim", CUSTOMERS), CUSTOMERS, audit_path=audit, source="s")
    time.sleep(0.01)
    assert merge_batch(raw, 0, SnapshotTable(spark, f"{scratch}/dim", CUSTOMERS), CUSTOMERS, audit_path=audit, source="s")
    got = [(r.batch_id, r.state, r.error, r.rows_in) for r in run_history(read_audit(spark, audit)).collect()]
    assert got == [(0, "SUCCEEDED", None, 1), (0, "FAILED", "RuntimeError: no space left", 1)]


def test_the_listener_logs_batches_and_failures(spark, scratch):
    log = RunLog(spark, f"{scratch}/runs")
    spark.streams.addListener(log)
    try:
        _change_file(spark, f"{scratch}/land/f1", [("I", 1, 1, "Ann", "Lee"), ("U", 2, 1, "Ann", "Kim")])
        start_ingest(spark, f"{scratch}/land", f"{scratch}/raw", CUSTOMERS, f"{scratch}/i", once=True).awaitTermination()
        start_ingest(spark, f"{scratch}/land", f"{scratch}/raw", CUSTOMERS, f"{scratch}/i", once=True).awaitTermination()

        class Broken(SnapshotTable):
            def apply(self, *a, **k):
                raise RuntimeError("no space left")

        with pytest.raises(Exception):
            start_merge(spark, f"{scratch}/raw", Broken(spark, f"{scratch}/d", CUSTOMERS), CUSTOMERS, f"{scratch}/m",
                        once=True).awaitTermination()
        for _ in range(100):  # the listener runs beside the queries
            if len([f for f in os.listdir(f"{scratch}/runs") if f.endswith(".json") and not f.startswith(".")]) == 2:
                break
            time.sleep(0.1)
        got = run_history(read_runs(spark, f"{scratch}/runs")).collect()
    finally:
        spark.streams.removeListener(log)
    by = {r.state: r for r in got}
    assert len(got) == 2 and set(by) == {"SUCCEEDED", "FAILED"}
    done = by["SUCCEEDED"]
    assert (done.batch_id, done.rows_in, done.observed, done.error) == (0, 2, {"ingest": {"rows": 2, "rejected": 0}}, None)
    assert done.duration_ms > 0 and "no space left" in by["FAILED"].error


def _raw(spark, path, spec, at, **columns):
    """RAW rows of one load at minute ``at``; each column a list of values."""
    rows = [dict(zip(columns, v)) for v in zip(*columns.values())]
    base = spark.createDataFrame([], raw_schema(spec))
    df = spark.createDataFrame([tuple(r.values()) for r in rows], ", ".join(
        f"{c} {base.schema[c].dataType.simpleString()}" for c in columns))
    df = df.withColumn("_loaded_at", F.lit(dt.datetime(2024, 1, 1) + dt.timedelta(minutes=at)).cast("timestamp_ntz"))
    base.unionByName(df, allowMissingColumns=True).coalesce(1).write.parquet(path)


def test_facts_wait_for_their_parent(spark, scratch):
    orders, customers, out = f"{scratch}/o", f"{scratch}/c", f"{scratch}/out"
    known = {"rows": []}

    def parents():
        return spark.createDataFrame([(k,) for k in known["rows"]], "customer_id bigint") if known["rows"] else None

    def run():
        start_orphan_watch(spark, orders, ORDERS, customers, CUSTOMERS, "customer_id", parents, out, f"{scratch}/ck",
                           wait="10 minutes", once=True).awaitTermination()

    def logged():
        rows = spark.read.option("recursiveFileLookup", "true").parquet(out) if os.path.exists(out) else None
        return sorted(r.order_id for r in rows.collect()) if rows is not None else []

    known["rows"] = [1]  # long there, not in the stream
    _raw(spark, f"{orders}/a", ORDERS, 0, op=["I"] * 5, order_id=[1, 2, 3, 4, 5], customer_id=[1, 2, 3, 4, None])
    _raw(spark, f"{customers}/a", CUSTOMERS, 0, op=["I"], customer_id=[50])
    run()
    assert logged() == []  # all wait
    _raw(spark, f"{customers}/b", CUSTOMERS, 5, op=["I", "D", "U"], customer_id=[2, 3, 2])  # 2 came in time; 3 is a delete
    _raw(spark, f"{orders}/b", ORDERS, 6, op=["I"], order_id=[6], customer_id=[2])
    known["rows"] = [1, 2, 50]
    run()
    assert logged() == []
    _raw(spark, f"{orders}/c", ORDERS, 30, op=["I"], order_id=[7], customer_id=[2])
    _raw(spark, f"{customers}/c", CUSTOMERS, 31, op=["I"], customer_id=[4])  # too late for order 4's wait
    run()
    run()  # the watermark moves with the next batch
    assert logged() == [3, 4]
    known["rows"] = [1, 2, 4, 50]
    now = open_orphans(spark, out, ORDERS, "customer_id", parents())
    assert [(r.order_id, r.customer_id) for r in now.collect()] == [(3, 3)]
    # The batch anti join over the facts that have waited long enough says the same.
    facts = spark.read.option("recursiveFileLookup", "true").parquet(orders).where("order_id < 7")
    assert [r.order_id for r in orphans(facts, parents(), {"customer_id": "customer_id"}).collect()] == [3]


def read_schema():
    from tidemark.sources.changes import raw_schema
    return raw_schema(CUSTOMERS)
