"""Nothing is lost or shifted: new checkpoints, bucket counts, CSV headers, bad values."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tidemark.functions.casting import extract_json_fields
from tidemark.operators.latest import latest_events
from tidemark.operators.quality import split_valid
from tidemark.sources.changes import append_raw, read_changes, read_raw, to_raw
from tidemark.sources.snapshot import SnapshotTable
from tidemark.spec import ORDERS, Field, TableSpec
from tidemark.streaming.pipeline import merge_batch, start_ingest, start_merge

NOW = dt.datetime(2024, 3, 1, 12)
HEADER = ["Op", "_timestamp", "order_id", "customer_id", "order_date", "total_amount"]


def put(folder, name, lines, header=HEADER):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as fh:
        fh.write("\n".join([",".join(header), *lines]) + "\n")


def line(op, minute, key, amount="10.50", customer="7"):
    return f"{op},2024-01-01 00:{minute:02d}:00,{key},{customer},2024-01-01,{amount}"


def ingest(spark, scratch, checkpoint="ck_in"):
    q = start_ingest(spark, f"{scratch}/land", f"{scratch}/raw", ORDERS, f"{scratch}/{checkpoint}",
                     fmt="csv", once=True, header=HEADER)
    q.awaitTermination()


def merge(spark, scratch, table, checkpoint="ck_merge"):
    start_merge(spark, f"{scratch}/raw", table, ORDERS, f"{scratch}/{checkpoint}", once=True,
                quarantine_path=f"{scratch}/bad").awaitTermination()


def amounts(table):
    return {r["order_id"]: str(r["total_amount"]) for r in table.read().collect()}


def test_new_checkpoint_and_bad_cast_through_the_streams(spark, scratch):
    table = SnapshotTable(spark, f"{scratch}/fact", ORDERS, n_buckets=4)
    for i in range(3):
        put(f"{scratch}/land", f"a{i}.csv", [line("I", i, i + 1)])
        ingest(spark, scratch)
        merge(spark, scratch, table)
    put(f"{scratch}/land", "b.csv", [line("I", 8, 4), line("U", 9, 1, "12abc"), line("U", 9, 2, "11.00")])
    ingest(spark, scratch)
    again = SnapshotTable(spark, f"{scratch}/fact", ORDERS)
    merge(spark, scratch, again, "ck_other")  # its batch ids start at 0 again
    assert amounts(again) == {1: "10.50", 2: "11.00", 3: "10.50", 4: "10.50"}
    bad = spark.read.option("recursiveFileLookup", "true").parquet(f"{scratch}/bad").collect()
    assert [(r["order_id"], r["_reject_reason"]) for r in bad] == [(1, "bad_cast:total_amount")]
    merge(spark, scratch, again, "ck_other")  # nothing new
    assert len(amounts(again)) == 4
    with pytest.raises(ValueError, match="streaming sink"):
        append_raw(read_raw(spark, f"{scratch}/raw", ORDERS), f"{scratch}/raw")


def events(spark, keys, minute=1):
    rows = [("I", dt.datetime(2024, 1, 1, 0, minute), k, 7, "f", k) for k in keys]
    return latest_events(spark.createDataFrame(
        rows, "op string, _captured_at timestamp_ntz, order_id bigint, customer_id bigint, _source_file string, "
              "_source_file_row bigint").withColumns(
                  {c: F.lit(None).cast("string") for c in ("order_date", "ship_date", "order_status", "total_amount",
                   "currency", "shipping_method", "notes", "src_created_at", "src_updated_at")}), ORDERS)


def test_bucket_count_is_the_tables(spark, scratch):
    first = SnapshotTable(spark, f"{scratch}/t", ORDERS, n_buckets=8)
    assert first.apply(events(spark, range(20)), 0, NOW, source="a")
    again = SnapshotTable(spark, f"{scratch}/t", ORDERS)
    assert again.apply(events(spark, range(20), 2), 1, NOW, source="a")
    assert again.read().count() == 20 and again.n_buckets == 8
    with pytest.raises(ValueError, match="8 buckets"):
        SnapshotTable(spark, f"{scratch}/t", ORDERS, n_buckets=4).read()


def test_crash_before_commit(spark, scratch):
    table = SnapshotTable(spark, f"{scratch}/t", ORDERS, n_buckets=2)
    table.apply(events(spark, [1, 2]), 0, NOW)
    os.makedirs(f"{scratch}/t/_commits/{1:020d}")  # a commit that was never finished
    os.makedirs(f"{scratch}/t/v=1/_b=0")
    again = SnapshotTable(spark, f"{scratch}/t", ORDERS)
    assert again.last_batch_id() == 0 and again.read().count() == 2
    assert again.apply(events(spark, [3]), 1, NOW)
    assert SnapshotTable(spark, f"{scratch}/t", ORDERS).read().count() == 3


def test_csv_goes_by_name(spark, scratch):
    put(f"{scratch}/csv", "a.csv", ["7,2024-01-01 00:00:00,I,1,note"],
        ["CUSTOMER_ID", "_timestamp", "Op", "order_id", "unknown"])
    row = read_changes(spark, f"{scratch}/csv", ORDERS, fmt="csv").first()
    assert (row["op"], row["order_id"], row["customer_id"], row["total_amount"]) == ("I", "1", "7", None)
    put(f"{scratch}/csv", "b.csv", ["1,2024-01-01 00:00:00,I,7,note"],
        ["order_id", "_timestamp", "Op", "customer_id", "unknown"])
    with pytest.raises(Exception, match="header"):
        read_changes(spark, f"{scratch}/csv", ORDERS, fmt="csv").collect()
    put(f"{scratch}/none", "a.csv", ["1"], ["order_id"])
    with pytest.raises(ValueError, match="lacks"):
        read_changes(spark, f"{scratch}/none", ORDERS, fmt="csv")


def test_json_reasons(spark):
    spec = TableSpec(name="j", keys=("k",), fields=(Field("k", "bigint"), Field("s", "string")))
    df = spark.createDataFrame([('{"k": 1, "s": "a"}',), ("{broken",), ('{"k": "x"}',), ('{"k": null}',), (None,)],
                               "p string")
    assert [r["_cast_errors"] for r in extract_json_fields(df, "p", spec).collect()] == [
        "", "bad_json", "bad_cast:k", "", ""]


def test_required_columns_are_quarantined(spark):
    df = spark.createDataFrame([("I", 1, None), ("U", 2, None), ("D", 3, None), ("I", 4, 9)],
                               "op string, order_id bigint, customer_id bigint")
    good, bad = split_valid(df, ORDERS)
    assert sorted(r["order_id"] for r in good.collect()) == [3, 4]
    assert {r["_reject_reason"] for r in bad.collect()} == {"null_required:customer_id"}


def test_zero_row_batch_is_skipped(spark, scratch):
    raw = spark.read.schema(read_raw_schema(spark, scratch)).parquet(f"{scratch}/empty")
    table = SnapshotTable(spark, f"{scratch}/t", ORDERS)
    assert merge_batch(raw, 0, table, ORDERS) is False and table.state() is None


def read_raw_schema(spark, scratch):
    df = to_raw(read_changes(spark, _empty(spark, scratch), ORDERS), ORDERS, NOW)
    df.write.parquet(f"{scratch}/empty")
    return df.schema


def _empty(spark, scratch):
    path = f"{scratch}/zero"
    spark.createDataFrame([], "Op string, order_id bigint").write.parquet(path)
    return path
