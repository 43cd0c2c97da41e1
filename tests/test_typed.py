"""Change files of mixed physical types: batch, stream, file log, failures."""

import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.casting import cast_row
from tidemark.operators.audit import ingest_status, load_history, read_file_log
from tidemark.operators.quality import split_valid
from tidemark.sources.changes import FILE_OP, list_files, read_raw
from tidemark.sources.mixed import physical_groups, read_mixed
from tidemark.spec import ORDERS
from tidemark.streaming.typed import ingest_batch, start_typed_ingest

T0 = dt.datetime(2024, 1, 1)


def write(spark, path, rows, amount, extra=""):
    """rows: (id, amount); one file whose ``total_amount`` has the type ``amount``."""
    df = spark.createDataFrame([("I", T0 + dt.timedelta(minutes=i), i, 7, a) for i, a in rows],
                               f"Op string, _timestamp timestamp_ntz, order_id bigint, customer_id bigint, total_amount {amount}")
    if extra:
        df = df.selectExpr("*", extra)
    df.coalesce(1).write.mode("append").parquet(path)


def landed(spark, root):
    write(spark, f"{root}/a", [(1, Decimal("1.50")), (2, None)], "decimal(12,2)")
    write(spark, f"{root}/b c", [(3, 2.25), (4, 1e30), (5, float("nan"))], "double")
    write(spark, f"{root}/d", [(6, 12)], "int", "'x' as unknown_column")
    write(spark, f"{root}/e", [(7, "3.10"), (8, "n/a"), (9, None), (10, " 4 ")], "string", "current_date() as SHIP_DATE")
    write(spark, f"{root}/f", [(11, b"\x01")], "binary")
    write(spark, f"{root}/g", [], "double")


WANT = {1: ("1.50", ""), 2: (None, ""), 3: ("2.25", ""), 4: (None, "bad_cast:total_amount"), 5: (None, "bad_cast:total_amount"),
        6: ("12.00", ""), 7: ("3.10", ""), 8: (None, "bad_cast:total_amount"), 9: (None, ""), 10: ("4.00", ""),
        11: (None, "bad_cast:total_amount")}


def seen(df):
    return {r.order_id: (None if r.total_amount is None else str(r.total_amount), r._cast_errors) for r in df.collect()}


def test_batch_read(spark, scratch):
    root = f"{scratch}/land"
    landed(spark, root)
    files = [r.path for r in list_files(spark, root, "*.parquet").collect()]
    # Declared, double (with the empty file), int, string and binary amounts.
    assert sorted(len(g[1]) for g in physical_groups(spark, files, ORDERS)) == [1, 1, 1, 1, 2]
    got = read_mixed(spark, root, ORDERS)
    assert seen(got) == WANT
    assert got.schema["total_amount"].dataType == T.DecimalType(12, 2)
    assert got.where("ship_date is not null").count() == 4  # other spelling of the name
    good, bad = split_valid(got, ORDERS)
    assert {r.order_id for r in bad.collect()} == {4, 5, 8, 11}
    assert {r._cast_errors for r in read_mixed(spark, root, ORDERS, on_error="null").collect()} == {""}
    with pytest.raises(Exception, match="bad_cast:total_amount"):
        read_mixed(spark, root, ORDERS, on_error="fail").collect()
    assert read_mixed(spark, [], ORDERS).count() == 0


def test_one_layout_is_one_footer_read(spark, scratch):
    root = f"{scratch}/land"
    for k in range(3):
        write(spark, root, [(k, 1.5)], "double")
    write(spark, root, [(9, 2.5)], "double", "'late' as notes")  # a column more is no other type
    files = [r.path for r in list_files(spark, root, "*.parquet").collect()]
    groups = physical_groups(spark, files, ORDERS)
    assert len(groups) == 1 and len(groups[0][1]) == 4
    assert sorted((r.order_id, r.notes) for r in read_mixed(spark, root, ORDERS).collect()) == [
        (0, None), (1, None), (2, None), (9, "late")]


def test_fractions_do_not_become_integers(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.5, None), (1e19, 3.0)], "order_id double, customer_id double")
    got = [(r.order_id, r.customer_id, r._cast_errors) for r in cast_row(df, ORDERS).collect()]
    assert got == [(1, 2, ""), (None, None, "bad_cast:order_id"), (None, 3, "bad_cast:order_id")]
    with pytest.raises(ValueError):
        cast_row(df, ORDERS, on_error="ignore")


def test_odd_file_names(spark, scratch):
    root = f"{scratch}/land"
    write(spark, f"{root}/x", [(1, 1.5)], "double")
    write(spark, f"{root}/y", [(2, "2")], "string")
    for folder, name in (("x", "a b+c%20[1]{2}.parquet"), ("y", "q*z.parquet")):
        old = next(f for f in os.listdir(f"{root}/{folder}") if f.endswith(".parquet"))
        os.rename(f"{root}/{folder}/{old}", f"{root}/{folder}/{name}")
        for crc in [f for f in os.listdir(f"{root}/{folder}") if f.endswith(".crc")]:
            os.rename(f"{root}/{folder}/{crc}", f"{root}/{folder}/._gone")
    assert {i for i in seen(read_mixed(spark, root, ORDERS))} == {1, 2}
    raw = f"{scratch}/raw"
    files = [r.path for r in list_files(spark, root, "*.parquet").collect()]
    ingest_batch(files, spark, raw, ORDERS, "s", 0, f"{scratch}/log")
    status = ingest_status(list_files(spark, root, "*.parquet"), read_file_log(spark, f"{scratch}/log"))
    assert tuple(status.first()) == (2, 2, 0)
    # From RAW, where no log is kept, the same.
    assert tuple(ingest_status(list_files(spark, root, "*.parquet"), read_raw(spark, raw, ORDERS)).first()) == (2, 2, 0)


def test_stream_survives_and_logs_files(spark, scratch):
    root, raw, log, ckpt = (f"{scratch}/{n}" for n in ("land", "raw", "log", "ckpt"))
    landed(spark, root)
    run = lambda: start_typed_ingest(spark, root, raw, ORDERS, ckpt, once=True, log_path=log, max_files_per_trigger=2).awaitTermination()
    run()
    assert seen(read_raw(spark, raw, ORDERS).fillna("", ["_cast_errors"])) == WANT
    write(spark, f"{root}/later", [(20, 5), (21, 6)], "bigint")
    run()
    run()  # nothing new
    rows = read_raw(spark, raw, ORDERS)
    assert rows.count() == len(WANT) + 2 and rows.where("order_id in (20, 21) and total_amount in (5, 6)").count() == 2
    status = ingest_status(list_files(spark, root, "*.parquet"), read_file_log(spark, log))
    assert tuple(status.first()) == (7, 7, 0)  # the file without rows and the folder with a blank too
    history = load_history(read_file_log(spark, log))
    assert sorted(r.row_count for r in history.collect()) == [0, 1, 1, 2, 2, 3, 4]
    assert "raw" not in history._jdf.queryExecution().executedPlan().toString().replace(raw, "RAW-FOLDER").lower().split("filescan")[0]
    assert read_file_log(spark, log).agg(F.sum("rejected")).first()[0] == 4
    assert ingest_batch([f"{root}/none"], spark, raw, ORDERS, next(
        d.rsplit("-", 1)[0] for d in os.listdir(raw) if not d.startswith("_")), 0) is False  # a repeated batch


def test_op_of_another_type(spark, scratch):
    df = spark.createDataFrame([(1, "2024-01-01 00:00:00", 5)], "Op int, _timestamp string, order_id int")
    df.write.parquet(f"{scratch}/x")
    r = read_mixed(spark, f"{scratch}/x", ORDERS).first()
    assert (r.op, r._captured_at, r.order_id, r._cast_errors) == ("1", T0, 5, "")
    assert FILE_OP == "Op"
