"""Build small change logs from compact literal rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators.latest import latest_events
from tidemark.operators.merge import empty_target, merge_changes
from tidemark.operators.replay import replay_changes
from tidemark.spec import Field, TableSpec

T0 = dt.datetime(2024, 1, 1)
BASE = dt.datetime(2024, 2, 1)

SPEC = TableSpec(
    name="t", curated_name="dim_t", keys=("k",),
    fields=(Field("k", "bigint", nullable=False), Field("v", "string", 10)),
    update_columns=("v", "src_updated_at"), insert_only=("src_created_at",),
    has_first_seen=True, ts_col="ts", tiebreak=("seq",))

SCHEMA = "b int, k bigint, op string, ts timestamp_ntz, v string, seq bigint"


def log(spark, rows):
    """rows: (batch, key, op, minute, value) -> change log DataFrame."""
    data = [(b, k, op, None if m is None else T0 + dt.timedelta(minutes=m), v, i)
            for i, (b, k, op, m, v) in enumerate(rows)]
    df = spark.createDataFrame(data, SCHEMA)
    return df.withColumns({"src_created_at": F.col("ts"), "src_updated_at": F.col("ts"),
                           "_bts": F.lit(BASE).cast("timestamp_ntz")
                           + F.make_dt_interval(days=F.col("b"))})


def merge_all(spark, df, spec=SPEC, strategy="auto", guard_late=False):
    batches = sorted(r[0] for r in df.select("b").distinct().collect())
    target = None
    for b in batches:
        latest = latest_events(df.where(F.col("b") == b), spec)
        if target is None:
            target = empty_target(spark, spec, latest.schema, guard_late)
        target = merge_changes(target, latest, spec, BASE + dt.timedelta(days=b),
                               strategy=strategy, guard_late=guard_late)
    return target


def replay(df, spec=SPEC):
    return replay_changes(df, spec, "b", "_bts")


def as_dict(df, cols=("v", "dw_first_seen_at", "dw_last_updated_at", "is_deleted")):
    out = {}
    for r in df.collect():
        out[r["k"]] = tuple(r[c] for c in cols)
    return out


def day(b):
    return BASE + dt.timedelta(days=b)
