"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line.  Each query runs to completion into the ``noop`` sink
(full plan executed, nothing collected).  One small warm-up query runs first
so JVM start-up and first code generation are not charged to a query.  Every
headline query is then timed three times (once if it takes over LONG seconds)
and its median is given; ``control`` is one fixed small query, timed likewise,
that tells machines and days apart.  The streaming entries land the orders
change log as one file per order year and run, one file per micro-batch with
``availableNow``, the ingest query and two merges of the same RAW: into the
bucketed table, and as keyed state (``upsert_sec``, beside the total).
"""

from __future__ import annotations

import datetime as dt
import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

#: A query that takes longer than this is timed once.
LONG = 15
HEADLINE = ["latest_item", "latest_event_agg", "replay_items", "merge_items",
            "snapshot_diff", "star_revenue", "line_total", "orphans", "order_total_mismatch"]


def session(cpus: str, partitions: int, scratch: str) -> SparkSession:
    s = (SparkSession.builder.master(f"local[{cpus}]").appName("tidemark-bench")
         .config("spark.sql.shuffle.partitions", str(partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "16g"))
         .config("spark.local.dir", f"{scratch}/local")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(f"{scratch}/checkpoint")
    return s


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(make) -> float:
    """Median seconds of three runs, or the seconds of one long run."""
    taken = []
    while len(taken) < 3 and not (taken and taken[0] > LONG):
        t0 = time.time()
        run(make())
        taken.append(time.time() - t0)
    return round(statistics.median(taken), 3)


def bench_streaming(spark, sf_dir: str, scratch: str) -> dict:
    from tidemark.sources.snapshot import SnapshotTable
    from tidemark.spec import ORDERS
    from tidemark.streaming.pipeline import start_ingest, start_merge
    from tidemark.streaming.upsert import read_upserts, start_upsert

    land, raw = f"{scratch}/landing/public/orders", f"{scratch}/raw/orders"
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    changes = o.select(
        F.when(F.col("o_orderstatus") == "O", "I").when(F.col("o_orderstatus") == "P", "U")
        .otherwise("D").alias("Op"),
        F.col("o_orderdate").alias("_timestamp"),
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.lit(None).cast("date").alias("ship_date"),
        F.col("o_orderpriority").alias("status"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("total_amount"),
        F.lit("USD").alias("currency"), F.lit("STANDARD").alias("shipping_method"),
        F.lit(None).cast("string").alias("notes"),
        F.col("o_orderdate").cast("timestamp").alias("created_at"),
        F.col("o_orderdate").cast("timestamp").alias("updated_at"),
        F.year("o_orderdate").alias("y"))
    years = sorted(r[0] for r in changes.select("y").distinct().collect())
    for y in years:  # one landed file per year: the arrival order of the log
        changes.where(F.col("y") == y).drop("y").coalesce(1).write.parquet(f"{land}/y{y}")
    n_rows = o.count()
    t0 = time.time()
    start_ingest(spark, land, raw, ORDERS, f"{scratch}/ck/ingest", once=True).awaitTermination()
    t1 = time.time()
    table = SnapshotTable(spark, f"{scratch}/curated/fact_orders", ORDERS, n_buckets=8)
    start_merge(spark, raw, table, ORDERS, f"{scratch}/ck/merge", once=True,
                max_files_per_trigger=1,
                audit_path=f"{scratch}/audit").awaitTermination()
    t2 = time.time()
    batches = len(years)
    out = f"{scratch}/upserts"
    start_upsert(spark, raw, out, ORDERS, f"{scratch}/ck/upsert", once=True, max_files_per_trigger=1).awaitTermination()
    t3 = time.time()
    same = read_upserts(spark, out, ORDERS).count() == table.read().count()
    return {"upsert_sec": round(t3 - t2, 3), "upsert_sec_per_batch": round((t3 - t2) / max(batches, 1), 3),
            "upsert_rows_match": same,
            "stream_ingest_sec": round(t1 - t0, 3), "stream_merge_sec": round(t2 - t1, 3),
            "stream_rows": n_rows, "stream_batches": batches,
            "stream_rows_per_sec": round(n_rows / max(t2 - t0, 1e-9), 1),
            "stream_sec_per_batch": round((t2 - t1) / max(batches, 1), 3)}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    partitions = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "8"))
    scratch = tempfile.mkdtemp(prefix="tidemark-bench-")
    spark = session(cpus, partitions, scratch)
    from tidemark.plans.catalog import QUERIES

    run(QUERIES["op_mix"](spark, sf_dir))  # warm-up
    control = timed(lambda: QUERIES["op_mix"](spark, sf_dir))
    times = {name: timed(lambda: QUERIES[name](spark, sf_dir)) for name in HEADLINE}
    stream = bench_streaming(spark, sf_dir, scratch)
    times["stream_ingest_merge"] = round(stream["stream_ingest_sec"]
                                         + stream["stream_merge_sec"], 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": sf, "master": f"local[{cpus}]",
        "shuffle_partitions": partitions, "streaming": stream,
        "merge_items_batches": 7, "control": control,
        "warmup": "one op_mix query before timing; median of three runs, one run over 15 s",
        "at": dt.datetime.now(dt.timezone.utc).isoformat(timespec="seconds"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
