"""Structured Streaming pipelines.

Two independent queries per table, each with its own checkpoint:

1. **ingest** -- new change files under the landing prefix -> RAW.  The file
   source's log delivers each file once; the Parquet file sink's commit log
   makes the append exactly-once.  ``_metadata`` gives file and row.
2. **merge** -- RAW as a stream -> ``foreachBatch``: quarantine, latest event
   per key, MERGE into the :class:`SnapshotTable`.  The table records the
   query's id and micro-batch id, so a batch replayed after a failure is a
   no-op, a query on a new checkpoint is applied, and the offset only moves on
   after the table committed.

No watermark and no late guard by default: a later batch wins even with an
older capture time (the modelled behaviour); ``guard_late=True`` on the table
keeps the newest applied event time per key and refuses older events.
"""

from __future__ import annotations

import datetime as _dt
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.casting import cast_row, rename_to_curated
from tidemark.operators.latest import latest_events
from tidemark.operators.quality import split_tagged, tag_rejects
from tidemark.sources.changes import raw_schema, read_changes_stream, to_raw
from tidemark.sources.snapshot import SnapshotTable
from tidemark.spec import TableSpec
from tidemark.streaming.publish import query_id

DEFAULT_SCHEDULE = "5 minutes"

AUDIT_COLUMNS = ("batch_id long, table_name string, started_at timestamp_ntz, "
                 "finished_at timestamp_ntz, rows_in long, rows_rejected long, "
                 "keys_merged long, applied boolean, state string, error string")


def _trigger(writer, once: bool, schedule: str):
    return writer.trigger(availableNow=True) if once else writer.trigger(processingTime=schedule)


def without_repeats(stream: DataFrame, spec: TableSpec, within: str) -> DataFrame:
    """Change rows that arrive for the first time within ``within``.

    A capture tool that repeats a delivery (at least once, under other file
    names) sends the same rows again: same key, capture time, op and values.
    Merged in a later batch they would undo what came between.  The watermark
    runs on the time of *arrival*, so no event is ever too late, however old
    its capture time, and a row's place in the state store is freed ``within``
    after it came: the state holds that much of the feed, not the table.
    """
    cells = [x for f in spec.field_names for x in (F.col(f), F.col(f).isNull())]  # the hash skips nulls
    return (stream.withColumns({"_arrived": F.current_timestamp(), "_same": F.xxhash64(*cells)})
            .withWatermark("_arrived", within)
            .dropDuplicatesWithinWatermark([*spec.keys, spec.ts_col, spec.op_col, "_same"])
            .drop("_arrived", "_same"))


def start_ingest(spark: SparkSession, landing: str, raw_path: str, spec: TableSpec,
                 checkpoint: str, fmt: str = "parquet", once: bool = False,
                 schedule: str = DEFAULT_SCHEDULE, header: Sequence[str] | None = None,
                 repeats_within: str | None = None) -> StreamingQuery:
    """Auto-ingest: every new change file under ``landing`` is appended to RAW.

    CSV values that do not fit their type go to RAW as NULL with their reason
    in ``_cast_errors``; the merge quarantines such rows.  ``repeats_within``
    drops repeated deliveries (:func:`without_repeats`).
    """
    changes = read_changes_stream(spark, landing, spec, fmt, header=header)
    if fmt == "csv":
        ts = F.col(spec.ts_col)
        bad_ts = F.when(ts.isNotNull() & ts.try_cast("timestamp_ntz").isNull(),
                        F.lit(f"bad_cast:{spec.ts_col}"))
        changes = (cast_row(changes.withColumn("_bad_ts", bad_ts), spec)
                   .withColumn("_cast_errors", F.concat_ws(
                       ",", "_bad_ts", F.nullif("_cast_errors", F.lit(""))))
                   .withColumn(spec.ts_col, ts.try_cast("timestamp_ntz")))
    raw = to_raw(changes, spec, row_index=fmt == "parquet")
    if repeats_within:
        raw = without_repeats(raw, spec, repeats_within)
    raw = raw.observe("ingest", F.count(F.lit(1)).alias("rows"), F.count_if(F.col("_cast_errors") != "").alias("rejected"))
    w = (raw.writeStream.format("parquet").option("checkpointLocation", checkpoint)
         .option("path", raw_path).outputMode("append"))
    return _trigger(w, once, schedule).start()


def merge_batch(df: DataFrame, batch_id: int, table: SnapshotTable, spec: TableSpec,
                batch_ts: _dt.datetime | None = None, strict_reference: bool = False,
                on_overflow: str = "quarantine", quarantine_path: str | None = None,
                audit_path: str | None = None, strategy: str = "auto",
                source: str = "") -> bool:
    """One micro-batch: quarantine, de-duplicate, merge, audit.  Idempotent
    per ``source``, the id of the query that numbers the batches."""
    started = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    row = {"n_in": 0, "n_bad": 0, "n_keys": 0}
    try:
        applied = _merge(df, batch_id, table, spec, batch_ts or started, strict_reference, on_overflow,
                         quarantine_path, strategy, source, bool(audit_path), row)
    except Exception as e:
        if audit_path:  # beside the row that a repeated, successful run writes
            _audit(df.sparkSession, f"{audit_path}/{source}{batch_id:020d}-failed-{started:%Y%m%dT%H%M%S%f}",
                   batch_id, spec, started, row, False, "FAILED", f"{type(e).__name__}: {e}"[:2000])
        raise
    if audit_path and row["n_in"]:
        _audit(df.sparkSession, f"{audit_path}/{source}{batch_id:020d}", batch_id, spec, started, row, applied,
               "SUCCEEDED" if applied else "SKIPPED", None)
    return applied


def _audit(spark: SparkSession, path: str, batch_id: int, spec: TableSpec, started: _dt.datetime,
           row: dict, applied: bool, state: str, error: str | None) -> None:
    finished = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    data = [(int(batch_id), spec.name, started, finished, row["n_in"], row["n_bad"], row["n_keys"],
             applied, state, error)]
    spark.createDataFrame(data, AUDIT_COLUMNS).coalesce(1).write.mode("overwrite").parquet(path)


def _merge(df: DataFrame, batch_id: int, table: SnapshotTable, spec: TableSpec, batch_ts: _dt.datetime,
           strict_reference: bool, on_overflow: str, quarantine_path: str | None, strategy: str,
           source: str, audited: bool, row: dict) -> bool:
    tagged = tag_rejects(df, spec, strict_reference, on_overflow).persist()
    try:
        counts = tagged.agg(F.count(F.lit(1)).alias("n"),
                            F.count("_reject_reason").alias("bad")).first()
        row["n_in"], row["n_bad"] = int(counts["n"]), int(counts["bad"])
        if row["n_in"] == 0:  # a zero-row file still fires a batch: skip like no data
            return False
        good, bad = split_tagged(tagged)
        if quarantine_path and row["n_bad"]:
            bad.write.mode("overwrite").parquet(f"{quarantine_path}/{source}{batch_id:020d}")
        latest = latest_events(rename_to_curated(good, spec), spec).persist()
        table.last_delta_rows = None
        applied = table.apply(latest, batch_id, batch_ts, strategy, source)
        row["n_keys"] = table.last_delta_rows
        if row["n_keys"] is None:  # replayed batch: apply returned before measuring
            row["n_keys"] = latest.count() if audited else 0
        latest.unpersist()
        return applied
    finally:
        tagged.unpersist()


def start_merge(spark: SparkSession, raw_path: str, table: SnapshotTable, spec: TableSpec,
                checkpoint: str, once: bool = False, schedule: str = DEFAULT_SCHEDULE,
                max_files_per_trigger: int | None = None, repeats_within: str | None = None,
                **kwargs) -> StreamingQuery:
    """Change stream over RAW -> scheduled MERGE into the curated table."""
    path = spark._jvm.org.apache.hadoop.fs.Path(raw_path)  # a merge may start before the first ingest
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)
    reader = (spark.readStream.schema(raw_schema(spec)).option("recursiveFileLookup", "true"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(raw_path)
    if repeats_within:
        stream = without_repeats(stream, spec, repeats_within)

    def _run(df: DataFrame, batch_id: int) -> None:
        # the id of the query's checkpoint: a new checkpoint has another one
        merge_batch(df, batch_id, table, spec, **{"source": query_id(df), **kwargs})

    w = stream.writeStream.foreachBatch(_run).option("checkpointLocation", checkpoint)
    return _trigger(w, once, schedule).start()


def read_audit(spark: SparkSession, audit_path: str) -> DataFrame:
    return (spark.read.schema(AUDIT_COLUMNS).option("recursiveFileLookup", "true")
            .parquet(audit_path))
