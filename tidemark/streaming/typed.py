"""Ingest of change files whose physical types differ (S1, S2, P2 as a stream).

A file stream has one schema, and the first DOUBLE amount under a declared
DECIMAL would stop it.  So the stream delivers file *names* (its log still
gives each file once); every micro-batch groups its files by their physical
types and casts them (:func:`tidemark.sources.mixed.read_mixed`).  Values that
do not fit reach RAW as NULL with their reason, which the merge quarantines; the
stream goes on.  Each batch also leaves a row per file in the file log, so load
history and ingest status never read RAW.
"""

from __future__ import annotations

import datetime as _dt
from typing import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.audit import file_log
from tidemark.sources.changes import landing_path, layer_path, read_raw
from tidemark.sources.mixed import read_mixed
from tidemark.spec import TableSpec
from tidemark.streaming.publish import batch_folder, publish, published, query_id


def ingest_batch(files: list[str], spark: SparkSession, raw_path: str, spec: TableSpec, source: str,
                 batch_id: int, log_path: str | None = None, on_error: str = "quarantine") -> bool:
    """One batch of landed files -> RAW and the file log.  Idempotent."""
    if not files:
        return False
    loaded_at = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    new = not published(spark, raw_path, source, batch_id)
    if new:
        publish(read_mixed(spark, files, spec, on_error, loaded_at), raw_path, source, batch_id)
    if log_path and not published(spark, log_path, source, batch_id):
        # The batch's own folder is counted, not RAW; a repeated batch counts the same rows.
        rows = read_raw(spark, batch_folder(raw_path, source, batch_id), spec)
        publish(file_log(rows, files, spec.name, loaded_at), log_path, source, batch_id, files=1)
    return new


def start_typed_ingest(spark: SparkSession, landing: str, raw_path: str, spec: TableSpec, checkpoint: str,
                       once: bool = False, schedule: str = "5 minutes", log_path: str | None = None,
                       on_error: str = "quarantine", max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Every new Parquet change file under ``landing`` -> RAW, whatever its types.

    Only names are streamed: the binary source reads no content that is not
    asked for.  ``max_files_per_trigger`` bounds the names of one batch.
    """
    reader = (spark.readStream.format("binaryFile").option("recursiveFileLookup", "true")
              .schema("path string, modificationTime timestamp, length bigint, content binary")
              .option("pathGlobFilter", "*.parquet"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    names = reader.load(landing).select("path")

    def run(df: DataFrame, batch_id: int) -> None:
        files = sorted(r.path for r in df.collect())
        ingest_batch(files, df.sparkSession, raw_path, spec, query_id(df), batch_id, log_path, on_error)

    w = names.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if once else w.trigger(processingTime=schedule)).start()


def start_tables(spark: SparkSession, root: str, base: str, specs: Iterable[TableSpec], checkpoint: str,
                 **options) -> dict[str, StreamingQuery]:
    """One ingest query per table, each reading its own prefix of a shared
    landing ``root`` into ``<base>/raw/<table>`` and logging its files (F4, T6)."""
    for spec in specs:  # a stream needs its folder, before the first file lands
        path = spark._jvm.org.apache.hadoop.fs.Path(landing_path(root, spec))
        path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)
    return {s.name: start_typed_ingest(spark, landing_path(root, s), layer_path(base, "raw", s.name), s,
                                       f"{checkpoint.rstrip('/')}/{s.name}", log_path=f"{base.rstrip('/')}/files/{s.name}",
                                       **options) for s in specs}
