"""Run history from the runs themselves (A5): a listener that logs each batch.

Every finished micro-batch of every query of the session is one JSON row -- when
it began, how long it took, rows read, and the metrics the query observed
(``start_ingest`` observes rows and rejected rows) -- and a query that ends by an
error leaves a FAILED row with the batch it was in.  The rows are written by the
driver, one small file each, without a Spark job; no table is read for them.
"""

from __future__ import annotations

import datetime as _dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

RUN_COLUMNS = ("query_id string, run_id string, name string, batch_id bigint, started_at timestamp_ntz, "
               "duration_ms bigint, rows_in bigint, observed map<string, map<string, bigint>>, state string, error string")


class RunLog(StreamingQueryListener):
    """``spark.streams.addListener(RunLog(spark, path))``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.names: dict[str, str | None] = {}
        self.at: dict[str, int] = {}  # last finished batch by run

    def _write(self, file: str, row: dict) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{file}.json")
        out = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).create(path, True)
        try:
            out.write(bytearray(json.dumps(row).encode()))
        finally:
            out.close()

    def onQueryStarted(self, event) -> None:
        self.names[str(event.runId)] = event.name

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.at[str(p.runId)] = p.batchId
        if not p.numInputRows:  # a trigger without data is no run
            return
        observed = {name: {k: v for k, v in row.asDict().items() if isinstance(v, int)}
                    for name, row in p.observedMetrics.items()}
        self._write(f"{p.runId}-{p.batchId:012d}", {
            "query_id": str(p.id), "run_id": str(p.runId), "name": p.name, "batch_id": p.batchId,
            "started_at": p.timestamp.rstrip("Z"), "duration_ms": p.batchDuration, "rows_in": p.numInputRows,
            "observed": observed, "state": "SUCCEEDED", "error": None})

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        run = str(event.runId)
        name, last = self.names.pop(run, None), self.at.pop(run, None)
        if event.exception:
            now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
            self._write(f"{run}-failed", {
                "query_id": str(event.id), "run_id": run, "name": name,
                "batch_id": None if last is None else last + 1, "started_at": now.isoformat(timespec="milliseconds"),
                "duration_ms": None, "rows_in": None, "observed": {}, "state": "FAILED", "error": event.exception[:2000]})


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """Logged runs; :func:`tidemark.operators.audit.run_history` gives the newest."""
    return spark.read.schema(RUN_COLUMNS).json(path)
