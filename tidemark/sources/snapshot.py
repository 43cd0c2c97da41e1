"""Curated table sink (S6): bucketed copy-on-write Parquet with a commit log.

Layout under ``path``::

    v=<version>/_b=<bucket>/part-*.parquet   data written by one batch
    _commits/<version>/part-*.json          one commit row per batch

A commit row maps every bucket to the version that holds it, plus the bucket
count, the largest surrogate key, the table schema and the last batch id of
each source.  A batch reads only the buckets its events hash to, merges them,
writes them as a new version and then writes its commit row; readers take the
newest commit.  A crash before the commit leaves the previous version readable
and its folder is overwritten by the next batch.

Versions are the table's own count.  Batch ids belong to their ``source`` (the
streaming query's id): a batch of the same source at or below the last one is
a no-op, which makes a ``foreachBatch`` sink idempotent, while a query on a new
checkpoint, whose ids start at 0 again, is a new source and is applied.  The
bucket count is fixed by the first commit.  One writer per table.
"""

from __future__ import annotations

import datetime as _dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.merge import empty_target, merge_changes, size_terms
from tidemark.spec import OP_DELETE, TableSpec

COMMIT_SCHEMA = T.StructType([
    T.StructField("version", T.LongType()),
    T.StructField("batch_id", T.LongType()),
    T.StructField("applied", T.MapType(T.StringType(), T.LongType())),
    T.StructField("n_buckets", T.IntegerType()),
    T.StructField("max_key", T.LongType()),
    T.StructField("buckets", T.MapType(T.StringType(), T.LongType())),
    T.StructField("table_schema", T.StringType()),
    T.StructField("committed_at", T.TimestampNTZType()),
])


class SnapshotTable:
    def __init__(self, spark: SparkSession, path: str, spec: TableSpec,
                 n_buckets: int | None = None, guard_late: bool = False, key_slots: int = 64):
        self.spark, self.path, self.spec = spark, path.rstrip("/"), spec
        self.n_buckets, self.guard_late, self.key_slots = n_buckets, guard_late, key_slots
        self._state: dict | None = None
        self._state_loaded = False  # one writer per table: the commit is cached
        self.last_delta_rows: int | None = None  # rows of the last measured delta

    # -- commit log --------------------------------------------------------
    def state(self) -> dict | None:
        """Newest complete commit row, or None for a table never written."""
        log = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/_commits")
        fs = log.getFileSystem(self.spark._jsc.hadoopConfiguration())
        names = [f.getPath().getName() for f in fs.listStatus(log)] if fs.exists(log) else []
        for name in sorted(names, reverse=True):  # an unfinished commit has no _SUCCESS
            folder = f"{self.path}/_commits/{name}"
            if fs.exists(self.spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")):
                break
        else:
            return None
        st = self.spark.read.schema(COMMIT_SCHEMA).json(folder).first().asDict()
        if st["version"] is None:  # written when batch ids were the versions
            st["version"], st["applied"] = st["batch_id"], {"": st["batch_id"]}
        st["buckets"] = {int(b): int(v) for b, v in (st["buckets"] or {}).items()}
        if self.n_buckets not in (None, st["n_buckets"]):
            raise ValueError(f"{self.path} has {st['n_buckets']} buckets, not {self.n_buckets}")
        self.n_buckets = st["n_buckets"]
        self._state, self._state_loaded = st, True
        return st

    def last_batch_id(self) -> int | None:
        st = self.state()
        return None if st is None else st["batch_id"]

    def _bucket(self) -> F.Column:
        return F.pmod(F.xxhash64(*[F.col(k) for k in self.spec.keys]), F.lit(self.n_buckets))

    def read(self, buckets: list[int] | None = None, state: dict | None = None) -> DataFrame | None:
        st = state if state is not None else self.state()
        if st is None:
            return None
        schema = T.StructType.fromJson(json.loads(st["table_schema"]))
        pieces = st["buckets"] or {}
        asked = None if buckets is None else set(buckets)
        wanted = pieces if asked is None else {b: v for b, v in pieces.items() if b in asked}
        if not wanted:
            return self.spark.createDataFrame([], schema)
        paths = [f"{self.path}/v={v}/_b={b}" for b, v in sorted(wanted.items())]
        return self.spark.read.schema(schema).parquet(*paths)

    # -- one batch ---------------------------------------------------------
    def apply(self, latest: DataFrame, batch_id: int, batch_ts: _dt.datetime,
              strategy: str = "auto", source: str = "") -> bool:
        """Merge one batch of de-duplicated events; False if already applied
        from this ``source`` (the feeding query's id; batch ids are its own).

        One aggregation measures the delta (rows, bytes, touched buckets,
        buckets that can receive inserts); then one job merges and writes the
        touched buckets; then the commit row is written.  Cache ``latest``
        when calling: it is read by both jobs.
        """
        st = self._state if self._state_loaded else self.state()
        applied = dict((st or {}).get("applied") or {})
        if batch_id <= applied.get(source, -1):
            return False
        self.n_buckets = self.n_buckets or 1
        spec = self.spec
        latest = latest.withColumn("_b", self._bucket())
        fixed, var = size_terms(latest.drop("_b"))
        row = latest.agg(
            F.count(F.lit(1)).alias("n"), F.sum(var).alias("v"),
            F.collect_set("_b").alias("touched"),
            F.collect_set(F.when(F.col(spec.op_col) != OP_DELETE, F.col("_b"))).alias("ins"),
        ).first()
        n = int(row["n"])
        self.last_delta_rows = n
        if n == 0:
            return False
        touched, insertable = sorted(row["touched"]), set(row["ins"])
        old = dict((st or {}).get("buckets") or {})
        target = self.read(touched, st) if st is not None else None
        if target is None:
            target = empty_target(self.spark, spec, latest.schema, self.guard_late)
        base = int((st or {}).get("max_key") or 0)
        slots = self.key_slots
        merged = merge_changes(target, latest.drop("_b"), spec, batch_ts, strategy=strategy,
                               key_base=base, guard_late=self.guard_late,
                               delta_bytes=n * fixed + int(row["v"] or 0), key_slots=slots)
        version = 0 if st is None else st["version"] + 1
        out = f"{self.path}/v={version}"
        # one file per rewritten bucket: buckets hold unique keys, so they are
        # balanced by the hash and sized by n_buckets, never by a hot key
        (merged.withColumn("_b", self._bucket()).repartition(len(touched), "_b")
         .write.mode("overwrite").partitionBy("_b").parquet(out))
        # a touched bucket holds rows iff it held rows before or got an insert
        buckets = dict(old)
        for b in touched:
            if b in old or b in insertable:
                buckets[int(b)] = version
        # new keys are <= base + n * slots (see assign_keys): a safe next base
        max_key = base + n * slots if spec.surrogate_key else 0
        applied[source] = int(batch_id)
        state = {"version": version, "batch_id": int(batch_id), "applied": applied, "n_buckets": self.n_buckets, "max_key": max_key,
                 "buckets": buckets, "table_schema": merged.schema.json(),
                 "committed_at": _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)}
        commit = self.spark.createDataFrame(
            [(version, state["batch_id"], applied, self.n_buckets, max_key,
              {str(b): v for b, v in buckets.items()}, state["table_schema"],
              state["committed_at"])], COMMIT_SCHEMA)
        commit.coalesce(1).write.mode("overwrite").json(f"{self.path}/_commits/{version:020d}")
        self._state, self._state_loaded = state, True
        return True
