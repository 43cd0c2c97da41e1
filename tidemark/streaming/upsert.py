"""MERGE as a stateful stream (T4, T5, J1): Spark's state store holds the table.

Every key's curated row lives in the state store; a micro-batch reads and
writes the state of its own keys only, and appends their new rows to a folder.
Nothing else is read or rewritten, however large the table.  Per key the latest
event of the batch is merged by the clauses of :mod:`tidemark.operators.merge`:

* before the exchange each Arrow batch of a task keeps one event a key, so a key
  with a third of all events sends a few rows a task;
* the batch time comes from the query's offset log, and a batch's folder is
  published by one rename, so a repeated batch gives the same rows once.

The folder is a change log of curated rows, one per key and batch in which the
key changed; :func:`read_upserts` gives the newest row of each key.  One query
owns one folder: its checkpoint holds the state that the rows come from.

Attributes travel through the state as JSON text written and parsed by Spark, so
NULLs, decimals and microseconds come back as they were.
"""

from __future__ import annotations

from typing import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidemark.functions.casting import rename_to_curated
from tidemark.functions.ordering import sortable
from tidemark.operators.keys import dense_keys, with_computed
from tidemark.operators.latest import event_order
from tidemark.operators.quality import split_tagged, tag_rejects
from tidemark.sources.changes import raw_schema
from tidemark.spec import OP_DELETE, OP_INSERT, OP_UPDATE, TableSpec, spark_type
from tidemark.streaming.publish import publish, query_id

#: The batch that wrote a row of the folder.
VERSION = "_batch"
_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
_HELD = "upd string, ins string, first_at bigint, last_at bigint, deleted boolean"


def _types(spec: TableSpec) -> dict[str, T.DataType]:
    return {spec.curated(f.name): spark_type(f.dtype) for f in spec.fields}


def _struct(spec: TableSpec, columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, _types(spec)[c]) for c in columns])


def _split(spec: TableSpec) -> tuple[list[str], list[str], list[str]]:
    keys = list(spec.keys)
    upd = [c for c in spec.update_columns if c not in keys]
    return keys, upd, [c for c in spec.insert_only if c not in keys and c not in upd]


def _newest(keys: list[str]):
    """Per Arrow batch, the last event of each key."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.sort_values("_order", kind="stable").drop_duplicates(keys, keep="last")
    return run


def _apply(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """The MERGE clauses for one key and one batch."""
    best = max((row for b in batches for row in zip(b["_order"], b["_op"], b["_upd"], b["_ins"], b["_at"])),
               key=lambda row: row[0])
    _, op, upd, ins, at = best
    at = int(at)
    if state.exists:
        held = state.get
        if op == OP_DELETE:
            new = (held[0], held[1], held[2], at, True)
        elif op in (OP_UPDATE, OP_INSERT):
            new = (upd, held[1], held[2], at, False)
        else:
            return
    elif op is not None and op != OP_DELETE:
        new = (upd, ins, at, at, False)
    else:
        return
    state.update(new)
    yield pd.DataFrame([(*key, *new)], columns=[f"k{i}" for i in range(len(key))]
                       + ["upd", "ins", "first_at", "last_at", "deleted"])


def upserts(raw: DataFrame, spec: TableSpec, strict_reference: bool = False) -> DataFrame:
    """Streaming RAW rows -> changed keys of each micro-batch, as curated rows."""
    keys, upd, ins = _split(spec)
    good, _ = split_tagged(tag_rejects(raw, spec, strict_reference))
    events = rename_to_curated(good, spec)

    def text(columns: list[str]):
        return F.to_json(F.struct(*columns), _JSON) if columns else F.lit("{}")

    slim = events.select(*keys, sortable(events, event_order(spec)).alias("_order"), F.col(spec.op_col).alias("_op"),
                         text(upd).alias("_upd"), text(ins).alias("_ins"),
                         F.unix_micros(F.current_timestamp()).alias("_at"))
    fewer = slim.mapInPandas(_newest(keys), slim.schema)
    out = T.StructType([T.StructField(f"k{i}", slim.schema[k].dataType) for i, k in enumerate(keys)]
                       + T.StructType.fromDDL(_HELD).fields)
    return fewer.groupBy(*keys).applyInPandasWithState(_apply, out, _HELD, "update", GroupStateTimeout.NoTimeout)


def _curated(rows: DataFrame, spec: TableSpec) -> DataFrame:
    keys, upd, ins = _split(spec)
    got = rows.withColumns({"_u": F.from_json("upd", _struct(spec, upd), _JSON),
                            "_i": F.from_json("ins", _struct(spec, ins), _JSON) if ins else F.lit(None)})
    cols = [F.col(f"k{i}").alias(k) for i, k in enumerate(keys)]
    cols += [F.col(f"_u.{c}" if c in upd else f"_i.{c}").alias(c) for c in spec.event_columns if c not in keys]

    def time(c: str):
        return F.to_timestamp_ntz(F.date_format(F.timestamp_micros(c), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))

    if spec.has_first_seen:
        cols.append(time("first_at").alias("dw_first_seen_at"))
    cols += [time("last_at").alias("dw_last_updated_at"), F.col("deleted").alias("is_deleted"), F.col(VERSION)]
    return with_computed(got.select(*cols), spec)


def start_upsert(spark: SparkSession, raw_path: str, out_path: str, spec: TableSpec, checkpoint: str,
                 once: bool = False, schedule: str = "5 minutes", max_files_per_trigger: int | None = None,
                 strict_reference: bool = False) -> StreamingQuery:
    """RAW as a stream -> keyed state -> changed rows under ``out_path``.

    Rows that cannot be merged take no part; :func:`start_quarantine` keeps them.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(raw_path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)
    reader = spark.readStream.schema(raw_schema(spec)).option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)

    def run(df: DataFrame, batch_id: int) -> None:
        publish(_curated(df.withColumn(VERSION, F.lit(batch_id).cast("bigint")), spec), out_path, query_id(df), batch_id)

    w = (upserts(reader.parquet(raw_path), spec, strict_reference).writeStream.outputMode("update")
         .foreachBatch(run).option("checkpointLocation", checkpoint))
    return (w.trigger(availableNow=True) if once else w.trigger(processingTime=schedule)).start()


def start_quarantine(spark: SparkSession, raw_path: str, out_path: str, spec: TableSpec, checkpoint: str,
                     once: bool = False, schedule: str = "5 minutes", strict_reference: bool = False) -> StreamingQuery:
    """RAW rows that cannot be merged, with their reasons, appended once each."""
    raw = spark.readStream.schema(raw_schema(spec)).option("recursiveFileLookup", "true").parquet(raw_path)
    bad = tag_rejects(raw, spec, strict_reference).where("_reject_reason is not null")
    w = (bad.writeStream.format("parquet").option("path", out_path).option("checkpointLocation", checkpoint))
    return (w.trigger(availableNow=True) if once else w.trigger(processingTime=schedule)).start()


def upsert_schema(spec: TableSpec) -> T.StructType:
    kinds = {**_types(spec), "dw_first_seen_at": T.TimestampNTZType(), "dw_last_updated_at": T.TimestampNTZType(),
             "is_deleted": T.BooleanType()}
    names = [c for c in spec.curated_columns if c in kinds and c not in spec.computed]
    return T.StructType([T.StructField(c, kinds[c]) for c in names] + [T.StructField(VERSION, T.LongType())])


def read_upserts(spark: SparkSession, out_path: str, spec: TableSpec) -> DataFrame:
    """The curated table: the newest row of each key (one keyed aggregation with
    map-side combine over the folder).  Surrogate keys are numbered by first
    batch and key, so they stay the same as the folder grows."""
    rows = spark.read.schema(upsert_schema(spec)).option("recursiveFileLookup", "true").parquet(out_path)
    rest = [c for c in rows.columns if c not in spec.keys and c != VERSION]
    newest = rows.groupBy(*spec.keys).agg(F.max_by(F.struct(*rest), VERSION).alias("_r"), F.min(VERSION).alias("_first"))
    out = with_computed(newest.select(*spec.keys, "_r.*", "_first"), spec)
    if spec.surrogate_key:
        out = dense_keys(out, ["_first", *spec.keys], spec.surrogate_key)
    return out.select(*[c for c in spec.curated_columns if c in out.columns])
