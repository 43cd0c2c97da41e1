"""Change files -> RAW.

A change file holds ``Op``, ``_timestamp`` and the source row.  RAW keeps
every event, append-only, with its load time, source file and row number in
the file.  Reads use an explicit schema (no inference); columns the file
lacks read as NULL, extra file columns are ignored, names match without
regard to case.  CSV columns go by the header's names: a batch read takes the
order from the files, a stream from ``header`` (default: declared order), and a
file with any other header fails the read instead of being shifted.
"""

from __future__ import annotations

import datetime as _dt
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.spec import TableSpec

# Column names written by the capture service into each change file.
FILE_OP, FILE_TS = "Op", "_timestamp"
LAYERS = ("raw", "staging", "curated")


def layer_path(base: str, layer: str, table: str) -> str:
    """``<base>/<layer>/<table>`` for the RAW / STAGING / CURATED layers."""
    if layer.lower() not in LAYERS:
        raise ValueError(f"unknown layer {layer!r}")
    return f"{base.rstrip('/')}/{layer.lower()}/{table}"


def landing_path(root: str, spec: TableSpec) -> str:
    """Where a table's change files land under a shared root: its prefix."""
    if not spec.source_prefix:
        raise ValueError(f"{spec.name} has no source prefix")
    return f"{root.rstrip('/')}/{spec.source_prefix.strip('/')}"


def file_schema(spec: TableSpec, as_text: bool = False) -> T.StructType:
    """Read schema of a change file; ``as_text`` reads every field as string
    (CSV), leaving the typed cast to :func:`cast_row`."""
    fields = [T.StructField(FILE_OP, T.StringType()),
              T.StructField(FILE_TS, T.StringType() if as_text else T.TimestampNTZType())]
    for f in spec.schema.fields:
        fields.append(T.StructField(f.name, T.StringType() if as_text else f.dataType))
    return T.StructType(fields)


def _normalise(df: DataFrame, spec: TableSpec) -> DataFrame:
    return df.withColumnsRenamed({FILE_OP: spec.op_col, FILE_TS: spec.ts_col})


def _read_csv(reader, path: str, spec: TableSpec, header: Sequence[str]) -> DataFrame:
    """CSV columns under the names of ``header``, as text, in file-schema order."""
    names = [h.strip() for h in header]
    here = {h.lower(): h for h in names}
    if len(here) < len(names):
        raise ValueError(f"CSV header names a column twice: {names}")
    missing = [k for k in (FILE_OP, FILE_TS, *spec.keys) if k.lower() not in here]
    if missing:
        raise ValueError(f"CSV header lacks {missing}: {names}")
    # every file's header is held against this one; pruning would hide columns
    df = (reader.schema(T.StructType([T.StructField(h, T.StringType()) for h in names]))
          .option("header", True).option("enforceSchema", False).option("columnPruning", False)
          .csv(path))
    return df.select(*[F.col(f"`{here[f.name.lower()]}`").alias(f.name) if f.name.lower() in here
                       else F.lit(None).cast("string").alias(f.name)
                       for f in file_schema(spec, as_text=True).fields])


def read_changes(spark: SparkSession, path: str, spec: TableSpec,
                 fmt: str = "parquet", header: Sequence[str] | None = None) -> DataFrame:
    """Batch read of the change files under ``path`` (S1 Parquet, S9 CSV).

    Files are found at any depth below the prefix (capture tools write
    date folders), and folder names are not taken as partition columns.
    """
    reader = spark.read.option("recursiveFileLookup", "true")
    if fmt == "parquet":
        df = reader.schema(file_schema(spec)).parquet(path)
    elif fmt == "csv":
        names = header or reader.option("header", True).csv(path).columns
        df = _read_csv(spark.read.option("recursiveFileLookup", "true"), path, spec, names)
    else:
        raise ValueError(f"unsupported format {fmt!r}")
    return _normalise(df, spec)


def read_changes_stream(spark: SparkSession, path: str, spec: TableSpec,
                        fmt: str = "parquet", max_files_per_trigger: int | None = None,
                        header: Sequence[str] | None = None) -> DataFrame:
    """Streaming read: each new file under ``path`` is delivered once."""
    reader = spark.readStream.option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if fmt == "parquet":
        df = reader.schema(file_schema(spec)).parquet(path)
    elif fmt == "csv":
        df = _read_csv(reader, path, spec, header or file_schema(spec).fieldNames())
    else:
        raise ValueError(f"unsupported format {fmt!r}")
    return _normalise(df, spec)


def with_ingest_metadata(df: DataFrame, loaded_at: _dt.datetime | None = None,
                         row_index: bool = True) -> DataFrame:
    """Add ``_loaded_at``, ``_source_file`` and ``_source_file_row``.

    The file and row come from the scan's hidden ``_metadata`` column (works
    in batch and streaming).  ``_loaded_at`` is one value per query / per
    micro-batch.  ``row_index`` exists for Parquet only; CSV rows get NULL.
    """
    ts = F.lit(loaded_at).cast("timestamp_ntz") if loaded_at else F.localtimestamp()
    rowcol = (F.col("_metadata.row_index") if row_index
              else F.lit(None).cast("bigint"))
    return df.select("*", ts.alias("_loaded_at"),
                     F.col("_metadata.file_path").alias("_source_file"),
                     rowcol.alias("_source_file_row"))


def raw_columns(spec: TableSpec) -> list[str]:
    return ([spec.op_col, spec.ts_col] + spec.field_names
            + ["_loaded_at", "_source_file", "_source_file_row", "_cast_errors"])


def to_raw(changes: DataFrame, spec: TableSpec, loaded_at: _dt.datetime | None = None,
           row_index: bool = True) -> DataFrame:
    """Change rows in RAW shape: explicit column list, metadata appended.

    ``_cast_errors`` keeps the reasons of values that did not fit their type
    (NULL or empty: none), for the quarantine split before the merge.
    """
    if "_cast_errors" not in changes.columns:
        changes = changes.withColumn("_cast_errors", F.lit(None).cast("string"))
    return with_ingest_metadata(changes, loaded_at, row_index).select(*raw_columns(spec))


def append_raw(raw: DataFrame, path: str) -> None:
    """Append to the RAW directory (S3); RAW is never rewritten.

    A directory that a streaming query writes is refused: readers follow that
    query's log there, so rows beside it would never be seen.
    """
    spark = raw.sparkSession
    log = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/_spark_metadata")
    if log.getFileSystem(spark._jsc.hadoopConfiguration()).exists(log):
        raise ValueError(f"{path} belongs to a streaming sink; append to another directory")
    raw.write.mode("append").parquet(path)


def raw_schema(spec: TableSpec) -> T.StructType:
    return T.StructType(
        [T.StructField(spec.op_col, T.StringType()),
           T.StructField(spec.ts_col, T.TimestampNTZType())]
        + list(spec.schema.fields)
        + [T.StructField("_loaded_at", T.TimestampNTZType()),
           T.StructField("_source_file", T.StringType()),
           T.StructField("_source_file_row", T.LongType()),
           T.StructField("_cast_errors", T.StringType())])


def read_raw(spark: SparkSession, path: str, spec: TableSpec) -> DataFrame:
    return spark.read.schema(raw_schema(spec)).option("recursiveFileLookup", "true").parquet(path)


def list_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Landed files: path, size and modification time.

    Only metadata columns are selected, so file contents are never read.
    """
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob)
            .option("recursiveFileLookup", "true").load(path)
            .select("path", "length", "modificationTime"))
