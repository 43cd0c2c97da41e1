"""Change files whose physical types differ from the declared ones.

A capture tool writes what the source gave it: after a change there, amounts
may lie in Parquet as DOUBLE, INT or STRING beside files with the declared
DECIMAL.  Spark refuses to read such a file under the declared schema, and one
file stops the whole read.  So files are grouped by the physical types in their
footers; each group is read as it is, cast with a reason for every value that
does not fit, and the groups are united by name.

Footers: when all files agree (the usual case) one distributed footer read says
so.  Only otherwise is each file asked for its own, from a few threads.  The
plan grows with the number of distinct layouts, not with the number of files.
"""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor
from typing import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.casting import cast_row, try_cast
from tidemark.sources.changes import FILE_OP, FILE_TS, file_schema, list_files, raw_columns, with_ingest_metadata
from tidemark.spec import TableSpec

#: Footers asked for at a time when files differ.
THREADS = 8


def _literal(path: str) -> str:
    """A path in which no character is taken as a pattern."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def _layout(schema: T.StructType, wanted: dict[str, str]) -> T.StructType:
    """The columns of a file that the spec knows, in the file's own spelling."""
    names: dict[str, T.StructField] = {}
    for f in schema.fields:
        key = f.name.lower()
        if key in wanted:
            if key in names:
                raise ValueError(f"a change file holds {f.name} twice")
            names[key] = T.StructField(f.name, f.dataType, True)
    return T.StructType([names[k] for k in sorted(names)])


def physical_groups(spark: SparkSession, files: Sequence[str], spec: TableSpec
                    ) -> list[tuple[T.StructType, list[str]]]:
    """(layout, files) per distinct physical layout of the spec's columns."""
    wanted = {f.name.lower(): f.name for f in file_schema(spec).fields}
    paths = [_literal(p) for p in files]
    if not paths:
        return []
    try:
        merged = spark.read.option("mergeSchema", "true").parquet(*paths).schema
        return [(_layout(merged, wanted), list(files))]
    except (PySparkException, Py4JJavaError) as e:
        if "CANNOT_MERGE_SCHEMAS" not in str(e):
            raise
    with ThreadPoolExecutor(THREADS) as pool:
        schemas = list(pool.map(lambda p: spark.read.parquet(p).schema, paths))
    groups: dict[str, tuple[T.StructType, list[str]]] = {}
    for path, schema in zip(files, schemas):
        layout = _layout(schema, wanted)
        groups.setdefault(layout.json().lower(), (layout, []))[1].append(path)
    return list(groups.values())


def _typed(df: DataFrame, spec: TableSpec, on_error: str) -> DataFrame:
    """One group's rows: declared types, ``_cast_errors``, file and row."""
    here = {c.lower(): c for c in df.columns}
    meta = ["_loaded_at", "_source_file", "_source_file_row"]
    df = df.select(*[F.col(f"`{here[f.name.lower()]}`").alias(f.name) if f.name.lower() in here
                     else F.lit(None).cast(f.dataType).alias(f.name) for f in file_schema(spec).fields], *meta)
    ts, bad_ts = try_cast(df, FILE_TS, T.TimestampNTZType())
    df = df.withColumns({"_bad_ts": F.when(bad_ts, F.lit(f"bad_cast:{spec.ts_col}")),
                         FILE_OP: F.col(FILE_OP).cast("string"), FILE_TS: ts})
    out = cast_row(df, spec, on_error)
    listed = F.concat_ws(",", "_bad_ts", F.nullif("_cast_errors", F.lit("")))
    out = out.withColumn("_cast_errors", listed if on_error == "quarantine" else F.lit(""))
    return out.withColumnsRenamed({FILE_OP: spec.op_col, FILE_TS: spec.ts_col}).select(*raw_columns(spec))


def read_mixed(spark: SparkSession, source: str | Sequence[str], spec: TableSpec,
               on_error: str = "quarantine", loaded_at=None) -> DataFrame:
    """Change files of any physical types as RAW rows (``raw_columns``).

    ``source`` is a folder, read at any depth, or a list of files.  A column
    that a file lacks is NULL, one that the spec lacks is ignored, names match
    without regard to case.  ``on_error`` as in :func:`cast_row`.
    """
    if isinstance(source, str):
        source = [r.path for r in list_files(spark, source, "*.parquet").select("path").collect()]
    out = None
    for layout, files in physical_groups(spark, source, spec):
        rows = spark.read.schema(layout).parquet(*[_literal(p) for p in files])
        part = _typed(with_ingest_metadata(rows, loaded_at), spec, on_error)
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = _typed(spark.createDataFrame([], T.StructType(
            file_schema(spec).fields + [T.StructField("_loaded_at", T.TimestampNTZType()),
                                        T.StructField("_source_file", T.StringType()),
                                        T.StructField("_source_file_row", T.LongType())])), spec, on_error)
    return out
