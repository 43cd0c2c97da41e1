"""Load / run monitoring (A1, A3-A6, O1-O2, F3): history tables as DataFrames."""

from __future__ import annotations

import datetime as _dt
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.expr import within_hours_before


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``SELECT 'name' AS tbl, COUNT(*) AS n ... UNION ALL ...``."""
    out = None
    for name, df in tables.items():
        part = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("tbl"), "n")
        out = part if out is None else out.unionAll(part)
    return out


def op_mix(df: DataFrame, op_col: str = "op", by: Sequence[str] = ()) -> DataFrame:
    """Event count per op (and optional grouping, e.g. batch)."""
    return df.groupBy(*by, op_col).agg(F.count(F.lit(1)).alias("n"))


def newest(df: DataFrame, order: Sequence[Column], n: int = 50) -> DataFrame:
    """Top-n by a descending order (O1/O2); planned as TakeOrderedAndProject,
    i.e. a per-partition top-n and one merge of n rows per partition."""
    return df.orderBy(*[c.desc_nulls_last() for c in order]).limit(n)


def in_last_hours(df: DataFrame, ts_col: str, end: _dt.datetime, hours: int = 24) -> DataFrame:
    """Rows with ``ts`` in ``[end - hours, end)`` (F3/E5); pushed to the scan."""
    return df.where(within_hours_before(ts_col, end, hours))


def plain_path(column: str = "_source_file") -> Column:
    """A scan's file path as a listing spells it: ``_metadata.file_path`` is a
    URI, with blanks and other signs escaped and three slashes after ``file:``."""
    c = F.regexp_replace(F.col(column), r"^file:/+", "file:/")
    return F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))


LOG_COLUMNS = ("table_name string, path string, row_count bigint, rejected bigint, "
               "loaded_at timestamp_ntz")


def file_log(rows: DataFrame, files: Sequence[str], table: str, loaded_at: _dt.datetime) -> DataFrame:
    """One row per file of a batch: rows loaded from it and rows with a cast
    error.  ``files`` are the batch's landed files, so one without rows is
    logged too; ``rows`` are the batch's RAW rows only."""
    spark = rows.sparkSession
    landed = spark.createDataFrame([(f,) for f in files], "path string").select(
        F.regexp_replace("path", r"^file:/+", "file:/").alias("path"))
    counts = rows.groupBy(plain_path().alias("path")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("_cast_errors") != "").alias("bad"))
    return landed.join(counts, "path", "left").select(
        F.lit(table).alias("table_name"), "path", F.coalesce("n", F.lit(0)).cast("bigint").alias("row_count"),
        F.coalesce("bad", F.lit(0)).cast("bigint").alias("rejected"), F.lit(loaded_at).cast("timestamp_ntz").alias("loaded_at"))


def read_file_log(spark, path: str) -> DataFrame:
    return spark.read.schema(LOG_COLUMNS).option("recursiveFileLookup", "true").parquet(path)


def load_history(loads: DataFrame, since: _dt.datetime | None = None,
                 until: _dt.datetime | None = None) -> DataFrame:
    """Rows and first/last load time per source file, newest first (A3).

    ``loads`` is the file log (a row per file and batch) or, where none is
    kept, RAW itself.  The window filter is applied to the load time before
    grouping, so the Parquet scan skips older row groups.
    """
    logged = "row_count" in loads.columns
    at = F.col("loaded_at" if logged else "_loaded_at")
    if since is not None:
        loads = loads.where(at >= F.lit(since))
    if until is not None:
        loads = loads.where(at < F.lit(until))
    name = F.col("path") if logged else F.col("_source_file")
    return (loads.groupBy(name.alias("_source_file"))
            .agg((F.sum("row_count") if logged else F.count(F.lit(1))).alias("row_count"),
                 F.min(at).alias("first_load_time"), F.max(at).alias("last_load_time"))
            .orderBy(F.col("last_load_time").desc_nulls_last(), F.col("_source_file")))


def ingest_status(landed: DataFrame, loads: DataFrame) -> DataFrame:
    """Landed vs loaded vs pending file counts (A4).

    ``landed`` is a file listing (``path`` column, see ``list_files``); a file
    is loaded when the file log names it or, where ``loads`` is RAW, when RAW
    holds rows from it.  Both sides are de-duplicated map-side, so the one full
    outer join on the path moves one row per file.
    """
    loaded = loads.select(F.col("path") if "row_count" in loads.columns else plain_path().alias("path"))
    landed_p = landed.select(F.regexp_replace("path", r"^file:/+", "file:/").alias("path"), F.lit(True).alias("_landed"))
    both = landed_p.distinct().join(loaded.withColumn("_loaded", F.lit(True)).distinct(), "path", "full_outer")
    return both.agg(
        F.count_if(F.col("_landed").isNotNull()).alias("landed"),
        F.count_if(F.col("_loaded").isNotNull()).alias("loaded"),
        F.count_if(F.col("_landed").isNotNull() & F.col("_loaded").isNull()).alias("pending"))


def run_history(audit: DataFrame, since: _dt.datetime | None = None,
                limit: int = 50) -> DataFrame:
    """Merge runs since a time, newest ``limit`` first (A5)."""
    if since is not None:
        audit = audit.where(F.col("started_at") >= F.lit(since))
    return audit.orderBy(F.col("started_at").desc_nulls_last(),
                         F.col("batch_id").desc()).limit(limit)
