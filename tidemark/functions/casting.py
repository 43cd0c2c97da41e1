"""Column shaping of change rows.

All of it is projection: ``select`` / ``withColumns`` with built-in
expressions, so it fuses into the scan's whole-stage codegen.
"""

from __future__ import annotations

import datetime as _dt
from typing import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.spec import OP_UPDATE, TableSpec, spark_type


def lowercase_columns(df: DataFrame) -> DataFrame:
    """Lower-case every column name (capture tools may upper-case them)."""
    return df.toDF(*[c.lower() for c in df.columns])


def extract_json_fields(df: DataFrame, source: str, spec: TableSpec,
                        names: Sequence[str] | None = None) -> DataFrame:
    """Typed fields out of a JSON text column via VARIANT path access.

    ``$1:field::TYPE`` becomes ``try_variant_get(parse_json(src), '$.field',
    type)``: the text is parsed once per row into a variant and each field is
    read with its declared type.  Text that is no JSON and values that do not
    fit give NULL and a reason in ``_cast_errors`` (``bad_json``,
    ``bad_cast:<col>``; empty when none) for the quarantine split.
    """
    v = F.try_parse_json(F.col(source))
    names = list(names) if names is not None else spec.field_names
    types = {f.name: f.dtype for f in spec.fields}
    doc = F.col("_v")
    got = {n: F.try_variant_get(doc, f"$.{n}", types[n]) for n in names}
    held = {n: F.try_variant_get(doc, f"$.{n}", "variant") for n in names}
    errors = [F.when(F.col(source).isNotNull() & doc.isNull(), F.lit("bad_json"))]
    errors += [F.when(held[n].isNotNull() & ~F.is_variant_null(held[n]) & got[n].isNull(),
                      F.lit(f"bad_cast:{n}")) for n in names]
    return df.withColumn("_v", v).select(
        "*", *[c.alias(n) for n, c in got.items()],
        F.concat_ws(",", *errors).alias("_cast_errors")).drop("_v")


ON_ERROR = ("quarantine", "null", "fail")


def _castable(spark: SparkSession, have: T.DataType, target: T.DataType) -> bool:
    """Whether the analyzer has a cast between the two types at all."""
    try:
        spark.range(0).select(F.lit(None).cast(have).try_cast(target)).schema
    except AnalysisException:
        return False
    return True


def try_cast(df: DataFrame, column: str, target: T.DataType) -> tuple[Column, Column]:
    """(value, failed): the column in the target type, NULL where it does not
    fit.  Types without a cast, overflow, text that is no such value, and a
    fraction that an integer cannot hold do not fit; a NULL is no failure."""
    have, src = df.schema[column].dataType, F.col(f"`{column}`")
    if not _castable(df.sparkSession, have, target):
        return F.lit(None).cast(target), src.isNotNull()
    value = src.try_cast(target)
    failed = src.isNotNull() & value.isNull()
    if isinstance(target, T.IntegralType) and isinstance(have, (T.FractionalType, T.DecimalType)):
        whole = value.cast("decimal(20,0)") == src.try_cast("decimal(38,18)")
        failed = src.isNotNull() & ~F.coalesce(whole, F.lit(False))
        value = F.when(~failed, value)
    return value, failed


def cast_row(df: DataFrame, spec: TableSpec, on_error: str = "quarantine") -> DataFrame:
    """Cast every spec field to its declared type.

    ``on_error`` says what a value that does not fit does: ``quarantine`` gives
    NULL and lists ``bad_cast:<col>`` in ``_cast_errors`` (empty when none) for
    the quarantine split, ``null`` gives NULL without a word, ``fail`` ends the
    query with the column's name.
    """
    if on_error not in ON_ERROR:
        raise ValueError(f"on_error must be one of {ON_ERROR}, not {on_error!r}")
    errors: list[Column] = []
    cols: dict[str, Column] = {}
    for f in spec.fields:
        if f.name not in df.columns:
            continue
        target = spark_type(f.dtype)
        if df.schema[f.name].dataType == target:
            continue
        value, failed = try_cast(df, f.name, target)
        if on_error == "fail":
            value = F.when(failed, F.raise_error(F.lit(f"bad_cast:{f.name}")).cast(target)).otherwise(value)
        cols[f.name] = value
        errors.append(F.when(failed, F.lit(f"bad_cast:{f.name}")))
    listed = F.concat_ws(",", *errors) if errors and on_error == "quarantine" else F.lit("")
    out = df.withColumn("_cast_errors", listed)
    return out.withColumns(cols) if cols else out


def rename_to_curated(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Apply ``spec.renames``."""
    present = {k: v for k, v in spec.renames.items() if k in df.columns}
    return df.withColumnsRenamed(present) if present else df


def project_spec(df: DataFrame, spec: TableSpec, leading: Sequence[str] = ()) -> DataFrame:
    """Select in spec order, dropping unknown columns (P4 + ignore extras)."""
    return df.select(*leading, *[c for c in spec.field_names if c in df.columns])


def apply_defaults(df: DataFrame, spec: TableSpec, now: _dt.datetime,
                   today: _dt.date) -> DataFrame:
    """Add declared defaults for columns absent from the input.

    A column that is present keeps its value, an explicit NULL included --
    exactly like an INSERT that names the column.
    """
    add: dict[str, Column] = {}
    for f in spec.fields:
        if f.name in df.columns or f.default is None:
            continue
        if f.default == "now":
            value = F.lit(now)
        elif f.default == "today":
            value = F.lit(today)
        else:
            value = F.expr(f.default)
        add[f.name] = value.cast(spark_type(f.dtype))
    return df.withColumns(add) if add else df


def conform(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Spec columns in spec order; a column the input lacks is a typed NULL."""
    return df.select(*[F.col(f.name) if f.name in df.columns
                       else F.lit(None).cast(spark_type(f.dtype)).alias(f.name)
                       for f in spec.fields])


def stamp_updated(df: DataFrame, spec: TableSpec, now: _dt.datetime) -> DataFrame:
    """Set the spec's updated-at column to ``now`` on every U row."""
    if not spec.stamp_updated:
        return df
    c = spec.stamp_updated
    dtype = spark_type(next(f.dtype for f in spec.fields if f.name == c))
    return df.withColumn(c, F.when(F.col(spec.op_col) == OP_UPDATE,
                                   F.lit(now).cast(dtype)).otherwise(F.col(c)))
