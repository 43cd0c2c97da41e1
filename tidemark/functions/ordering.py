"""One text per row that sorts like several typed columns."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _part(c: Column, kind: T.DataType) -> Column:
    if isinstance(kind, (T.IntegralType, T.BooleanType)):
        if isinstance(kind, T.BooleanType):
            c = c.cast("int")
        return F.lpad((c.cast("decimal(20,0)") + F.lit(str(1 << 63)).cast("decimal(20,0)")).cast("string"), 20, "0")
    if isinstance(kind, T.DecimalType) and kind.precision < 38:
        whole = c.cast(f"decimal(37,{kind.scale})") + F.lit(str(10 ** (kind.precision - kind.scale))).cast("decimal(38,0)")
        return F.lpad(whole.cast(f"decimal(38,{kind.scale})").cast("string"), 39, "0")
    if isinstance(kind, T.DateType):
        return _part(F.unix_date(c), T.IntegerType())
    if isinstance(kind, T.TimestampType):
        return _part(F.unix_micros(c), T.LongType())
    if isinstance(kind, T.TimestampNTZType):  # years 0001 to 9999
        return c.cast("string")
    if isinstance(kind, T.StringType):
        return F.hex(F.encode(c, "UTF-8"))
    raise ValueError(f"no sortable text for {kind.simpleString()}")


def sortable(df: DataFrame, columns: Sequence[Column]) -> Column:
    """A text whose byte order is the order of ``columns`` compared one after
    the other, NULL before every value.  A blank, which sorts before all signs
    in use, ends each part, so a shorter text comes first."""
    kinds = [f.dataType for f in df.select(*columns).schema.fields]
    parts = [F.when(c.isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), _part(c, k)))
             for c, k in zip(columns, kinds)]
    return F.concat_ws(" ", *parts)
