"""Latest event per key (W1/W2/F2/O3) and its aggregate form (A2).

Order: the event with the greatest ``(capture ts, op priority, tie-break...)``
wins; NULL capture time sorts last.  All order keys are descending, so the
whole order is one struct compared with ``max``.

Both forms are skew-safe: the window form plans a partial
``WindowGroupLimit`` before the shuffle and the aggregate form a partial
aggregate, so a key holding a third of all rows sends at most one row per
map partition through the exchange.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.expr import op_priority
from tidemark.spec import TableSpec


def event_order(spec: TableSpec) -> list[Column]:
    """Descending total order of events of one key."""
    return ([F.col(spec.ts_col), op_priority(spec.op_col)]
            + [F.col(c) for c in spec.tiebreak])


def _orderable(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_orderable(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _orderable(kind.elementType)
    return not isinstance(kind, (T.MapType, T.VariantType))


def packed_event(df: DataFrame, spec: TableSpec, columns: Sequence[str]) -> tuple[Column, dict[str, str]]:
    """One struct whose ``max`` is the latest event, and the field of each of ``columns``.

    The order comes first and the columns that are not part of it follow, so
    every value is in the struct, and in the exchange, once; events that the
    order leaves equal are told apart by the columns.  ``columns`` must be
    orderable (no maps).
    """
    place, fields = {}, []
    for i, (c, name) in enumerate(zip(event_order(spec), [spec.ts_col, None, *spec.tiebreak])):
        fields.append(c.alias(f"_o{i}"))
        if name is not None:
            place.setdefault(name, f"_o{i}")
    for i, name in enumerate(c for c in columns if c not in place):
        fields.append(F.col(name).alias(f"_c{i}"))
        place[name] = f"_c{i}"
    return F.struct(*fields), {c: place[c] for c in columns}


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
                   method: str = "window") -> DataFrame:
    """One row per ``keys``: the row that is greatest under ``order``.

    ``method="window"`` is ``ROW_NUMBER() OVER (PARTITION BY keys ORDER BY
    order DESC NULLS LAST) = 1``; ``method="agg"`` is
    ``max_by(struct(row), struct(order))`` grouped by keys.
    """
    keys = list(keys)
    if method == "window":
        w = Window.partitionBy(*keys).orderBy(*[c.desc_nulls_last() for c in order])
        return (df.withColumn("_rn", F.row_number().over(w))
                .where(F.col("_rn") == 1).drop("_rn"))
    if method == "agg":
        rest = [c for c in df.columns if c not in keys]
        ordering = F.struct(*[c.alias(f"_o{i}") for i, c in enumerate(order)])
        picked = (df.groupBy(*keys)
                  .agg(F.max_by(F.struct(*rest), ordering).alias("_latest")))
        return picked.select(*keys, *[F.col("_latest")[c].alias(c) for c in rest])
    raise ValueError(f"unknown method {method!r}")


def latest_events(df: DataFrame, spec: TableSpec, method: str = "window",
                  extra_keys: Sequence[str] = ()) -> DataFrame:
    """Latest event per natural key of ``spec`` (optionally per batch too)."""
    keys = list(spec.keys) + list(extra_keys)
    rest = [c for c in df.columns if c not in keys]
    if method == "agg" and all(_orderable(df.schema[c].dataType) for c in rest):
        event, place = packed_event(df, spec, rest)
        picked = df.groupBy(*keys).agg(F.max(event).alias("_latest"))
        return picked.select(*keys, *[F.col("_latest")[f].alias(c) for c, f in place.items()])
    return latest_per_key(df, keys, event_order(spec), method)
