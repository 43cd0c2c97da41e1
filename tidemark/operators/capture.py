"""Change capture as Spark jobs: full load (S8) and snapshot difference."""

from __future__ import annotations

import datetime as _dt
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.latest import latest_events
from tidemark.spec import OP_DELETE, OP_INSERT, OP_UPDATE, TableSpec


def snapshot_to_changes(df: DataFrame, captured_at: _dt.datetime | Column,
                        op_col: str = "op", ts_col: str = "_captured_at") -> DataFrame:
    """Every row of a snapshot as an insert event (the full-load phase)."""
    ts = captured_at if isinstance(captured_at, Column) else F.lit(captured_at)
    return df.select(F.lit(OP_INSERT).alias(op_col), ts.cast("timestamp_ntz").alias(ts_col),
                     *df.columns)


def snapshot_as_of(log: DataFrame, spec: TableSpec, before: _dt.datetime | None) -> DataFrame:
    """The source table as it stood before ``before``: latest event per key
    among earlier events, deleted keys dropped (``None`` = whole log)."""
    if before is not None:
        log = log.where(F.col(spec.ts_col) < F.lit(before))
    latest = latest_events(log, spec, method="agg")
    return latest.where(F.col(spec.op_col) != OP_DELETE)


def snapshot_diff(prev: DataFrame, curr: DataFrame, keys: Sequence[str],
                  columns: Sequence[str], captured_at: _dt.datetime | Column,
                  op_col: str = "op", ts_col: str = "_captured_at") -> DataFrame:
    """Change events that turn ``prev`` into ``curr``.

    One full outer join on the key: a key only in ``curr`` is ``I`` (after
    image), only in ``prev`` is ``D`` (before image), in both with any column
    ``IS DISTINCT FROM`` the other is ``U`` (after image).  Equal rows emit
    nothing.
    """
    keys = list(keys)
    p = prev.select(*keys, *[F.col(c).alias("p__" + c) for c in columns], F.lit(True).alias("_p"))
    c = curr.select(*keys, *[F.col(x).alias("c__" + x) for x in columns], F.lit(True).alias("_c"))
    j = p.join(c, keys, "full_outer")
    in_p, in_c = F.col("_p").isNotNull(), F.col("_c").isNotNull()
    changed = F.lit(False)
    for x in columns:
        changed = changed | ~F.col("p__" + x).eqNullSafe(F.col("c__" + x))
    op = (F.when(in_p & in_c & changed, OP_UPDATE).when(~in_p, OP_INSERT)
          .when(~in_c, OP_DELETE))
    ts = captured_at if isinstance(captured_at, Column) else F.lit(captured_at)
    return (j.withColumn(op_col, op).where(F.col(op_col).isNotNull())
            .select(F.col(op_col), ts.cast("timestamp_ntz").alias(ts_col), *keys,
                    *[F.when(in_c, F.col("c__" + x)).otherwise(F.col("p__" + x)).alias(x)
                      for x in columns]))


def changes_between(log: DataFrame, spec: TableSpec, columns: Sequence[str],
                    before: _dt.datetime, captured_at: _dt.datetime | Column,
                    ts_col_out: str = "_captured_at") -> DataFrame:
    """Snapshot difference of one log between ``before`` and its end, fused.

    Equal to ``snapshot_diff(snapshot_as_of(log, before),
    snapshot_as_of(log, None))`` but both snapshots come out of one keyed
    aggregation -- ``max_by`` over all events next to ``max_by`` over the
    events before ``before`` -- so the whole diff is one shuffle with
    map-side combine and no join.
    """
    from tidemark.operators.latest import event_order

    keys = list(spec.keys)
    order = F.struct(*[c.alias(f"_o{i}") for i, c in enumerate(event_order(spec))])
    row = F.struct(F.col(spec.op_col).alias("_op"), *[F.col(c) for c in columns])
    early = F.col(spec.ts_col) < F.lit(before)
    agg = log.groupBy(*keys).agg(
        F.max_by(row, order).alias("_c"),
        F.max_by(F.when(early, row), F.when(early, order)).alias("_p"))
    in_p = F.col("_p").isNotNull() & (F.col("_p._op") != OP_DELETE)
    in_c = F.col("_c._op") != OP_DELETE
    changed = F.lit(False)
    for x in columns:
        changed = changed | ~F.col(f"_p.{x}").eqNullSafe(F.col(f"_c.{x}"))
    op = (F.when(in_p & in_c & changed, OP_UPDATE).when(~in_p & in_c, OP_INSERT)
          .when(in_p & ~in_c, OP_DELETE))
    ts = captured_at if isinstance(captured_at, Column) else F.lit(captured_at)
    return (agg.withColumn(spec.op_col, op).where(F.col(spec.op_col).isNotNull())
            .select(F.col(spec.op_col), ts.cast("timestamp_ntz").alias(ts_col_out), *keys,
                    *[F.when(in_c, F.col(f"_c.{x}")).otherwise(F.col(f"_p.{x}")).alias(x)
                      for x in columns]))


def cut_over(load: DataFrame, events: DataFrame, marks: DataFrame, chunk_of: str, spec: TableSpec) -> DataFrame:
    """A full load taken while changes go on, and the changes, as one log.

    The load is read chunk by chunk; ``marks`` (``_chunk``, ``_low``, ``_high``)
    says when each chunk's read began and ended, and ``chunk_of`` is the SQL
    expression that gives a key's chunk.  A row of the load may be older or
    newer than the events captured while its chunk was read, so it gives way
    to them: a row whose key has an event in ``[_low, _high]`` is dropped, any
    other stood unchanged all that time and becomes an insert at ``_low``.
    Replayed with the events, however both interleave, the table ends as the
    complete log would leave it.

    The events meet the marks, a row a chunk, on the chunk; what remains are
    distinct keys, combined map-side, so a key with a third of all events is
    one row a task; the load meets those keys once.  ``load`` has the columns
    of ``events`` but for op and capture time; columns it lacks are NULL.
    """
    keys, ts = list(spec.keys), spec.ts_col
    window = marks.select("_chunk", "_low", "_high")
    touched = (events.select(*keys, ts, F.expr(chunk_of).alias("_chunk")).join(window, "_chunk")
               .where((F.col(ts) >= F.col("_low")) & (F.col(ts) <= F.col("_high"))).select(*keys).distinct())
    kept = (load.withColumn("_chunk", F.expr(chunk_of)).join(window, "_chunk").join(touched, keys, "left_anti")
            .withColumns({spec.op_col: F.lit(OP_INSERT), ts: F.col("_low").cast(events.schema[ts].dataType)})
            .drop("_chunk", "_low", "_high"))
    return events.unionByName(kept, allowMissingColumns=True)


ACTION, IS_UPDATE = "action", "is_update"


def change_feed(prev: DataFrame, curr: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Pre- and post-images between two states of a table.

    ``action`` is ``DELETE`` for a pre-image and ``INSERT`` for a post-image; an
    update is both, with ``is_update``.  One full outer join on the key, from
    which each changed key gives one row or two.
    """
    keys = list(keys)
    p = prev.select(*keys, F.struct(*columns).alias("_p"))
    c = curr.select(*keys, F.struct(*columns).alias("_c"))
    both = p.join(c, keys, "full_outer").where(~F.col("_p").eqNullSafe(F.col("_c")))
    update = F.col("_p").isNotNull() & F.col("_c").isNotNull()
    images = F.filter(F.array(F.struct(F.lit("DELETE").alias(ACTION), F.col("_p").alias("row")),
                              F.struct(F.lit("INSERT").alias(ACTION), F.col("_c").alias("row"))),
                      lambda x: x["row"].isNotNull())
    return (both.select(*keys, update.alias(IS_UPDATE), F.inline(images))
            .select(ACTION, IS_UPDATE, *keys, "row.*"))


def apply_feed(prev: DataFrame, feed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The state after a feed: pre-images leave, post-images enter."""
    keys = list(keys)
    gone = feed.where(F.col(ACTION) == "DELETE").select(*keys)
    new = feed.where(F.col(ACTION) == "INSERT").select(*prev.columns)
    return prev.join(gone, keys, "left_anti").unionByName(new)
