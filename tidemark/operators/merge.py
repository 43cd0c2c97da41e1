"""MERGE of de-duplicated change events into a keyed soft-delete table.

Clauses, per key of ``latest`` (one event per key):

* matched and ``op = 'D'``        -> ``is_deleted = TRUE``, ``dw_last_updated_at``
* matched and ``op IN ('U','I')`` -> update columns overwritten (NULLs too),
  ``is_deleted = FALSE`` (un-delete), insert-only columns kept
* not matched and ``op != 'D'``   -> insert, first-seen and last-updated stamped
* anything else (NULL op, unknown op on a matched key, D of an unknown key)
  leaves the table as it is.

Physical strategy (chosen per batch from the measured size of the delta):

* ``broadcast``: ``target LEFT JOIN broadcast(latest)`` rewrites matched rows
  and keeps the rest, inserts are ``latest LEFT ANTI broadcast(touched)`` with
  ``touched = target.keys LEFT SEMI broadcast(latest.keys)``.  The target is
  streamed once per join and never shuffled.
* ``shuffle``: one full outer join on the key.  Used when the delta is too
  large to broadcast; a full outer join can neither broadcast a side nor have
  its partitions split, but both sides hold each key once, so none is skewed.

Batches that are all at hand (a backlog) go through :func:`merge_run`: their
events meet the target's row once and the same clauses are applied to it batch
after batch, so the table is not moved and written again for each of them.
"""

from __future__ import annotations

import datetime as _dt
import re
from functools import reduce
from typing import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.keys import assign_keys, dense_keys, with_computed
from tidemark.operators.latest import packed_event
from tidemark.session import cut_lineage
from tidemark.spec import OP_DELETE, OP_INSERT, OP_UPDATE, TableSpec

DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024
#: Spark's own default threshold, which says nothing about the user's wish.
SPARK_DEFAULT = 10 * 1024 * 1024


def size_terms(df: DataFrame) -> tuple[int, Column]:
    """(fixed bytes per row, per-row Column of variable bytes) for ``df``.

    Atomic values count 16 bytes (>= their in-memory width), strings and
    binaries their actual UTF-8 length, nested values their JSON length.
    """
    fixed = 16  # row overhead
    var: list[Column] = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            var.append(F.coalesce(F.octet_length(F.col(f.name)), F.lit(0)))
        elif isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)):
            var.append(F.coalesce(F.octet_length(F.to_json(F.struct(F.col(f.name)))), F.lit(0)))
        else:
            fixed += 16
    return fixed, (sum(var[1:], var[0]) if var else F.lit(0))


def estimated_bytes(df: DataFrame) -> tuple[int, int]:
    """(rows, bytes) of ``df`` measured in one aggregation pass, so the
    broadcast bound is proven by the data, not guessed from statistics."""
    fixed, var = size_terms(df)
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(var).alias("v")).first()
    n = int(row["n"] or 0)
    return n, n * fixed + int(row["v"] or 0)


def broadcast_limit(df: DataFrame, override: int | None = None) -> int:
    """Bytes up to which a measured delta is broadcast: ``override``, else the
    session's ``spark.sql.autoBroadcastJoinThreshold`` where it is set to other
    than Spark's default (-1: never), else ``DEFAULT_BROADCAST_BYTES``."""
    if override is not None:
        return override
    text = str(df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "10MB")).strip().lower()
    number, unit = re.fullmatch(r"(-?\d+)\s*([kmgt]?)i?b?", text).groups()
    size = int(number) * 1024 ** " kmgt".index(unit or " ")
    return DEFAULT_BROADCAST_BYTES if size == SPARK_DEFAULT else size


def choose_strategy(latest: DataFrame, strategy: str = "auto",
                    max_bytes: int | None = None, size: int | None = None) -> str:
    """``broadcast`` when the measured delta fits under the limit, else
    ``shuffle``; ``size`` skips the measuring job when already known."""
    if strategy != "auto":
        return strategy
    if size is None:
        _, size = estimated_bytes(latest)
    return "broadcast" if size <= broadcast_limit(latest, max_bytes) else "shuffle"


def _prefixed(df: DataFrame, keys: Sequence[str], prefix: str) -> DataFrame:
    return df.select(*[F.col(c) if c in keys else F.col(c).alias(prefix + c)
                       for c in df.columns])


def _project(spec: TableSpec, keys: list[str], t_present: Column, s_present: Column,
             batch_ts: Column, guard_late: bool, target_cols: set[str],
             old: Callable[[str], Column] = lambda c: F.col("t__" + c),
             new: Callable[[str], Column] = lambda c: F.col("s__" + c)) -> list[Column]:
    """The clauses for one row: keys, then the curated columns, out of the
    target's cells (``old``) and the event's (``new``)."""
    op = new(spec.op_col)
    matched = t_present & s_present
    fresh = F.lit(True)
    if guard_late:
        # opt-in: an event older than the applied one never overwrites it
        fresh = old("_last_event_ts").isNull() | (new(spec.ts_col) >= old("_last_event_ts"))
    do_delete = matched & (op == OP_DELETE) & fresh
    do_update = matched & op.isin(OP_UPDATE, OP_INSERT) & fresh
    do_touch = do_delete | do_update

    def t(c: str) -> Column:
        return old(c) if c in target_cols else F.lit(None)

    out: list[Column] = [F.col(k) for k in keys]
    upd = [c for c in spec.update_columns if c not in keys]
    ins = [c for c in spec.insert_only if c not in keys and c not in upd]
    for c in upd:
        out.append(F.when(~t_present | do_update, new(c))
                   .otherwise(t(c)).alias(c))
    for c in ins:
        out.append(F.when(~t_present, new(c)).otherwise(t(c)).alias(c))
    if spec.surrogate_key:
        out.append(t(spec.surrogate_key).cast("bigint").alias(spec.surrogate_key))
    if spec.has_first_seen:
        out.append(F.when(~t_present, batch_ts).otherwise(t("dw_first_seen_at"))
                   .alias("dw_first_seen_at"))
    out.append(F.when(~t_present | do_touch, batch_ts).otherwise(t("dw_last_updated_at"))
               .alias("dw_last_updated_at"))
    out.append(F.when(~t_present, F.lit(False)).when(do_delete, F.lit(True))
               .when(do_update, F.lit(False)).otherwise(t("is_deleted"))
               .alias("is_deleted"))
    if guard_late:
        out.append(F.when(~t_present | do_touch, new(spec.ts_col))
                   .otherwise(t("_last_event_ts")).alias("_last_event_ts"))
    return out


def merge_changes(target: DataFrame, latest: DataFrame, spec: TableSpec,
                  batch_ts: _dt.datetime | Column, *, strategy: str = "auto",
                  key_base: int | Column = 0, guard_late: bool = False,
                  max_broadcast_bytes: int | None = None,
                  delta_bytes: int | None = None, key_slots: int | None = None,
                  dense: bool = False) -> DataFrame:
    """Apply one batch of de-duplicated events ``latest`` to ``target``.

    ``latest`` has one row per key with ``spec.op_col``, ``spec.ts_col`` and
    the curated event columns.  ``target`` has ``spec.curated_columns``
    (computed columns may be absent; they are recomputed).  Returns the new
    full table.  ``key_base`` is the largest surrogate key already used;
    ``dense`` numbers the new rows without gaps, in key order (``key_base`` is
    then the number of rows of ``target``).
    """
    keys = list(spec.keys)
    bts = batch_ts if isinstance(batch_ts, Column) else F.lit(batch_ts)
    bts = bts.cast("timestamp_ntz")
    ev_cols = list(dict.fromkeys(keys + [spec.op_col, spec.ts_col] + spec.event_columns))
    s = _prefixed(latest.select(*ev_cols), keys, "s__").withColumn("_s", F.lit(True))
    tcols = [c for c in target.columns if c not in spec.computed]
    t = _prefixed(target.select(*tcols), keys, "t__").withColumn("_t", F.lit(True))
    tset = set(tcols)
    insertable = F.col("s__" + spec.op_col) != F.lit(OP_DELETE)

    chosen = choose_strategy(latest, strategy, max_broadcast_bytes, delta_bytes)
    if chosen == "broadcast":
        small = F.broadcast(s)
        kept = t.join(small, keys, "left")
        kept = kept.select(*_project(spec, keys, F.lit(True), F.col("_s").isNotNull(),
                                     bts, guard_late, tset))
        # keys of the target that the delta touches (semi join on the broadcast)
        touched = t.select(*keys).join(small, keys, "left_semi")
        new = (s.where(insertable).join(F.broadcast(touched), keys, "left_anti")
               .withColumn("_t", F.lit(None).cast("boolean")))
        for c in tcols:
            if c not in keys:
                new = new.withColumn("t__" + c, F.lit(None).cast(target.schema[c].dataType))
        new = new.select(*_project(spec, keys, F.lit(False), F.lit(True),
                                   bts, guard_late, tset))
    elif chosen == "shuffle":
        j = t.join(s, keys, "full_outer")
        t_present = F.col("_t").isNotNull()
        j = j.where(t_present | insertable)
        both = j.select(*_project(spec, keys, t_present, F.col("_s").isNotNull(),
                                  bts, guard_late, tset), t_present.alias("_old"))
        kept = both.where("_old").drop("_old")
        new = both.where(~F.col("_old")).drop("_old")
    else:
        raise ValueError(f"unknown strategy {strategy!r}")

    if spec.surrogate_key:
        new = new.drop(spec.surrogate_key)
        new = (dense_keys(new, keys, spec.surrogate_key, int(key_base)) if dense
               else assign_keys(new, keys, spec.surrogate_key, key_base, key_slots))
    out = kept.unionByName(new)
    out = with_computed(out, spec)
    cols = [c for c in spec.curated_columns if c in out.columns]
    if guard_late:
        cols.append("_last_event_ts")
    return out.select(*cols)


def aligned_events(log: DataFrame, spec: TableSpec, batch_col: str, batches: Sequence[int]) -> DataFrame:
    """Keys and ``_events``: the latest event of each of the given batches, in
    their order.

    One keyed aggregation with a maximum a batch: map-side combined, so a key
    with a third of all events is one row a task, and the only exchange of the
    log.  A null key equals no other, not even itself, so its batches stay rows
    of their own, as the join on the key leaves them.
    """
    keys = list(spec.keys)
    columns = list(dict.fromkeys([spec.op_col, *[c for c in spec.event_columns if c not in keys]]))
    event, place = packed_event(log, spec, columns)
    picked = log.groupBy(*keys).agg(*[F.max(F.when(F.col(batch_col) == b, event)).alias(f"_b{i}")
                                      for i, b in enumerate(batches)])
    events = F.filter(F.array(*[
        F.when(F.col(f"_b{i}").isNotNull(), F.struct(
            F.lit(i).alias("_i"), *[F.col(f"_b{i}")[f].alias(c) for c, f in place.items()]))
        for i in range(len(batches))]), lambda e: e.isNotNull())
    null_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    runs = F.when(null_key, F.transform("_events", lambda e: F.array(e))).otherwise(F.array("_events"))
    return picked.select(*keys, events.alias("_events")).select(*keys, F.explode(runs).alias("_events"))


def merge_run(target: DataFrame | None, log: DataFrame, spec: TableSpec, batch_col: str,
              batches: Mapping[int, _dt.datetime], key_base: int = 0) -> DataFrame:
    """Apply whole batches of the change log ``log``, one after the other.

    Equal to de-duplicating each of ``batches`` (batch -> merge time, in order)
    and applying it by :func:`merge_changes` with ``dense`` keys.  The target,
    None for an empty one, meets all events of a key in one join; then the
    clauses run over them in batch order.  So the cost is one exchange of the
    log and one of the target, however many batches there are.
    """
    keys = list(spec.keys)
    log = log.where(F.col(batch_col).isin(list(batches)))
    schema = (empty_target(log.sparkSession, spec, log.schema) if target is None else target).schema
    cells = [c for c in spec.event_columns if c not in keys]
    cells += [c for c in (spec.surrogate_key,) if c]
    cells += [c for c in spec.curated_columns if c not in cells + keys and c not in spec.computed]
    # ``_new`` is null for a row of the target, else the batch that inserted it.
    state = T.StructType([schema[c] for c in cells] + [T.StructField("_new", T.IntegerType())])
    nothing = F.lit(None).cast(state)
    times = F.array(*[F.lit(t).cast("timestamp_ntz") for t in batches.values()])

    def apply(row: Column, event: Column) -> Column:
        there = row.isNotNull()
        insertable = F.coalesce(event[spec.op_col] != F.lit(OP_DELETE), F.lit(False))
        after = _project(spec, [], there, F.lit(True), F.get(times, event["_i"]), False, set(cells),
                         lambda c: row[c], lambda c: event[c])
        after.append(F.when(there, row["_new"]).otherwise(event["_i"]))
        return F.when(there | insertable, F.struct(*after).cast(state)).otherwise(nothing)

    rows = aligned_events(log, spec, batch_col, list(batches))
    if target is None:
        rows = rows.withColumn("_row", nothing)
    else:
        held = F.struct(*cells, F.lit(None).cast("int").alias("_new")).cast(state)
        rows = target.select(*keys, held.alias("_row")).join(rows, keys, "full_outer")
    merged = F.when(F.col("_events").isNull(), F.col("_row")).otherwise(F.aggregate("_events", F.col("_row"), apply))
    rows = rows.select(*keys, merged.alias("_row")).where(F.col("_row").isNotNull()).select(*keys, "_row.*")
    if spec.surrogate_key:
        if target is not None:
            rows = cut_lineage(rows, "run")
        new = rows.where(F.col("_new").isNotNull()).drop(spec.surrogate_key)
        new = dense_keys(new, ["_new", *keys], spec.surrogate_key, int(key_base))
        rows = new if target is None else rows.where(F.col("_new").isNull()).unionByName(new)
    out = with_computed(rows, spec)
    return out.select(*[c for c in spec.curated_columns if c in out.columns])


def empty_target(spark, spec: TableSpec, latest_schema: T.StructType,
                 guard_late: bool = False) -> DataFrame:
    """Empty curated table whose column types follow the event columns."""
    fields = []
    for c in spec.curated_columns:
        if c == spec.surrogate_key:
            dt = T.LongType()
        elif c in ("dw_first_seen_at", "dw_last_updated_at"):
            dt = T.TimestampNTZType()
        elif c == "is_deleted":
            dt = T.BooleanType()
        elif c in spec.computed:
            continue
        else:
            dt = latest_schema[c].dataType
        fields.append(T.StructField(c, dt, True))
    if guard_late:
        fields.append(T.StructField("_last_event_ts", latest_schema[spec.ts_col].dataType, True))
    return spark.createDataFrame([], T.StructType(fields))
