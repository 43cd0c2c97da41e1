"""Incremental replay (J1/J2): what a key keeps between batches, and its merge.

The fold of a set of whole batches is one row a key:

* ``_first`` -- batch, merge time and insert-only columns of the first batch
  whose latest event is not a delete,
* ``_live`` -- batch and update columns of the last such batch,
* ``_last`` -- batch, merge time and op of the last batch.

Two folds of disjoint batches merge field by field (smallest batch, greatest
batch, greatest batch), so merging is associative and commutative: batches may
be folded one by one, in any grouping and any order, on any number of machines.
``state + new events`` is one keyed aggregation with map-side combine; a key
with a third of all events is one row a task in the exchange.  A key that was
only ever deleted keeps its row, because an earlier batch may still bring its
insert; :func:`curated` leaves such keys out, as the MERGE does.

The batch is the unit: all events of one batch must be folded together, since
only the latest of them counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.keys import dense_keys, with_computed
from tidemark.operators.latest import latest_events
from tidemark.spec import OP_DELETE, TableSpec

#: Name of the batch inside the three structs.
BATCH = "_b"


def _columns(spec: TableSpec) -> tuple[list[str], list[str], list[str]]:
    """Keys, update columns and insert-only columns, each named once."""
    keys = list(spec.keys)
    upd = [c for c in spec.update_columns if c not in keys]
    return keys, upd, [c for c in spec.insert_only if c not in keys and c not in upd]


def fold_batches(events: DataFrame, spec: TableSpec, batch_col: str,
                 batch_ts_col: str | None = None) -> DataFrame:
    """Fold of whole batches of quarantined events: keys, ``_first _live _last``."""
    keys, upd, ins = _columns(spec)
    bts = batch_ts_col or batch_col
    needed = list(dict.fromkeys(keys + [spec.op_col, spec.ts_col, *spec.tiebreak, batch_col, bts] + upd + ins))
    latest = latest_events(events.select(*needed), spec, method="agg", extra_keys=[batch_col])
    live = F.col(spec.op_col) != F.lit(OP_DELETE)
    b = F.col(batch_col)
    return merge_states(latest.select(
        *keys,
        F.when(live, F.struct(b.alias(BATCH), F.col(bts).alias("_bts"), *ins)).alias("_first"),
        F.when(live, F.struct(b.alias(BATCH), *upd)).alias("_live"),
        F.struct(b.alias(BATCH), F.col(bts).alias("_bts"), F.col(spec.op_col).alias("_op")).alias("_last")), spec)


def merge_states(states: DataFrame, spec: TableSpec) -> DataFrame:
    """One row a key out of any number of folds of disjoint batches, united."""
    return states.groupBy(*spec.keys).agg(
        F.min_by("_first", f"_first.{BATCH}").alias("_first"),
        F.max_by("_live", f"_live.{BATCH}").alias("_live"),
        F.max_by("_last", f"_last.{BATCH}").alias("_last"))


def advance(state: DataFrame | None, events: DataFrame, spec: TableSpec, batch_col: str,
            batch_ts_col: str | None = None) -> DataFrame:
    """The state after some more whole batches; ``state`` None is the empty table."""
    new = fold_batches(events, spec, batch_col, batch_ts_col)
    return new if state is None else merge_states(state.unionByName(new), spec)


def curated(state: DataFrame, spec: TableSpec, with_keys: bool = True) -> DataFrame:
    """The curated table that a state stands for (equal to :func:`replay_changes`
    with ``dense`` keys)."""
    keys, upd, _ = _columns(spec)
    cols = [F.col(k) for k in keys]
    cols += [F.col(f"_live.{c}" if c in upd else f"_first.{c}").alias(c)
             for c in spec.event_columns if c not in keys]
    if spec.has_first_seen:
        cols.append(F.col("_first._bts").alias("dw_first_seen_at"))
    cols += [F.col("_last._bts").alias("dw_last_updated_at"),
             (F.col("_last._op") == F.lit(OP_DELETE)).alias("is_deleted")]
    first = F.col(f"_first.{BATCH}").alias("_first_live")
    out = with_computed(state.where(F.col("_first").isNotNull()).select(*cols, first), spec)
    if with_keys and spec.surrogate_key:
        out = dense_keys(out, ["_first_live", *keys], spec.surrogate_key)
    return out.select(*[c for c in spec.curated_columns if c in out.columns])
