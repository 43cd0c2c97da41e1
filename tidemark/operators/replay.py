"""Closed-form replay (J2): the curated table from the whole RAW log.

Equal to applying :func:`tidemark.operators.merge.merge_changes` batch by
batch, in one job.  Input rows must be quarantined first (op in I/U/D, key
not NULL).  Batch ids order the batches; ``batch_ts_col`` is the time each
batch was merged (monotone in the batch id).

Plan: two hash aggregations.  The first keeps the latest event per
``(key, batch)`` -- the per-batch de-duplication of the reference -- and the
second folds the batches of a key:

* attributes come from the last batch whose latest event is not a delete,
* insert-only columns from the first such batch (a delete before the first
  insert is ignored, a delete of an unknown key leaves no row),
* ``is_deleted`` is the op of the last batch being ``D``,
* ``dw_first_seen_at`` / ``dw_last_updated_at`` the first / last batch times.

Both aggregations combine map-side, so a hot key costs one row per map
partition in each exchange.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.keys import assign_keys, dense_keys, with_computed
from tidemark.operators.latest import latest_events
from tidemark.spec import OP_DELETE, TableSpec


def replay_changes(events: DataFrame, spec: TableSpec, batch_col: str,
                   batch_ts_col: str | None = None, with_keys: bool = True,
                   dense: bool = False, columns: Sequence[str] | None = None) -> DataFrame:
    """The curated table.  ``dense`` gives the surrogate keys that batch-wise
    merges with ``dense`` give: gap-free, by first batch and key.  ``columns``
    names the event columns that are wanted: no other value of an event but its
    order enters an exchange, and computed columns are left out."""
    keys = list(spec.keys)
    op = spec.op_col
    batch_ts_col = batch_ts_col or batch_col
    upd = [c for c in spec.update_columns if c not in keys and (columns is None or c in columns)]
    ins = [c for c in spec.insert_only if c not in keys and c not in upd and (columns is None or c in columns)]

    needed = list(dict.fromkeys(
        keys + [op, spec.ts_col, *spec.tiebreak, batch_col, batch_ts_col] + upd + ins))
    per_batch = latest_events(events.select(*needed), spec, method="agg",
                              extra_keys=[batch_col])

    live = F.col(op) != F.lit(OP_DELETE)
    live_b = F.when(live, F.col(batch_col))
    aggs = [
        F.min(live_b).alias("_first_live"),
        *([F.max_by(F.when(live, F.struct(*upd)), live_b).alias("_upd")] if upd else []),
        F.min_by(F.when(live, F.struct(*ins, F.col(batch_ts_col).alias("_bts"))),
                 live_b).alias("_ins"),
        F.max_by(F.struct(F.col(op).alias("_op"), F.col(batch_ts_col).alias("_bts")),
                 F.col(batch_col)).alias("_last"),
    ]
    folded = per_batch.groupBy(*keys).agg(*aggs).where(F.col("_first_live").isNotNull())

    cols = [F.col(k) for k in keys]
    for c in spec.event_columns:
        if c in upd or c in ins:
            cols.append((F.col("_upd")[c] if c in upd else F.col("_ins")[c]).alias(c))
    if spec.has_first_seen:
        cols.append(F.col("_ins._bts").alias("dw_first_seen_at"))
    cols.append(F.col("_last._bts").alias("dw_last_updated_at"))
    cols.append((F.col("_last._op") == F.lit(OP_DELETE)).alias("is_deleted"))
    out = folded.select(*cols, "_first_live")
    if columns is None:
        out = with_computed(out, spec)
    if with_keys and spec.surrogate_key and dense:
        out = dense_keys(out, ["_first_live", *keys], spec.surrogate_key)
    elif with_keys and spec.surrogate_key:
        out = assign_keys(out, keys, spec.surrogate_key, key_base=F.lit(0))
    return out.select(*[c for c in spec.curated_columns
                        if c in out.columns])
