"""Quality checks (Q1-Q8): not-null, key, referential, domain, totals,
reconciliation, and the quarantine split that keeps poison rows out of a
merge.  Each check is one scan plus at most one shuffle on the checked key.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.latest import event_order
from tidemark.spec import OP_DELETE, OP_INSERT, OP_UPDATE, OPS, TableSpec


def reject_reason(df: DataFrame, spec: TableSpec, strict_reference: bool = False,
                  check_lengths: bool = True) -> Column:
    """Comma-joined reasons a change row cannot be merged, NULL when none.

    ``null_key`` (the curated key is NOT NULL), ``null_op`` (matches no merge
    clause), ``bad_op`` (an op outside I/U/D; with ``strict_reference`` it is
    let through, reproducing insert-if-unknown / ignore-if-known),
    ``null_required:<col>`` (NULL in a NOT NULL column of the curated table; a
    D needs no attributes) and ``too_long:<col>`` for text over its declared
    length.
    """
    op = F.col(spec.op_col)
    parts = [F.when(F.greatest(*[F.col(k).isNull() for k in spec.keys])
                    if len(spec.keys) > 1 else F.col(spec.keys[0]).isNull(),
                    F.lit("null_key")),
             F.when(op.isNull(), F.lit("null_op"))]
    if not strict_reference:
        parts.append(F.when(op.isNotNull() & ~op.isin(*OPS), F.lit("bad_op")))
    for c in spec.required:
        if c in df.columns:
            parts.append(F.when(op.isin(OP_INSERT, OP_UPDATE) & F.col(c).isNull(),
                                F.lit(f"null_required:{c}")))
    if check_lengths:
        for f in spec.fields:
            if f.max_len and f.name in df.columns:
                parts.append(F.when(F.char_length(F.col(f.name)) > f.max_len,
                                    F.lit(f"too_long:{f.name}")))
    if "_cast_errors" in df.columns:
        parts.append(F.when(F.col("_cast_errors") != "", F.col("_cast_errors")))
    joined = F.concat_ws(",", *parts)
    return F.when(joined != "", joined)


def split_valid(df: DataFrame, spec: TableSpec, strict_reference: bool = False,
                on_overflow: str = "quarantine") -> tuple[DataFrame, DataFrame]:
    """(good rows, bad rows with ``_reject_reason``) -- Q8 quarantine.

    ``on_overflow="truncate"`` cuts over-long text with ``left(x, n)`` instead
    of rejecting the row.
    """
    return split_tagged(tag_rejects(df, spec, strict_reference, on_overflow))


def tag_rejects(df: DataFrame, spec: TableSpec, strict_reference: bool = False,
                on_overflow: str = "quarantine") -> DataFrame:
    """``df`` plus ``_reject_reason`` (NULL for mergeable rows)."""
    if on_overflow == "truncate":
        df = df.withColumns({f.name: F.left(F.col(f.name), F.lit(f.max_len))
                             for f in spec.fields if f.max_len and f.name in df.columns})
    reason = reject_reason(df, spec, strict_reference, check_lengths=on_overflow != "truncate")
    return df.withColumn("_reject_reason", reason)


def split_tagged(tagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    good = tagged.where(F.col("_reject_reason").isNull()).drop("_reject_reason")
    bad = tagged.where(F.col("_reject_reason").isNotNull())
    if "_cast_errors" in good.columns:
        good = good.drop("_cast_errors")
    return good, bad


def not_null_report(df: DataFrame, columns: Sequence[str], table: str) -> DataFrame:
    """One row per checked column: (tbl, col, n_rows, n_null), one scan."""
    agg = df.agg(F.count(F.lit(1)).alias("n_rows"),
                 *[F.count_if(F.col(c).isNull()).alias(f"_n{i}")
                   for i, c in enumerate(columns)])
    rows = F.array(*[F.struct(F.lit(c).alias("col"), F.col(f"_n{i}").alias("n_null"))
                     for i, c in enumerate(columns)])
    return (agg.select(F.lit(table).alias("tbl"), "n_rows", F.inline(rows))
            .select("tbl", "col", "n_rows", "n_null"))


def not_null_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a NULL in any of ``columns`` (Q1, row level)."""
    cond = F.lit(False)
    for c in columns:
        cond = cond | F.col(c).isNull()
    return df.where(cond)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys occurring more than once, with their count (Q2)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 1))


def orphans(child: DataFrame, parent: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Child rows whose non-NULL foreign key has no parent.

    ``on`` maps child column -> parent column.  Parent keys are de-duplicated
    map-side before the anti join; the planner broadcasts them when small.
    """
    cond = F.lit(True)
    for c in on:
        cond = cond & F.col(c).isNotNull()
    pk = parent.select(*[F.col(p).alias(f"_p_{c}") for c, p in on.items()]).distinct()
    jcond = None
    for c in on:
        e = F.col(c) == F.col(f"_p_{c}")
        jcond = e if jcond is None else jcond & e
    return child.where(cond).join(pk, jcond, "left_anti")


def domain_violations(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    """Values outside ``allowed`` with counts; NULL is reported as its own row
    with ``is_null = TRUE`` (Q4)."""
    c = F.col(column)
    return (df.where(c.isNull() | ~c.isin(*allowed))
            .groupBy(c.alias("value")).agg(F.count(F.lit(1)).alias("n"))
            .select(F.lit(column).alias("col"), "value",
                    F.col("value").isNull().alias("is_null"), "n"))


def total_mismatch(parent: DataFrame, lines: DataFrame, key: str, parent_total: str,
                   line_amount: Column, precision: int = 18) -> DataFrame:
    """Parents whose stored total differs from the sum of their lines (Q7).

    Lines are summed per key (partial aggregate map-side) before the join, so
    the join sees one row per parent.  A parent without lines has sum 0; a
    stored total of NULL differs from every sum.
    """
    sums = lines.groupBy(key).agg(F.sum(line_amount).cast(f"decimal({precision},2)")
                                  .alias("line_sum"))
    return (parent.select(key, F.col(parent_total).cast(f"decimal({precision},2)")
                          .alias("stored_total"))
            .join(sums, key, "left")
            .withColumn("line_sum", F.coalesce("line_sum", F.lit(0).cast(f"decimal({precision},2)")))
            .where(~F.col("stored_total").eqNullSafe(F.col("line_sum"))))


def recomputed_mismatch(df: DataFrame, stored: str, recomputed: Column) -> DataFrame:
    """Rows whose stored derived value differs from its formula (Q6)."""
    return (df.withColumn("recomputed", recomputed)
            .where(~F.col(stored).eqNullSafe(F.col("recomputed"))))


def layer_counts(layers: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per layer, as ``(layer, n)`` rows (Q5, A1 + U1)."""
    out = None
    for name, df in layers.items():
        part = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("layer"), "n")
        out = part if out is None else out.unionByName(part)
    return out


def layer_totals(events: DataFrame, spec: TableSpec, batch_col: str) -> DataFrame:
    """(layer, n) of the layers that one log leads to: its events (``raw``), its
    keys (``latest``), and the live and deleted rows of the table it builds.

    One scan and one chain of aggregations with map-side combine, the ones of
    the replay without its columns, instead of a replay a layer.
    """
    order = F.struct(*[c.alias(f"_o{i}") for i, c in enumerate(event_order(spec))])
    op, b = F.col(spec.op_col), F.col(batch_col)
    batches = events.groupBy(*spec.keys, batch_col).agg(F.count(F.lit(1)).alias("_n"), F.max_by(op, order).alias("_op"))
    keys = batches.groupBy(*spec.keys).agg(
        F.sum("_n").alias("_n"), F.max(F.when(F.col("_op") != OP_DELETE, 1)).alias("_live"),
        F.max_by("_op", b).alias("_last"))
    there = F.col("_live").isNotNull()
    total = keys.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("raw"), F.count(F.lit(1)).alias("latest"),
        F.count_if(there & (F.col("_last") != OP_DELETE)).alias("live"),
        F.count_if(there & (F.col("_last") == OP_DELETE)).alias("deleted"))
    return total.unpivot([], ["raw", "latest", "live", "deleted"], "layer", "n")
