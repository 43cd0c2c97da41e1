"""Reconciliation of two layers by checksums of hash ranges.

Two states of a table that should be equal mostly are.  So the rows of both are
summed into order-free digests per range of the key's hash -- one map-side
aggregate a side, a few numbers a range in the exchange.  Only ranges whose
digests differ are summed again in finer ranges, and only rows of the finest
ranges that differ reach the join that finds the changes.  Equal layers cost one
aggregate; a few changed rows cost a second look at the rows beside them.

A digest is the number of rows, the exact sum of a 64-bit hash of each row and
the exclusive or of another, so a difference is overlooked with a chance of about
2^-128 a range.
"""

from __future__ import annotations

import datetime as _dt
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.capture import snapshot_diff
from tidemark.session import cut_lineage

#: Bits of the key's hash that name a range, level by level.
LEVELS = (10, 18)


def key_range(keys: Sequence[str], bits: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*[F.col(k) for k in keys]), 64 - bits)


def range_digests(df: DataFrame, keys: Sequence[str], columns: Sequence[str], bits: int) -> DataFrame:
    """(range, n, total, mixed) of the rows by the hash of their key."""
    # Nulls are skipped by the hash, so each column's null goes in as a flag.
    cells = [x for c in [*keys, *columns] for x in (F.col(c), F.col(c).isNull())]
    return df.groupBy(key_range(keys, bits).alias("range")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*cells).cast("decimal(38,0)")).alias("total"),
        F.bit_xor(F.xxhash64(F.lit(7), *cells)).alias("mixed"))


def differing_ranges(left: DataFrame, right: DataFrame, keys: Sequence[str], columns: Sequence[str],
                     bits: int) -> DataFrame:
    """Ranges in which the two tables differ; at most 2^bits rows."""
    names = ("n", "total", "mixed")
    a, b = (range_digests(df, keys, columns, bits).select("range", F.struct(*names).alias(x))
            for df, x in ((left, "a"), (right, "b")))
    return a.join(b, "range", "full_outer").where(~F.col("a").eqNullSafe(F.col("b"))).select("range")


def only_ranges(df: DataFrame, ranges: DataFrame, keys: Sequence[str], bits: int) -> DataFrame:
    """Rows of the given ranges.  The ranges are a bounded list (2^bits names of
    eight bytes), so they are broadcast and the rows stay where they are."""
    return (df.withColumn("_range", key_range(keys, bits))
            .join(F.broadcast(ranges.withColumnRenamed("range", "_range")), "_range", "left_semi").drop("_range"))


def reconcile(prev: DataFrame, curr: DataFrame, keys: Sequence[str], columns: Sequence[str],
              captured_at: _dt.datetime | Column, levels: Sequence[int] = LEVELS) -> DataFrame:
    """The changes of :func:`snapshot_diff`, found by drilling into ranges."""
    for bits in levels:
        ranges = cut_lineage(differing_ranges(prev, curr, keys, columns, bits), "ranges")
        prev, curr = (only_ranges(df, ranges, keys, bits) for df in (prev, curr))
    return snapshot_diff(prev, curr, keys, columns, captured_at)
