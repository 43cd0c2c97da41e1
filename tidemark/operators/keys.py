"""Surrogate keys (P8) and computed columns (P5/P6) of curated tables."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import cut_lineage
from tidemark.spec import TableSpec


def assign_keys(rows: DataFrame, keys: Sequence[str], name: str,
                key_base: Column | int = 0, slots: int | None = None) -> DataFrame:
    """Number new rows with unique, stable surrogate keys above ``key_base``.

    Rows are spread over ``slots`` hash slots of the natural key; inside a
    slot they are numbered in natural-key order, and slot ``s`` takes the
    values ``base + s + 1, base + s + 1 + slots, ...``.  So numbering needs no
    global sort and no single task: each slot is one window partition, and
    the result depends only on the set of keys.  Values are unique but not
    gap-free (an autoincrement column promises no more).
    """
    spark = rows.sparkSession
    if slots is None:
        slots = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    base = key_base if isinstance(key_base, Column) else F.lit(int(key_base))
    slot = F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(slots))
    w = Window.partitionBy("_slot").orderBy(*[F.col(k) for k in keys])
    return (rows.withColumn("_slot", slot)
            .withColumn("_rn", F.row_number().over(w))
            .withColumn(name, (base.cast("bigint") + (F.col("_rn") - 1) * slots
                               + F.col("_slot") + 1).cast("bigint"))
            .drop("_slot", "_rn"))


def dense_keys(rows: DataFrame, order: Sequence[str], name: str, base: int = 0) -> DataFrame:
    """Gap-free surrogate keys ``base + 1, base + 2, ...`` in the order of the
    columns ``order``, which must be unique.

    Two passes and no single task: the rows are ranged and sorted by ``order``
    and written with their place in their partition; the partitions' row counts
    (a row a partition) are prefix-summed into offsets and broadcast.  The
    result depends on the rows alone, not on the number of partitions or any
    setting: a stream that numbers each batch's new rows by key and a replay
    that numbers all rows by (first batch, key) give the same keys.
    """
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    at = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = cut_lineage(ranged.select("*", F.spark_partition_id().alias("_part"), at.alias("_at")), "keys")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (placed.groupBy("_part").agg(F.count(F.lit(1)).alias("n"))
               .select("_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before")))
    return (placed.join(F.broadcast(offsets), "_part")
            .withColumn(name, (F.lit(int(base) + 1).cast("bigint") + F.col("_before") + F.col("_at")).cast("bigint"))
            .drop("_part", "_at", "_before"))


def with_computed(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Add (or refresh) the computed columns of ``spec`` from stored columns."""
    if not spec.computed:
        return df
    return df.withColumns({n: F.expr(sql) for n, sql in spec.computed.items()})
