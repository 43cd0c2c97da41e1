"""Star-schema views over live rows."""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.spec import TableSpec


def live_rows(curated: DataFrame) -> DataFrame:
    """Rows not soft-deleted."""
    return curated.where(~F.col("is_deleted"))


def revenue_by_nation(lineitem: DataFrame, orders: DataFrame, customer: DataFrame,
                      nation: DataFrame, amount: Column) -> DataFrame:
    """Revenue per nation over lines -> orders -> customers -> nations.

    Aggregates are pushed below each join by hand (eager aggregation): lines
    are summed per order before meeting orders, orders per customer before
    meeting customers, customers per nation before meeting the 25-row nation
    table.  Each join therefore sees at most one row per key of its smaller
    side and each exchange carries partial aggregates, so a customer owning a
    third of all orders costs one partial row per map partition.  Only the
    nation table -- bounded by definition -- is broadcast.
    """
    per_order = lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")) \
        .agg(F.sum(amount).alias("rev"))
    per_cust = (orders.select("o_orderkey", "o_custkey").join(per_order, "o_orderkey")
                .groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.sum("rev").alias("rev")))
    per_nation = (customer.select("c_custkey", "c_nationkey").join(per_cust, "c_custkey")
                  .groupBy(F.col("c_nationkey").alias("n_nationkey"))
                  .agg(F.sum("rev").alias("rev")))
    return (F.broadcast(nation.select("n_nationkey", "n_name"))
            .join(per_nation, "n_nationkey")
            .select("n_name", F.col("rev").cast("decimal(18,2)").alias("revenue")))


def key_path(fact: str, column: str, tables: Mapping[str, DataFrame], specs: Mapping[str, TableSpec]
             ) -> list[tuple[str, str, str]]:
    """Shortest way along the specs' foreign keys from ``fact`` to a table with
    ``column``: (foreign key, parent table, parent's column) per step."""
    ways: list[tuple[str, list[tuple[str, str, str]]]] = [(fact, [])]
    seen = {fact}
    for name, way in ways:  # grows as it is read: breadth first
        if column in tables[name].columns:
            return way
        for fk, (parent, key) in specs[name].foreign_keys.items():
            if parent in tables and parent not in seen:
                seen.add(parent)
                ways.append((parent, way + [(fk, parent, key)]))
    raise ValueError(f"no table with {column!r} is reached from {fact!r} by foreign keys")


def total_by(fact: str, measure: Column, column: str, tables: Mapping[str, DataFrame],
             specs: Mapping[str, TableSpec], name: str = "total") -> DataFrame:
    """Sum of a fact's measure per value of a column of one of its dimensions,
    near or far (J4).  The joins are planned from the specs' foreign keys.

    The measure is summed below every join: lines per order before they meet
    orders, orders per customer before they meet customers.  So each join sees
    a row per key, each exchange carries partial sums, and a parent with a third
    of all facts is one row a task.  Facts without a (live) parent drop out.
    """
    way = key_path(fact, column, tables, specs)
    rows = tables[fact].select(*{fk for fk, *_ in way[:1]} or {column}, measure.alias(name))
    for i, (fk, parent, key) in enumerate(way):
        part = rows.where(F.col(fk).isNotNull()).groupBy(F.col(fk).alias(key)).agg(F.sum(name).alias(name))
        wanted = way[i + 1][0] if i + 1 < len(way) else column
        rows = (tables[parent].select(*dict.fromkeys([key, wanted])).join(part, key).select(wanted, name))
    return rows.groupBy(column).agg(F.sum(name).alias(name))
