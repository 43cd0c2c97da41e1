"""Constraints of a table, compiled from its spec into one scan (Q1, Q2, Q4).

The rules come from the spec: NOT NULL of keys, required and non-nullable
columns, value domains, text lengths, and uniqueness of the key and of every
``unique`` column list.  A row is expanded into one row for all row-wise rules
and one per uniqueness rule; a single aggregation by (rule, key) counts both the
violations and the keys, combining map-side, and a second, small one folds the
keys.  So a table is read once and shuffled once whatever the number of rules,
and a value that a third of the rows share is one row a task.

Foreign keys need the other table: one anti join of the child's distinct keys.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.spec import TableSpec

REPORT = "tbl string, rule string, col string, n_rows bigint, n_bad bigint"


@dataclass(frozen=True)
class RowRule:
    """A rule that one row breaks on its own."""

    kind: str
    column: str
    broken: Column


@dataclass(frozen=True)
class UniqueRule:
    columns: tuple[str, ...]


def compile_rules(spec: TableSpec, columns: list[str]) -> tuple[list[RowRule], list[UniqueRule]]:
    """The rules of ``spec`` on a table with ``columns`` (source or curated
    names); a rule about a column that the table lacks is left out."""
    def named(source: str) -> str | None:
        return next((c for c in (source, spec.curated(source)) if c in columns), None)

    rows: list[RowRule] = []
    must = list(dict.fromkeys([*spec.keys, *spec.required, *[f.name for f in spec.fields if not f.nullable]]))
    for c in filter(None, map(named, must)):
        rows.append(RowRule("not_null", c, F.col(c).isNull()))
    for source, allowed in spec.domains.items():
        if c := named(source):  # NULL is no value of a CHECK constraint's complaint
            rows.append(RowRule("domain", c, F.col(c).isNotNull() & ~F.col(c).isin(*allowed)))
    for f in spec.fields:
        if f.max_len and (c := named(f.name)):
            rows.append(RowRule("too_long", c, F.char_length(c) > f.max_len))
    unique = []
    for cols in dict.fromkeys([tuple(spec.keys), *spec.unique]):
        found = tuple(named(c) or "" for c in cols)
        if all(found) and UniqueRule(found) not in unique:
            unique.append(UniqueRule(found))
    return rows, unique


def constraint_report(df: DataFrame, spec: TableSpec) -> DataFrame:
    """(tbl, rule, col, n_rows, n_bad) per rule of ``spec``, rules without a
    violation too.  For uniqueness ``n_bad`` counts the rows beyond the first of
    each value; rows with a NULL in the columns are not compared, as in SQL."""
    rows, unique = compile_rules(spec, df.columns)
    flags = [F.when(r.broken, 1).otherwise(0).cast("bigint") for r in rows]
    none = F.lit(None).cast("string")
    expanded = [F.struct(F.lit(-1).alias("rule"), none.alias("key"),
                         *[x.alias(f"f{i}") for i, x in enumerate(flags)])]
    for k, u in enumerate(unique):
        key = F.when(~F.greatest(*[F.col(c).isNull() for c in u.columns], F.lit(False)),
                     F.to_json(F.struct(*[F.col(c).cast("string").alias(f"c{i}") for i, c in enumerate(u.columns)])))
        expanded.append(F.struct(F.lit(k).alias("rule"), key.alias("key"),
                                 *[F.lit(0).cast("bigint").alias(f"f{i}") for i in range(len(rows))]))
    each = df.select(F.explode(F.array(*expanded)).alias("e")).select("e.*").where("rule < 0 or key is not null")
    by_key = each.groupBy("rule", "key").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(f"f{i}").alias(f"f{i}") for i in range(len(rows))])
    # One row again: every rule's count, and the table's rows.
    total = by_key.agg(
        F.coalesce(F.sum(F.when(F.col("rule") < 0, F.col("n"))), F.lit(0)).alias("n_rows"),
        *[F.coalesce(F.sum(f"f{i}"), F.lit(0)).alias(f"b{i}") for i in range(len(rows))],
        *[F.coalesce(F.sum(F.when(F.col("rule") == k, F.col("n") - 1)), F.lit(0)).alias(f"u{k}")
          for k in range(len(unique))])
    name = spec.curated_name or spec.name
    entries = [F.struct(F.lit(r.kind).alias("rule"), F.lit(r.column).alias("col"), F.col(f"b{i}").alias("n_bad"))
               for i, r in enumerate(rows)]
    entries += [F.struct(F.lit("unique").alias("rule"), F.lit(",".join(u.columns)).alias("col"), F.col(f"u{k}").alias("n_bad"))
                for k, u in enumerate(unique)]
    return (total.select("n_rows", F.explode(F.array(*entries)).alias("e"))
            .select(F.lit(name).alias("tbl"), "e.rule", "e.col", "n_rows", "e.n_bad"))


def foreign_key_report(tables: Mapping[str, DataFrame], specs: Mapping[str, TableSpec]) -> DataFrame:
    """The same columns for every foreign key between the given tables: rows
    whose key is not NULL and has no parent.  The child's keys are counted per
    value first, so the anti join sees each value once."""
    out = None
    for name, spec in specs.items():
        for col, (parent, parent_key) in spec.foreign_keys.items():
            if name not in tables or parent not in tables:
                continue
            child = tables[name].groupBy(F.col(col).alias("_k")).agg(F.count(F.lit(1)).alias("n"))
            keys = tables[parent].select(F.col(parent_key).alias("_k")).where("_k is not null").distinct()
            lost = F.col("_found").isNull() & F.col("_k").isNotNull()
            part = (child.join(keys.withColumn("_found", F.lit(True)), "_k", "left")
                    .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
                         F.coalesce(F.sum(F.when(lost, F.col("n"))), F.lit(0)).alias("n_bad"))
                    .select(F.lit(spec.curated_name or name).alias("tbl"), F.lit("foreign_key").alias("rule"),
                            F.lit(col).alias("col"), "n_rows", "n_bad"))
            out = part if out is None else out.unionAll(part)
    return out
