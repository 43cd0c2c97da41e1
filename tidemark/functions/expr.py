"""Scalar expressions of the change model (all JVM-side, codegen friendly)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.spec import OP_DELETE, OP_INSERT, OP_UPDATE


def op_priority(op: Column | str = "op") -> Column:
    """Tie-break rank of an op code at equal capture time: D > U > I."""
    op = F.col(op) if isinstance(op, str) else op
    return (F.when(op == OP_DELETE, 3).when(op == OP_UPDATE, 2)
            .when(op == OP_INSERT, 1).otherwise(0))


def is_delete(op: Column | str = "op") -> Column:
    op = F.col(op) if isinstance(op, str) else op
    return op == OP_DELETE


def is_upsert(op: Column | str = "op") -> Column:
    """``op IN ('U', 'I')`` with SQL three-valued logic (NULL op -> NULL)."""
    op = F.col(op) if isinstance(op, str) else op
    return op.isin(OP_UPDATE, OP_INSERT)


def not_delete(op: Column | str = "op") -> Column:
    """``op != 'D'`` with SQL three-valued logic (NULL op -> NULL)."""
    op = F.col(op) if isinstance(op, str) else op
    return op != OP_DELETE


def full_name(first: Column | str = "first_name", last: Column | str = "last_name") -> Column:
    """``first || ' ' || last``; NULL when either part is NULL (never concat_ws)."""
    first = F.col(first) if isinstance(first, str) else first
    last = F.col(last) if isinstance(last, str) else last
    return F.concat(first, F.lit(" "), last)


def line_total(quantity: Column | str, unit_price: Column | str,
               discount_pct: Column | str, precision: int = 12) -> Column:
    """``quantity * unit_price * (1 - discount_pct / 100)`` as DECIMAL(p, 2).

    The percentage is scaled by the exact decimal 0.01 so that the result is
    the exact decimal product rounded HALF_UP once, at the final cast.
    """
    q = F.col(quantity) if isinstance(quantity, str) else quantity
    p = F.col(unit_price) if isinstance(unit_price, str) else unit_price
    d = F.col(discount_pct) if isinstance(discount_pct, str) else discount_pct
    hundredth = F.lit(0.01).cast("decimal(3,2)")
    return (q * p * (F.lit(1) - d * hundredth)).cast(f"decimal({precision},2)")


def days_before(date_col: Column | str, days: int) -> Column:
    """``CURRENT_DATE - n`` style date arithmetic on any date/timestamp column."""
    c = F.col(date_col) if isinstance(date_col, str) else date_col
    return F.date_sub(c.cast("date"), days)


def within_hours_before(ts: Column | str, end: _dt.datetime, hours: int = 24) -> Column:
    """``ts`` in ``[end - hours, end)`` -- the 24 h monitoring window.

    ``end`` is a literal so the predicate reaches the Parquet scan.
    """
    c = F.col(ts) if isinstance(ts, str) else ts
    start = end - _dt.timedelta(hours=hours)
    return (c >= F.lit(start)) & (c < F.lit(end))


def batch_time(base: _dt.datetime, batch: Column | str) -> Column:
    """Deterministic batch timestamp ``base + batch days`` (TIMESTAMP_NTZ)."""
    b = F.col(batch) if isinstance(batch, str) else batch
    return F.lit(base).cast("timestamp_ntz") + F.make_dt_interval(days=b.cast("int"))
