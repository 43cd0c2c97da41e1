"""Queries on the three curated tables: ``dim_customers``, ``fact_orders``,
``fact_order_items``, under their own specs.

Each table's change log is derived from a whole test table by one list of
column expressions, written in SQL that Spark and DuckDB read alike; the
operators and the oracle share nothing else.  ``events`` carries the customers
(one batch per ten days), ``lineitem`` the orders and the items (one batch per
ship year; several events a key, ties on the ship date).
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.expr import batch_time, line_total
from tidemark.operators import capture, quality, reconcile
from tidemark.operators.constraints import constraint_report as report, foreign_key_report
from tidemark.operators.latest import latest_events
from tidemark.operators.marts import live_rows, total_by
from tidemark.operators.replay import replay_changes
from tidemark.operators.state import advance, curated
from tidemark.plans import views as V
from tidemark.plans.oracle import EV_SQL, IC_ATTRS, REPLAY_IC, SNAPSHOT_DIFF, snapshot_sql
from tidemark.session import checkpoint_dir, cut_lineage
from tidemark.sources.mixed import read_mixed
from tidemark.spec import CUSTOMERS, ORDER_ITEMS, ORDERS, SPECS, TableSpec

_DAYS = "CAST(floor((day(ts) - 1) / 10) AS INT)"
CUSTOMER_LOG = {
    "op": "CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' ELSE 'U' END",
    "_captured_at": "ts",
    "customer_id": "user_id",
    "first_name": "event_type",
    "last_name": "CASE WHEN event_id % 5 = 0 THEN NULL ELSE 'N' || CAST(event_id % 50 AS STRING) END",
    "email": "'u' || CAST(user_id % 97 AS STRING) || '@example.org'",
    "phone": "CASE WHEN event_id % 11 = 0 THEN '+1 555 0100 0100 0100' ELSE '555-' || CAST(event_id % 100 AS STRING) END",
    "address_line1": "CAST(event_id AS STRING) || ' Main Street'",
    "address_line2": "CAST(NULL AS STRING)",
    "city": "substr(props, 1, 20)",
    "state": "CASE user_id % 3 WHEN 0 THEN 'NY' WHEN 1 THEN 'CA' ELSE 'TX' END",
    "postal_code": "CAST(user_id AS STRING)",
    "country": "'US'",
    "customer_status": "CASE event_type WHEN 'view' THEN 'CLOSED' WHEN 'click' THEN 'INACTIVE' ELSE 'ACTIVE' END",
    "src_created_at": "ts", "src_updated_at": "ts",
    "_source_file": "'events'", "_source_file_row": "event_id", "b": _DAYS,
}
_LINE = {
    "op": "CASE l_returnflag WHEN 'A' THEN 'I' WHEN 'N' THEN 'U' ELSE 'D' END",
    "_captured_at": "l_shipdate",
    "src_created_at": "l_shipdate",
    # every value of the line, so that only equal events tie
    "_source_file": " || '/' || ".join(f"CAST({c} AS STRING)" for c in (
        "l_partkey", "l_suppkey", "CAST(l_extendedprice AS DECIMAL(12,2))", "CAST(l_tax * 100 AS DECIMAL(5,2))",
        "CAST(l_discount * 100 AS DECIMAL(5,2))", "CAST(l_quantity AS DECIMAL(10,0))")),
    "_source_file_row": "CAST(l_linenumber AS BIGINT)",
    "b": "CAST(year(l_shipdate) AS INT)",
}
ORDER_LOG = {
    **_LINE,
    "order_id": "l_orderkey",
    "customer_id": "l_suppkey * 2",
    "order_date": "CAST(l_shipdate AS DATE)",
    "ship_date": "CASE WHEN l_linenumber = 1 THEN NULL ELSE CAST(l_shipdate AS DATE) END",
    "order_status": "CASE l_linestatus WHEN 'O' THEN 'PENDING' ELSE 'DELIVERED' END",
    "total_amount": "CAST(l_extendedprice AS DECIMAL(12,2))",
    "currency": "'USD'",
    "shipping_method": "l_returnflag",
    "notes": "CASE WHEN l_linenumber % 2 = 0 THEN 'n' || CAST(l_linenumber AS STRING) END",
    "src_updated_at": "l_shipdate",
}
ITEM_LOG = {
    **_LINE,
    "item_id": "l_orderkey * 10 + l_linenumber",
    "order_id": "l_orderkey",
    "product_id": "l_partkey",
    "product_name": "'P' || CAST(l_partkey AS STRING)",
    "quantity": "CAST(l_quantity AS BIGINT)",
    "unit_price": "CAST(l_extendedprice AS DECIMAL(10,2))",
    "discount_pct": "CAST(l_discount * 100 AS DECIMAL(5,2))",
    "line_total": "CAST(l_extendedprice AS DECIMAL(12,2))",
}
LOGS = {"customers": ("events", CUSTOMER_LOG), "orders": ("lineitem", ORDER_LOG), "order_items": ("lineitem", ITEM_LOG)}


def change_log(spark, d, spec: TableSpec) -> DataFrame:
    """The table's change log under curated names, with batch ``b`` and its time."""
    source, columns = LOGS[spec.name]
    log = V.table(spark, d, source).selectExpr(*[f"{e} AS `{c}`" for c, e in columns.items()])
    return log.withColumn("_bts", batch_time(V.BATCH_BASE, "b"))


# -- J1 under the real specs, P8 ----------------------------------------------
def _merged(spark, d, spec):
    from tidemark.plans.catalog import merge_batches
    return merge_batches(change_log(spark, d, spec), spec)


def merge_dim_customers(spark, d):
    return _merged(spark, d, CUSTOMERS)


def merge_fact_orders(spark, d):
    return _merged(spark, d, ORDERS)


def merge_fact_order_items(spark, d):
    return _merged(spark, d, ORDER_ITEMS)


def replayed(spark, d, spec) -> DataFrame:
    return replay_changes(change_log(spark, d, spec), spec, "b", "_bts", dense=True)


def replay_dim_customers(spark, d):
    return replayed(spark, d, CUSTOMERS)


# -- J2 kept between batches --------------------------------------------------
def replay_incremental(spark, d):
    """``replay_items`` from a state that was written after the batches before
    1995 and then advanced twice, by two and by all remaining batches."""
    log = V.ic(spark, d).withColumn("src_created_at", F.col("ts"))
    state = None
    for part in ("b < 1995", "b in (1995, 1996)", "b > 1996"):
        state = cut_lineage(advance(state, log.where(part), V.IC_SPEC, "b", "_bts"), "state")
    return curated(state, V.IC_SPEC)


# -- S1 / P2: files of different physical types ---------------------------------
CAST_SHAPES = {  # rest of the order key by 4 -> what the file holds as total_amount
    0: "CAST(o_totalprice AS DECIMAL(12,2))",
    1: "o_totalprice",
    2: "CAST(floor(o_totalprice) AS BIGINT)",
    3: "CASE WHEN o_orderstatus = 'P' THEN 'n/a' ELSE CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS STRING) END",
}


def cast_changes(spark, d):
    """All of ``orders``, landed as change files whose amounts lie as DECIMAL,
    DOUBLE, BIGINT and STRING (``n/a`` where the order is open), read back as
    typed rows with the reasons of what did not fit."""
    land = f"{checkpoint_dir(spark).rstrip('/')}/tidemark-landing-{uuid.uuid4().hex}"
    o = V.table(spark, d, "orders")
    for rest, amount in CAST_SHAPES.items():
        (o.where(f"o_orderkey % {len(CAST_SHAPES)} = {rest}")
         .selectExpr("'I' AS Op", "o_orderdate AS _timestamp", "o_orderkey AS order_id", "o_custkey AS CUSTOMER_ID",
                     f"{amount} AS total_amount", "o_orderpriority AS unknown_to_the_spec")
         .write.parquet(f"{land}/type={rest}"))
    return (read_mixed(spark, land, ORDERS)
            .select("op", "_captured_at", "order_id", "customer_id", "total_amount",
                    F.col("_cast_errors").alias("cast_errors")))


# -- Q1 / Q2 / Q3 / Q4 from the specs ------------------------------------------
def constraint_report(spark, d):
    """Every rule of the three specs on the latest events of their logs."""
    tables = {s.name: latest_events(change_log(spark, d, s), s, method="agg").drop("_bts", "b") for s in SPECS.values()}
    out = None
    for name, spec in SPECS.items():
        part = report(tables[name], spec)
        out = part if out is None else out.unionAll(part)
    return out.unionAll(foreign_key_report(tables, SPECS))


# -- Q6 / Q7 on data where some rows break them --------------------------------
def line_total_check(spark, d):
    """Lines whose stored total is not the recomputed one: stored without the
    discount where the tax is over 5 %, and not stored at all where it is 0."""
    i = V.ic(spark, d).withColumn("line_total", F.expr(
        "CASE WHEN tax > 5 THEN CAST(q * price AS DECIMAL(12,2)) WHEN tax > 0 THEN "
        "CAST(q * price * (1 - disc * CAST(0.01 AS DECIMAL(3,2))) AS DECIMAL(12,2)) END"))
    bad = quality.recomputed_mismatch(i, "line_total", line_total("q", "price", "disc"))
    return bad.select("k1", "k2", "ts", "pk", "sk", "line_total", "recomputed")


def order_total_check(spark, d):
    """Orders whose stored total is not the sum of their lines: it was stored
    before the returned lines came, and not at all for open orders."""
    li = V.table(spark, d, "lineitem")
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    before = li.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum(F.when(F.col("l_returnflag") != "R", price).otherwise(0)).alias("early"))
    o = (V.table(spark, d, "orders").select("o_orderkey", "o_orderstatus").join(before, "o_orderkey", "left")
         .select("o_orderkey", F.when(F.col("o_orderstatus") != "P", F.coalesce("early", F.lit(0))).alias("stored")))
    lines = li.select(F.col("l_orderkey").alias("o_orderkey"), "l_extendedprice")
    return quality.total_mismatch(o, lines, "o_orderkey", "stored", price)


# -- S8: a load that overlaps the changes --------------------------------------
LOG_STARTS, CHUNKS = _dt.datetime(2024, 1, 8), 8


def cut_over_load(spark, d):
    """Users loaded in eight chunks, each read over two days while changes go on
    (every key at another moment of its chunk's window); the log begins with the
    first chunk.  Returns the live rows after load and log, latest event first."""
    log = V.ev(spark, d).drop("b", "_bts")
    day = lambda c: F.lit(LOG_STARTS).cast("timestamp_ntz") + F.make_dt_interval(days=c)
    chunk = f"CAST(pmod(k, {CHUNKS}) AS INT)"
    read_at = day(F.expr(chunk) + F.pmod("k", F.lit(3)).cast("int"))
    seen = latest_events(log.where(F.col("ts") <= read_at), V.EV_SPEC, method="agg").where("op <> 'D'")
    load = seen.drop("op", "ts").withColumn("seq", F.lit(-1).cast("bigint"))
    marks = spark.range(CHUNKS).select(F.col("id").cast("int").alias("_chunk"), day(F.col("id")).alias("_low"),
                                       day(F.col("id") + 2).alias("_high"))
    whole = capture.cut_over(load, log.where(F.col("ts") >= F.lit(LOG_STARTS)), marks, chunk, V.EV_SPEC)
    return latest_events(whole, V.EV_SPEC, method="agg").where("op <> 'D'").select("k", "status", "amount")


# -- T1 / F6 and Q5 / J5: between two states of the items ------------------------
def _states(spark, d):
    from tidemark.plans.catalog import SNAPSHOT_CUTOFF
    log = V.ic(spark, d)
    return (capture.snapshot_as_of(log, V.IC_SPEC, cutoff) for cutoff in (SNAPSHOT_CUTOFF, None))


def item_feed(spark, d):
    """Pre- and post-images that lead from the state of 1998-07-01 to the last."""
    return capture.change_feed(*_states(spark, d), ["k1", "k2"], IC_ATTRS)


def inserted_items(spark, d):
    """The feed's inserts that are no updates (the action filter)."""
    return item_feed(spark, d).where("action = 'INSERT' and not is_update").drop("action", "is_update")


def reconcile_items(spark, d):
    """``snapshot_diff`` by checksums of hash ranges.

    A state is a fold of the log that the levels and the final join each read,
    so it is written once as the layer it stands for."""
    from tidemark.plans.catalog import DIFF_CAPTURED_AT
    layers = [cut_lineage(s.select("k1", "k2", *IC_ATTRS), "layer") for s in _states(spark, d)]
    return reconcile.reconcile(*layers, ["k1", "k2"], IC_ATTRS, DIFF_CAPTURED_AT)


def live_fact_orders(spark, d):
    """Live orders of live customers (F5, J3): soft-deleted ones are no parents."""
    orders, customers = live_rows(replayed(spark, d, ORDERS)), live_rows(replayed(spark, d, CUSTOMERS))
    return orders.join(customers.select("customer_id"), "customer_id", "left_semi")


def live_revenue(spark, d):
    """Line totals of live items of live orders of live customers, per state."""
    wanted = {"order_items": ("order_id", "line_total"), "orders": ("customer_id",), "customers": ("state",)}
    tables = {s.name: live_rows(replay_changes(change_log(spark, d, s), s, "b", "_bts", with_keys=False,
                                               columns=wanted[s.name])) for s in SPECS.values()}
    out = total_by("order_items", F.col("line_total"), "state", tables, SPECS, "revenue")
    return out.withColumn("revenue", F.col("revenue").cast("decimal(18,2)"))


QUERIES = {f.__name__: f for f in (
    merge_dim_customers, merge_fact_orders, merge_fact_order_items, replay_dim_customers, replay_incremental,
    cast_changes, constraint_report, line_total_check, order_total_check, live_fact_orders, cut_over_load,
    item_feed, inserted_items, reconcile_items, live_revenue)}


# -- oracle ---------------------------------------------------------------------
def _view(spec: TableSpec) -> str:
    source, columns = LOGS[spec.name]
    cells = ", ".join(f"{e} AS {c}" for c, e in columns.items())
    return f"SELECT *, TIMESTAMP '2024-02-01 00:00:00' + to_days(b) AS _bts FROM (SELECT {cells} FROM {source}) s"


ORDER = f"_captured_at DESC NULLS LAST, {V.PRIORITY_SQL} DESC, _source_file DESC, _source_file_row DESC"


def final_table(spec: TableSpec) -> str:
    """The curated table after all batches: per key and batch the last event;
    batches from the first that is no delete on; keys numbered by that batch."""
    k = ", ".join(spec.keys)
    cells = [f"arg_max({{'x': {c}}}, b) FILTER (WHERE op <> 'D')['x'] AS {c}" for c in spec.update_columns]
    cells += [f"arg_min({{'x': {c}}}, b)['x'] AS {c}" for c in spec.insert_only]
    if spec.has_first_seen:
        cells.append("min(_bts) AS dw_first_seen_at")
    cells += ["max(_bts) AS dw_last_updated_at", "arg_max(op, b) = 'D' AS is_deleted", "min(b) AS fb"]
    computed = "".join(f", {e} AS {c}" for c, e in spec.computed.items())
    return f"""SELECT * EXCLUDE (fb), row_number() OVER (ORDER BY fb, {k}) AS {spec.surrogate_key}{computed} FROM (
  SELECT {k}, {', '.join(cells)} FROM (
    SELECT *, min(CASE WHEN op <> 'D' THEN b END) OVER (PARTITION BY {k}) AS first_b FROM (
      SELECT *, row_number() OVER (PARTITION BY {k}, b ORDER BY {ORDER}) AS rn FROM ({_view(spec)}) v) w WHERE rn = 1
  ) x WHERE b >= first_b GROUP BY {k}) y"""


def _latest(spec: TableSpec) -> str:
    return f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {', '.join(spec.keys)} ORDER BY {ORDER}) AS rn
  FROM ({_view(spec)}) v) w WHERE rn = 1"""


def _rule(spec: TableSpec, rule: str, col: str, bad: str) -> str:
    return (f"SELECT '{spec.curated_name}' AS tbl, '{rule}' AS rule, '{col}' AS col, count(*) AS n_rows, "
            f"{bad} AS n_bad FROM ({_latest(spec)}) t")


def _constraints() -> str:
    parts = []
    for spec in SPECS.values():
        for c in dict.fromkeys([*spec.keys, *spec.required, *[f.name for f in spec.fields if not f.nullable]]):
            parts.append(_rule(spec, "not_null", c, f"count(*) FILTER (WHERE {c} IS NULL)"))
        for source, allowed in spec.domains.items():
            c = spec.curated(source)
            listed = ", ".join(f"'{a}'" for a in allowed)
            parts.append(_rule(spec, "domain", c, f"count(*) FILTER (WHERE {c} NOT IN ({listed}))"))
        for f in spec.fields:
            if f.max_len:
                c = spec.curated(f.name)
                parts.append(_rule(spec, "too_long", c, f"count(*) FILTER (WHERE length({c}) > {f.max_len})"))
        for cols in dict.fromkeys([spec.keys, *spec.unique]):
            c = ", ".join(cols)
            parts.append(_rule(spec, "unique", ",".join(cols), f"count({c}) - count(DISTINCT {c})"))
        for col, (parent, key) in spec.foreign_keys.items():
            parts.append(_rule(spec, "foreign_key", col, f"count(*) FILTER (WHERE {col} IS NOT NULL AND NOT EXISTS "
                               f"(SELECT 1 FROM ({_latest(SPECS[parent])}) p WHERE p.{key} = t.{col}))"))
    return "\nUNION ALL\n".join(parts)


def _feed() -> str:
    attrs = ", ".join(IC_ATTRS)
    before, after = (f"SELECT k1, k2, {attrs} FROM ({snapshot_sql(t)}) s" for t in ("1998-07-01 00:00:00", None))
    changed = f"SELECT k1, k2 FROM ({SNAPSHOT_DIFF}) d WHERE op = 'U'"
    return f"""WITH p AS ({before}), c AS ({after}), u AS ({changed})
SELECT 'DELETE' AS action, (k1, k2) IN (SELECT (k1, k2) FROM u) AS is_update, * FROM (SELECT * FROM p EXCEPT SELECT * FROM c) x
UNION ALL
SELECT 'INSERT' AS action, (k1, k2) IN (SELECT (k1, k2) FROM u) AS is_update, * FROM (SELECT * FROM c EXCEPT SELECT * FROM p) y"""


ORACLE = {
    "cut_over_load": f"""SELECT k, status, amount FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY {V.EO}) AS rn
  FROM ({EV_SQL}) e) w WHERE rn = 1 AND op <> 'D'""",
    "item_feed": _feed(),
    "inserted_items": f"""SELECT k1, k2, {', '.join(IC_ATTRS)} FROM ({SNAPSHOT_DIFF}) d WHERE op = 'I'""",
    "reconcile_items": SNAPSHOT_DIFF,
    "merge_dim_customers": final_table(CUSTOMERS),
    "merge_fact_orders": final_table(ORDERS),
    "merge_fact_order_items": final_table(ORDER_ITEMS),
    "replay_dim_customers": final_table(CUSTOMERS),
    "replay_incremental": REPLAY_IC,
    "cast_changes": """SELECT 'I' AS op, o_orderdate AS _captured_at, o_orderkey AS order_id, o_custkey AS customer_id,
  CASE o_orderkey % 4 WHEN 2 THEN CAST(floor(o_totalprice) AS DECIMAL(12,2))
    WHEN 3 THEN CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_totalprice AS DECIMAL(12,2)) END
    ELSE CAST(o_totalprice AS DECIMAL(12,2)) END AS total_amount,
  CASE WHEN o_orderkey % 4 = 3 AND o_orderstatus = 'P' THEN 'bad_cast:total_amount' ELSE '' END AS cast_errors
FROM orders""",
    "constraint_report": _constraints(),
    "line_total_check": f"""SELECT k1, k2, ts, pk, sk, line_total, recomputed FROM (
  SELECT *, CASE WHEN tax > 5 THEN CAST(q * price AS DECIMAL(12,2)) WHEN tax > 0 THEN recomputed END AS line_total FROM (
    SELECT *, CAST(q * price * (1 - disc * CAST(0.01 AS DECIMAL(3,2))) AS DECIMAL(12,2)) AS recomputed FROM ({V.IC_SQL}) i) j) k
WHERE line_total IS DISTINCT FROM recomputed""",
    "order_total_check": """SELECT o_orderkey, CAST(stored AS DECIMAL(18,2)) AS stored_total, CAST(line_sum AS DECIMAL(18,2)) AS line_sum
FROM (SELECT o.o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN coalesce(sum(CAST(l_extendedprice AS DECIMAL(12,2)))
             FILTER (WHERE l_returnflag <> 'R'), 0) END AS stored,
             coalesce(sum(CAST(l_extendedprice AS DECIMAL(12,2))), 0) AS line_sum
      FROM orders o LEFT JOIN lineitem l ON l_orderkey = o_orderkey GROUP BY o.o_orderkey, o_orderstatus) t
WHERE stored IS DISTINCT FROM line_sum""",
    "live_revenue": f"""SELECT c.state, CAST(sum(i.line_total) AS DECIMAL(18,2)) AS revenue
FROM ({final_table(ORDER_ITEMS)}) i JOIN ({final_table(ORDERS)}) o ON i.order_id = o.order_id AND NOT o.is_deleted
  JOIN ({final_table(CUSTOMERS)}) c ON o.customer_id = c.customer_id AND NOT c.is_deleted
WHERE NOT i.is_deleted GROUP BY c.state""",
    "live_fact_orders": f"""SELECT * FROM ({final_table(ORDERS)}) o WHERE NOT is_deleted AND customer_id IN (
  SELECT customer_id FROM ({final_table(CUSTOMERS)}) c WHERE NOT is_deleted)""",
}
