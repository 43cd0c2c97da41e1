"""Oracle SQL (DuckDB dialect) for the registered queries.

Written independently of the Spark code path: de-duplication is the
``ROW_NUMBER() ... = 1`` form, replay and batch-wise MERGE are checked against
the closed form (per-batch latest, first live batch, last batch), joins are
plain SQL joins.  Column names equal the Spark result's.
"""

from __future__ import annotations

from tidemark.plans.views import EO, EV_SQL, IC_SQL, IO, OC_SQL, OO, RAWEV_SQL


def _latest_sql(view: str, keys: str, order: str, cols: str) -> str:
    return f"""SELECT {cols} FROM (
  SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn FROM ({view}) v
) x WHERE rn = 1"""


def closed_form(view: str, keys: list[str], order: str, upd: list[str], ins: list[str],
                first_seen: bool) -> str:
    """Final curated table after merging every batch of ``view`` in order."""
    k = ", ".join(keys)
    sel = [k]
    for c in upd:
        sel.append(f"arg_max(CASE WHEN op <> 'D' THEN {c} END, "
                   f"CASE WHEN op <> 'D' THEN b END) AS {c}")
    for c in ins:
        sel.append(f"arg_min({c}, b) AS {c}")
    if first_seen:
        sel.append("arg_min(_bts, b) AS dw_first_seen_at")
    sel.append("arg_max(_bts, b) AS dw_last_updated_at")
    sel.append("arg_max(op, b) = 'D' AS is_deleted")
    return f"""WITH w AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {k}, b ORDER BY {order}) AS rn
                 FROM ({view}) v) x WHERE rn = 1),
f AS (SELECT *, min(CASE WHEN op <> 'D' THEN b END) OVER (PARTITION BY {k}) AS fb FROM w),
g AS (SELECT * FROM f WHERE b >= fb)
SELECT {', '.join(sel)} FROM g GROUP BY {k}"""


EV_TIMES = f"SELECT *, ts AS src_created_at, ts AS src_updated_at FROM ({EV_SQL}) e"
OC_TIMES = f"SELECT *, ts AS src_created_at, ts AS src_updated_at FROM ({OC_SQL}) o"
IC_TIMES = f"SELECT *, ts AS src_created_at FROM ({IC_SQL}) i"

REPLAY_EV = closed_form(EV_TIMES, ["k"], EO, ["status", "amount", "src_updated_at"],
                        ["src_created_at"], True)
REPLAY_OC = closed_form(OC_TIMES, ["customer_id"], OO,
                        ["order_id", "total_amount", "src_updated_at"], ["src_created_at"], False)
REPLAY_IC = closed_form(IC_TIMES, ["k1", "k2"], IO, ["pk", "sk", "q", "price", "disc", "tax"],
                        ["src_created_at"], False)

# full load of customer at batch -1, then the ev changes
FULL_LOAD_EV = f"""SELECT c_custkey AS k, CAST(-1 AS BIGINT) AS seq,
  TIMESTAMP '2023-12-31 00:00:00' AS ts, 'I' AS op, c_mktsegment AS status,
  CAST(c_acctbal AS DECIMAL(12,2)) AS amount, -1 AS b,
  TIMESTAMP '2024-02-01 00:00:00' + to_days(-1) AS _bts FROM customer
UNION ALL {EV_SQL}"""
CUSTOMER_DIM = closed_form(
    f"SELECT *, ts AS src_created_at, ts AS src_updated_at FROM ({FULL_LOAD_EV}) u",
    ["k"], EO, ["status", "amount", "src_updated_at"], ["src_created_at"], True)

IC_ATTRS = ["pk", "sk", "q", "price", "disc", "tax"]


def snapshot_sql(before: str | None) -> str:
    where = f"WHERE ts < TIMESTAMP '{before}'" if before else ""
    return f"""SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY k1, k2 ORDER BY {IO}) AS rn
  FROM ({IC_SQL}) v {where}) x WHERE rn = 1 AND op <> 'D'"""


SNAPSHOT_DIFF = f"""WITH p AS ({snapshot_sql('1998-07-01 00:00:00')}),
c AS ({snapshot_sql(None)}),
j AS (SELECT coalesce(p.k1, c.k1) AS k1, coalesce(p.k2, c.k2) AS k2,
             p.k1 IS NOT NULL AS in_p, c.k1 IS NOT NULL AS in_c,
             {', '.join(f'p.{a} AS p_{a}, c.{a} AS c_{a}' for a in IC_ATTRS)}
      FROM p FULL OUTER JOIN c ON p.k1 = c.k1 AND p.k2 = c.k2)
SELECT CASE WHEN NOT in_p THEN 'I' WHEN NOT in_c THEN 'D' ELSE 'U' END AS op,
       TIMESTAMP '2002-01-01 00:00:00' AS _captured_at, k1, k2,
       {', '.join(f'CASE WHEN in_c THEN c_{a} ELSE p_{a} END AS {a}' for a in IC_ATTRS)}
FROM j
WHERE NOT in_p OR NOT in_c OR {' OR '.join(f'p_{a} IS DISTINCT FROM c_{a}' for a in IC_ATTRS)}"""

NOT_NULL = {
    "customer": ["c_custkey", "c_name", "c_nationkey"],
    "orders": ["o_orderkey", "o_custkey", "o_orderdate", "o_totalprice"],
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                 "l_extendedprice"],
}
NOT_NULL_REPORT = "\nUNION ALL\n".join(
    f"SELECT '{t}' AS tbl, '{c}' AS col, count(*) AS n_rows, count(*) - count({c}) AS n_null "
    f"FROM {t}" for t, cols in NOT_NULL.items() for c in cols)

ORACLE: dict[str, str] = {
    "latest_event": _latest_sql(EV_SQL, "k", EO, "k, seq, ts, op, status, amount, b"),
    "latest_event_agg": _latest_sql(EV_SQL, "k", EO, "k, seq, ts, op, status, amount, b"),
    "latest_order": _latest_sql(OC_SQL, "customer_id", OO,
                                "order_id, customer_id, ts, op, total_amount, b"),
    "latest_item": _latest_sql(IC_SQL, "k1, k2", IO,
                               "k1, k2, ts, op, pk, sk, q, price, disc, tax, b"),
    "replay_events": REPLAY_EV,
    "replay_orders": REPLAY_OC,
    "replay_items": REPLAY_IC,
    "merge_events": REPLAY_EV,
    "merge_orders": REPLAY_OC,
    "merge_items": REPLAY_IC,
    "live_customers": f"SELECT * FROM ({REPLAY_EV}) r WHERE NOT is_deleted",
    "op_predicates": f"""SELECT op, count(*) AS n, count(*) FILTER (WHERE op = 'D') AS n_delete,
  count(*) FILTER (WHERE op IN ('U', 'I')) AS n_upsert,
  count(*) FILTER (WHERE op != 'D') AS n_not_delete,
  count(*) FILTER (WHERE (op = 'D') IS NULL) AS n_unknown
FROM ({RAWEV_SQL}) r GROUP BY op""",
    "op_mix": f"SELECT op, count(*) AS n FROM ({EV_SQL}) e GROUP BY op",
    "table_counts": """SELECT 'customer' AS tbl, count(*) AS n FROM customer
UNION ALL SELECT 'orders' AS tbl, count(*) AS n FROM orders
UNION ALL SELECT 'lineitem' AS tbl, count(*) AS n FROM lineitem""",
    "line_total": f"""SELECT k1, k2, pk, sk, q, price, disc,
  CAST(q * price * (1 - disc * CAST(0.01 AS DECIMAL(3,2))) AS DECIMAL(12,2)) AS line_total
FROM ({IC_SQL}) i""",
    "full_name": "SELECT c_custkey, c_name || ' ' || c_mktsegment AS full_name FROM customer",
    "extract_field": "SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INT) AS k "
                     "FROM events",
    "raw_project": """SELECT o_orderkey AS order_id, o_custkey AS customer_id,
  CAST(o_orderdate AS DATE) AS order_date, o_orderstatus AS order_status,
  CAST(o_totalprice AS DECIMAL(12,2)) AS total_amount, o_orderpriority AS shipping_method,
  '' AS cast_errors
FROM orders""",
    "date_minus_days": "SELECT o_orderkey, CAST(o_orderdate AS DATE) - 10 AS order_date_minus_10 "
                       "FROM orders",
    "last_24h": """SELECT * FROM events
WHERE ts >= TIMESTAMP '2024-01-15 00:00:00' - INTERVAL 24 HOUR
  AND ts < TIMESTAMP '2024-01-15 00:00:00'""",
    "newest_50": "SELECT * FROM events ORDER BY ts DESC NULLS LAST, event_id DESC LIMIT 50",
    "snapshot_diff": SNAPSHOT_DIFF,
    "snapshot_diff_join": SNAPSHOT_DIFF,
    "full_load_then_changes": f"""SELECT op, count(*) AS n FROM (
  SELECT 'I' AS op FROM customer UNION ALL SELECT op FROM ({EV_SQL}) e) u GROUP BY op""",
    "orphans": f"""SELECT o.o_orderkey, o.o_custkey FROM orders o
WHERE o.o_custkey IS NOT NULL AND NOT EXISTS (
  SELECT 1 FROM ({CUSTOMER_DIM}) d WHERE NOT d.is_deleted AND d.k = o.o_custkey)""",
    "star_revenue": """SELECT n_name, CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))
    * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS DECIMAL(18,2)) AS revenue
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
GROUP BY n_name""",
    "not_null_report": NOT_NULL_REPORT,
    "duplicate_keys": """SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "domain_violations": f"""SELECT 'op' AS col, op AS value, op IS NULL AS is_null, count(*) AS n
FROM ({RAWEV_SQL}) r WHERE op IS NULL OR op NOT IN ('I', 'U', 'D') GROUP BY op""",
    "quarantine_reasons": f"""SELECT reason, count(*) AS n FROM (
  SELECT concat_ws(',', CASE WHEN k IS NULL THEN 'null_key' END,
                        CASE WHEN op IS NULL THEN 'null_op' END,
                        CASE WHEN op IS NOT NULL AND op NOT IN ('I', 'U', 'D') THEN 'bad_op' END
         ) AS reason
  FROM ({RAWEV_SQL}) r) x WHERE reason <> '' GROUP BY reason""",
    "order_total_mismatch": """SELECT o.o_orderkey, CAST(CAST(o.o_totalprice AS DECIMAL(12,2)) AS DECIMAL(18,2)) AS stored_total,
  CAST(coalesce(s.line_sum, 0) AS DECIMAL(18,2)) AS line_sum
FROM orders o LEFT JOIN (
  SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS line_sum
  FROM lineitem GROUP BY l_orderkey) s ON s.l_orderkey = o.o_orderkey
WHERE CAST(CAST(o.o_totalprice AS DECIMAL(12,2)) AS DECIMAL(18,2))
   <> CAST(coalesce(s.line_sum, 0) AS DECIMAL(18,2))""",
    "load_history": "\nUNION ALL\n".join(
        f"SELECT '{t}.parquet' AS file_name, count(*) AS row_count, TIMESTAMP '2024-01-15 06:00:00' AS first_load_time, "
        f"TIMESTAMP '2024-01-15 06:00:00' AS last_load_time FROM {t}" for t in ("orders", "lineitem", "events")),
    "layer_counts": f"""SELECT 'raw' AS layer, count(*) AS n FROM ({EV_SQL}) e
UNION ALL SELECT 'latest' AS layer, count(DISTINCT k) AS n FROM ({EV_SQL}) e
UNION ALL SELECT 'live' AS layer, count(*) AS n FROM ({REPLAY_EV}) r WHERE NOT is_deleted
UNION ALL SELECT 'deleted' AS layer, count(*) AS n FROM ({REPLAY_EV}) r WHERE is_deleted""",
}
