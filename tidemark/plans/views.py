"""Change logs derived from the test tables, as DataFrames and as SQL text.

Each log reads one whole table; nothing is sampled.

* ``ev`` -- events as a change log on ``user_id``; the day of the month picks
  one of three merge batches (days 1-10, 11-20, 21-31).
* ``oc`` -- orders as a change log on the customer: several orders per key,
  ties on the order date, one batch per order year.
* ``ic`` -- line items as a change log on ``(l_orderkey, l_linenumber)``:
  repeated keys, ties on the ship date, one batch per ship year.
* ``rawev`` -- the same events as a raw, not yet quarantined feed: ``view``
  events arrive without an op code and ``click`` events with an unknown one.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.expr import batch_time, op_priority
from tidemark.spec import Field, TableSpec

# Merge time of batch 0; batch b is merged b days later.
BATCH_BASE = _dt.datetime(2024, 2, 1)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ev(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    op = (F.when(F.col("event_type") == "signup", "I")
          .when(F.col("event_type") == "error", "D").otherwise("U"))
    b = F.floor((F.dayofmonth("ts") - 1) / 10).cast("int")
    return e.select(
        F.col("user_id").alias("k"), F.col("event_id").alias("seq"), "ts",
        op.alias("op"), F.col("event_type").alias("status"),
        F.col("value").cast("decimal(12,2)").alias("amount"), b.alias("b"),
    ).withColumn("_bts", batch_time(BATCH_BASE, "b"))


def rawev(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    op = (F.when(F.col("event_type") == "signup", "I")
          .when(F.col("event_type") == "error", "D")
          .when(F.col("event_type") == "purchase", "U")
          .when(F.col("event_type") == "click", "X"))
    return e.select(F.col("user_id").alias("k"), F.col("event_id").alias("seq"), "ts",
                    op.alias("op"), F.col("event_type").alias("status"),
                    F.col("value").cast("decimal(12,2)").alias("amount"))


def oc(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    op = (F.when(F.col("o_orderstatus") == "O", "I")
          .when(F.col("o_orderstatus") == "P", "U").otherwise("D"))
    return o.select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("ts"), op.alias("op"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("total_amount"),
        F.year("o_orderdate").cast("int").alias("b"),
    ).withColumn("_bts", batch_time(BATCH_BASE, "b"))


def ic(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    op = (F.when(F.col("l_returnflag") == "A", "I")
          .when(F.col("l_returnflag") == "N", "U").otherwise("D"))
    return li.select(
        F.col("l_orderkey").alias("k1"), F.col("l_linenumber").alias("k2"),
        F.col("l_shipdate").alias("ts"), op.alias("op"),
        F.col("l_partkey").alias("pk"), F.col("l_suppkey").alias("sk"),
        F.col("l_quantity").cast("decimal(10,0)").alias("q"),
        F.col("l_extendedprice").cast("decimal(10,2)").alias("price"),
        (F.col("l_discount") * 100).cast("decimal(5,2)").alias("disc"),
        (F.col("l_tax") * 100).cast("decimal(5,2)").alias("tax"),
        F.year("l_shipdate").cast("int").alias("b"),
    ).withColumn("_bts", batch_time(BATCH_BASE, "b"))


def with_source_times(df: DataFrame) -> DataFrame:
    """The logs carry one time; it is both the source create and update time."""
    return df.withColumns({"src_created_at": F.col("ts"), "src_updated_at": F.col("ts")})


# Specs of the derived logs: same merge semantics as the three source tables.
EV_SPEC = TableSpec(
    name="ev", curated_name="dim_users", keys=("k",),
    fields=(Field("k", "bigint", nullable=False), Field("status", "string"),
            Field("amount", "decimal(12,2)")),
    update_columns=("status", "amount", "src_updated_at"),
    insert_only=("src_created_at",), has_first_seen=True,
    ts_col="ts", tiebreak=("seq",))

OC_SPEC = TableSpec(
    name="oc", curated_name="fact_customer_orders", keys=("customer_id",),
    fields=(Field("customer_id", "bigint", nullable=False), Field("order_id", "bigint"),
            Field("total_amount", "decimal(12,2)")),
    update_columns=("order_id", "total_amount", "src_updated_at"),
    insert_only=("src_created_at",), ts_col="ts", tiebreak=("order_id",))

IC_SPEC = TableSpec(
    name="ic", curated_name="fact_items", keys=("k1", "k2"),
    fields=(Field("k1", "bigint", nullable=False), Field("k2", "int", nullable=False),
            Field("pk", "bigint"), Field("sk", "bigint"), Field("q", "decimal(10,0)"),
            Field("price", "decimal(10,2)"), Field("disc", "decimal(5,2)"),
            Field("tax", "decimal(5,2)")),
    update_columns=("pk", "sk", "q", "price", "disc", "tax"),
    insert_only=("src_created_at",), ts_col="ts",
    tiebreak=("pk", "sk", "q", "price", "disc", "tax"))

PRIORITY_SQL = "CASE op WHEN 'D' THEN 3 WHEN 'U' THEN 2 WHEN 'I' THEN 1 ELSE 0 END"

# -- the same logs as SQL text (DuckDB dialect, used by the oracle) ----------
EV_SQL = """SELECT user_id AS k, event_id AS seq, ts,
  CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' ELSE 'U' END AS op,
  event_type AS status, CAST(value AS DECIMAL(12,2)) AS amount,
  CAST(floor((day(ts)-1)/10) AS INT) AS b,
  TIMESTAMP '2024-02-01 00:00:00' + to_days(CAST(floor((day(ts)-1)/10) AS INT)) AS _bts
FROM events"""

RAWEV_SQL = """SELECT user_id AS k, event_id AS seq, ts,
  CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D'
                  WHEN 'purchase' THEN 'U' WHEN 'click' THEN 'X' END AS op,
  event_type AS status, CAST(value AS DECIMAL(12,2)) AS amount
FROM events"""

OC_SQL = """SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS ts,
  CASE o_orderstatus WHEN 'O' THEN 'I' WHEN 'P' THEN 'U' ELSE 'D' END AS op,
  CAST(o_totalprice AS DECIMAL(12,2)) AS total_amount, CAST(year(o_orderdate) AS INT) AS b,
  TIMESTAMP '2024-02-01 00:00:00' + to_days(CAST(year(o_orderdate) AS INT)) AS _bts
FROM orders"""

IC_SQL = """SELECT l_orderkey AS k1, l_linenumber AS k2, l_shipdate AS ts,
  CASE l_returnflag WHEN 'A' THEN 'I' WHEN 'N' THEN 'U' ELSE 'D' END AS op,
  l_partkey AS pk, l_suppkey AS sk, CAST(l_quantity AS DECIMAL(10,0)) AS q,
  CAST(l_extendedprice AS DECIMAL(10,2)) AS price, CAST(l_discount*100 AS DECIMAL(5,2)) AS disc,
  CAST(l_tax*100 AS DECIMAL(5,2)) AS tax, CAST(year(l_shipdate) AS INT) AS b,
  TIMESTAMP '2024-02-01 00:00:00' + to_days(CAST(year(l_shipdate) AS INT)) AS _bts
FROM lineitem"""

# descending event orders, written out per log
EO = f"ts DESC NULLS LAST, {PRIORITY_SQL} DESC, seq DESC"
OO = f"ts DESC NULLS LAST, {PRIORITY_SQL} DESC, order_id DESC"
IO = (f"ts DESC NULLS LAST, {PRIORITY_SQL} DESC, pk DESC, sk DESC, q DESC, "
      "price DESC, disc DESC, tax DESC")

__all__ = ["ev", "rawev", "oc", "ic", "op_priority"]
