"""Facts that come before their dimension (T6, J3): a stream-stream outer join.

Tables are fed independently, so an order may reach RAW before its customer.
Facts are held in the join's state until their parent arrives, or until ``wait``
has passed on the time of arrival in RAW (``_loaded_at``): then the fact comes
out with no parent.  What the join holds is bounded by ``wait`` on both sides,
never by the tables.  A parent that arrived long before is not in the state, so
facts that come out alone are held against the curated parents once, in their
batch.  The log so written has one row per orphan; :func:`open_orphans` drops
those whose parent came later still, and then equals the batch anti join over
all facts that are older than ``wait``.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.quality import orphans
from tidemark.sources.changes import raw_schema
from tidemark.spec import OP_DELETE, TableSpec
from tidemark.streaming.publish import publish, query_id


def _stream(spark: SparkSession, path: str, spec: TableSpec, slack: str) -> DataFrame:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)
    raw = spark.readStream.schema(raw_schema(spec)).option("recursiveFileLookup", "true").parquet(path)
    live = raw.where(F.col(spec.op_col).isNotNull() & (F.col(spec.op_col) != OP_DELETE))
    return live.withColumn("_at", F.col("_loaded_at").cast("timestamp")).withWatermark("_at", slack)


def start_orphan_watch(spark: SparkSession, child_raw: str, child: TableSpec, parent_raw: str, parent: TableSpec,
                       foreign_key: str, parents: Callable[[], DataFrame | None], out_path: str, checkpoint: str,
                       wait: str = "1 hour", slack: str = "0 seconds", once: bool = False,
                       schedule: str = "5 minutes") -> StreamingQuery:
    """Facts whose ``foreign_key`` found no parent within ``wait``, appended to
    ``out_path``: the child's keys, the foreign key, and when the fact arrived.

    ``parents`` gives the curated parent table (None while there is none);
    ``slack`` is how much later than a newer row an older one may reach RAW.
    """
    key = child.foreign_keys[foreign_key][1]
    facts = (_stream(spark, child_raw, child, slack).where(F.col(foreign_key).isNotNull())
             .select(*child.keys, F.col(foreign_key).alias("_fk"), "_at"))
    known = _stream(spark, parent_raw, parent, slack).select(F.col(key).alias("_pk"), F.col("_at").alias("_pat"))
    near = (F.col("_fk") == F.col("_pk")) & (F.col("_pat") >= F.col("_at") - F.expr(f"INTERVAL {wait}")) \
        & (F.col("_pat") <= F.col("_at") + F.expr(f"INTERVAL {wait}"))
    alone = facts.join(known, near, "left_outer").where(F.col("_pk").isNull())

    def run(df: DataFrame, batch_id: int) -> None:
        rows = df.select(*child.keys, F.col("_fk").alias(foreign_key), F.col("_at").cast("timestamp_ntz").alias("arrived_at"))
        table = parents()
        if table is not None:
            rows = orphans(rows, table, {foreign_key: key})
        publish(rows, out_path, query_id(df), batch_id)

    w = alone.writeStream.outputMode("append").foreachBatch(run).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if once else w.trigger(processingTime=schedule)).start()


def open_orphans(spark: SparkSession, out_path: str, child: TableSpec, foreign_key: str,
                 parents: DataFrame) -> DataFrame:
    """Logged orphans that have no parent to this day, once per fact and key value."""
    kinds = {f.name: f.dataType.simpleString() for f in child.schema.fields}
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in (*child.keys, foreign_key)) + ", arrived_at timestamp_ntz"
    rows = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(out_path)
    first = rows.groupBy(*child.keys, foreign_key).agg(F.min("arrived_at").alias("arrived_at"))
    return orphans(first, parents, {foreign_key: child.foreign_keys[foreign_key][1]})
