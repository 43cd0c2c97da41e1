"""Batch folders: how a micro-batch reaches a folder exactly once.

Spark's file sink cannot take what ``foreachBatch`` makes, so such a batch is
written under ``_inflight`` (hidden from every reader) and moved by one rename
to ``<query id>-<batch id>``.  A batch repeated after a failure finds its folder
and writes nothing; a batch that failed half-way has left nothing to see.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def query_id(df: DataFrame) -> str:
    """Id of the query whose ``foreachBatch`` runs: that of its checkpoint."""
    got = df.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not got:
        raise RuntimeError("not inside a streaming query's foreachBatch; name the source yourself")
    return got


def _path(spark: SparkSession, text: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(text)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def batch_folder(root: str, source: str, batch_id: int) -> str:
    return f"{root.rstrip('/')}/{source}-{batch_id:012d}"


def published(spark: SparkSession, root: str, source: str, batch_id: int) -> bool:
    path, fs = _path(spark, batch_folder(root, source, batch_id))
    return fs.exists(path)


def publish(df: DataFrame, root: str, source: str, batch_id: int, files: int | None = None) -> bool:
    """Write ``df`` as one batch folder of ``root``; False if it is there already."""
    spark = df.sparkSession
    if published(spark, root, source, batch_id):
        return False
    name = f"{source}-{batch_id:012d}"
    inflight = f"{root.rstrip('/')}/_inflight/{name}"
    (df if files is None else df.coalesce(files)).write.mode("overwrite").parquet(inflight)
    here, fs = _path(spark, inflight)
    there, _ = _path(spark, batch_folder(root, source, batch_id))
    if not fs.rename(here, there) and not fs.exists(there):
        raise IOError(f"could not move {inflight} to {there}")
    return True
