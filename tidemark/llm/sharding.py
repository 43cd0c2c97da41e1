"""Sharding by extendible hashing.

A row's hash is 60 bits of the md5 of its key.  The directory is indexed by the
leading bits: a bucket (a prefix) whose rows exceed the byte limit is split on
one more bit, until every shard fits.  The directory is worked out from byte
sums of hash cells, pre-aggregated in the tasks: cells of as many bits as the
total asks for, and then, round by round, finer cells of the oversized buckets
only.  A shard is the shortest prefix that fits; it is named by its bits.

A bucket that no bit can split (rows with one key) is cut into pages.  Such rows
are written with a number each and dealt by key and number to as many tasks as
their bytes ask for, so a key of any size is split among tasks; a task fills
page after page up to the limit, and only its last page of a key is not full.
One row larger than the limit is a shard by itself.

Edge cases: a null key hashes as empty text; null text is 0 bytes; an empty
table has no shard; repeated rows are placed each.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import materialise, record, table, unpack

BITS = 60
LIMIT = 1 << 20
#: Bits that a round adds for oversized buckets.
ROUND = 8
#: Full pages that a task cuts, about.
PAGES = 64


def hash60(key: Column) -> Column:
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def directory(cells: DataFrame, low: int, high: int, limit: int) -> DataFrame:
    """Shards that the cells of ``high`` bits (cell, bytes, n) form at depth
    ``low`` or more: (cell, depth, bytes, n); depth -1 where the cell itself is too large."""
    up = cells.select("cell", F.col("bytes").alias("b"), F.col("n").alias("m"),
                      F.explode(F.sequence(F.lit(low), F.lit(high))).alias("depth"))
    up = up.withColumn("p", F.call_function("shiftright", F.col("cell"), F.lit(high) - F.col("depth")))
    sums = up.groupBy("depth", "p").agg(F.sum("b").alias("bytes"), F.sum("m").alias("n"))
    fits = sums.where((F.col("bytes") <= limit) | (F.col("n") == 1))
    best = (up.select("cell", "depth", "p").join(fits, ["depth", "p"])
            .groupBy("cell").agg(F.min(F.struct("depth", "bytes", "n")).alias("s")))
    return cells.join(best, "cell", "left").select(
        "cell", F.coalesce("s.depth", F.lit(-1)).alias("depth"), F.col("s.bytes").alias("bytes"), F.col("s.n").alias("n"))


def _fill(limit: int):
    """Rows in order of key -> pages of at most ``limit`` bytes, or one row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, page, now, held, size = TaskContext.get().partitionId(), 0, None, [], 0

        def full():
            rows = pa.Table.from_batches(held).combine_chunks()
            name = pa.array([f"{part}.{page}"] * len(rows), pa.string())
            return rows.append_column("page", name).append_column("shard_bytes", pa.array([size] * len(rows), pa.int64()))

        for batch in batches:
            first = 0
            for i, (h, b) in enumerate(zip(batch.column("h").to_pylist(), batch.column("b").to_pylist())):
                if (h != now or size + b > limit) and (held or first < i):
                    held.append(batch.slice(first, i - first))
                    yield from full().to_batches()
                    page, held, size, first = (page + 1 if h == now else 0), [], 0, i
                now, size = h, size + b
            held.append(batch.slice(first))
        if now is not None:
            yield from full().to_batches()
    return run


def pages(rows: DataFrame, limit: int) -> DataFrame:
    """Rows (rec, h, b) of keys that no bit splits -> with ``page`` and ``shard_bytes``."""
    # The number is fixed by writing it, so that a repeated task deals alike.
    rows = materialise(rows.withColumn("i", F.monotonically_increasing_id()), "unsplit")
    total = rows.agg(F.sum("b")).first()[0] or 0
    dealt = rows.repartitionByRange(max(1, -(-total // (PAGES * limit))), "h", "i").sortWithinPartitions("h", "i")
    kind = T.StructType(rows.schema.fields + [T.StructField("page", T.StringType()), T.StructField("shard_bytes", T.LongType())])
    # Written, for the names hold the number of the task.
    return materialise(dealt.mapInArrow(_fill(limit), kind), "pages")


def shard(docs: DataFrame, key: str = "doc_id", text: str = "text", limit: int = LIMIT) -> DataFrame:
    """``docs`` with ``shard`` (the prefix bits, ``.page`` for cut buckets),
    ``depth``, ``row_bytes`` and ``shard_bytes``."""
    rows = docs.select(record(docs), hash60(F.col(key)).alias("h"),
                       F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint").alias("b"))
    total = rows.agg(F.sum("b")).first()[0] or 0
    low, high = 0, min(BITS, max(4, math.ceil(math.log2(total / limit + 1)) + 3))
    placed, open_ = [], rows
    while True:
        cells = (open_.groupBy(F.call_function("shiftright", F.col("h"), F.lit(BITS - high)).alias("cell"))
                 .agg(F.sum("b").alias("bytes"), F.count("*").alias("n")))
        # One row a cell: a few for each shard.  Written, so that the plan of a
        # further round grows by one join only.
        found = materialise(directory(cells, low, high, limit), "directory")
        named = (open_.withColumn("cell", F.call_function("shiftright", F.col("h"), F.lit(BITS - high)))
                 .join(found, "cell"))
        placed.append(named.where("depth >= 0").select(
            "rec", "b", "depth", F.lpad(F.bin("cell"), high, "0").substr(F.lit(1), F.col("depth")).alias("shard"),
            F.col("bytes").alias("shard_bytes")))
        if found.where("depth < 0").isEmpty():
            break
        open_ = named.where("depth < 0").select("rec", "h", "b")
        if high == BITS:
            placed.append(pages(open_, limit).select(
                "rec", "b", F.lit(BITS).alias("depth"),
                F.concat_ws(".", F.lpad(F.bin("h"), BITS, "0"), "page").alias("shard"), "shard_bytes"))
            break
        low, high = high + 1, min(BITS, high + ROUND)
    out = placed[0]
    for p in placed[1:]:
        out = out.unionByName(p)
    return out.select(*unpack(docs.columns, {"shard": F.col("shard"), "depth": F.col("depth"),
                                             "row_bytes": F.col("b"), "shard_bytes": F.col("shard_bytes")}))


def op1_extendible_hashing(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return shard(docs).select("doc_id", "shard", F.col("depth").cast("bigint").alias("depth"), "row_bytes", "shard_bytes")


OP1_SQL = f"""
WITH r AS (SELECT doc_id, coalesce(strlen(text), 0)::BIGINT AS row_bytes,
                  ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h FROM documents),
u AS (SELECT doc_id, row_bytes, h, d, h >> ({BITS} - d) AS p FROM r, generate_series(0, 40) AS g(d)),
s AS (SELECT d, p, sum(row_bytes)::BIGINT AS shard_bytes, count(*) AS n FROM u GROUP BY d, p),
m AS (SELECT u.doc_id, u.row_bytes, u.h, min(u.d) AS depth FROM u JOIN s USING (d, p)
      WHERE s.shard_bytes <= {LIMIT} OR s.n = 1 GROUP BY u.doc_id, u.row_bytes, u.h)
SELECT doc_id, substr(lpad(bin(h), {BITS}, '0'), 1, depth::INT) AS shard, depth::BIGINT AS depth, row_bytes, s.shard_bytes
FROM m JOIN s ON s.d = m.depth AND s.p = m.h >> ({BITS} - m.depth)
"""
