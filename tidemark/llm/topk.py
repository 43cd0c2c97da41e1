"""Exact top-k inner products, term at a time.

Vectors become integer rows, ``floor(scale * x)``.  Candidates and queries are
dealt into blocks; each pair of a query block and a candidate block is one
group.  There the candidates are turned into postings: per component, the rows
with a non-zero weight and their weights.  A query's terms are its non-zero
components; term by term, its weight times the term's posting is scattered into
a dense score array over the block, which stays in cache, and a partition
selection keeps the query's best.  A merge by query ranks what the blocks kept.

Edge cases: rows whose vector is null, or holds a null, NaN or infinite
component, take no part; vectors of other lengths count their missing
components as zero; a query's own id is no candidate; repeated rows of one id
and vector ask once, and are candidates each; ties go to the smaller id.  Row
ids must not be null (such rows take no part).  An empty table gives no row; the
result has no column of the caller's.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import table

K, SCALE = 20, 64
#: Rows of a candidate block and of a query block.
CANDIDATES, QUERIES = 8192, 2048


def _postings(block: np.ndarray) -> list[tuple[np.ndarray | slice, np.ndarray]]:
    """(rows, weights) of each component's non-zero entries, rows ascending.  A
    posting with a quarter of the rows is kept at full length, zeros included:
    a run of memory is scattered faster than so many places."""
    out = []
    for column in block.T:
        rows = np.flatnonzero(column)
        full = 4 * len(rows) >= len(block)
        out.append((slice(None), column.copy()) if full else (rows, column[rows].copy()))
    return out


def _scores(query: np.ndarray, postings: list, buffer: np.ndarray) -> np.ndarray:
    """One query's scores: each of its terms scatters its weighted posting."""
    score = np.zeros(len(buffer), buffer.dtype)
    for term in np.flatnonzero(query):
        rows, weights = postings[term]
        part = np.multiply(weights, query[term], out=buffer[:len(weights)])
        if isinstance(rows, slice):
            score += part
        else:
            score[rows] += part
    return score


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    values = column.to_pylist()
    out = np.zeros((len(values), dim), np.int64)
    for i, v in enumerate(values):
        out[i, :len(v)] = v
    return out


def _best(k: int):
    def run(key, queries: pa.Table, rows: pa.Table) -> pa.Table:
        out = {"query_id": [], "vec_id": [], "score": [], "twin": []}
        if queries.num_rows and rows.num_rows:
            dim = max(max(map(len, t.column("v").to_pylist())) for t in (queries, rows))
            q, c = _matrix(queries.column("v"), dim), _matrix(rows.column("v"), dim)
            bound = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * max(dim, 1)
            # Sums of this size are exact in the type.
            kind = np.float32 if bound < 2 ** 24 else np.float64 if bound < 2 ** 53 else np.int64
            q, c = q.astype(kind), c.astype(kind)
            qid, cid = queries.column("id").to_numpy(), rows.column("id").to_numpy()
            twin = queries.column("twin").to_numpy()
            order = np.argsort(cid, kind="stable")
            c, cid = c[order], cid[order]
            postings, buffer = _postings(c), np.empty(len(c), kind)
            for i in range(len(q)):
                s, ids = _scores(q[i], postings, buffer), cid
                own = np.searchsorted(ids, qid[i]), np.searchsorted(ids, qid[i], "right")
                if own[0] < own[1]:
                    s, ids = np.delete(s, np.arange(*own)), np.delete(ids, np.arange(*own))
                if not len(s):
                    continue
                if len(s) > k:
                    least = np.partition(s, len(s) - k)[len(s) - k]
                    above = np.flatnonzero(s > least)
                    top = np.concatenate((above, np.flatnonzero(s == least)[: k - len(above)]))  # ids ascend
                else:
                    top = np.arange(len(s))
                out["query_id"].append(np.full(len(top), qid[i]))
                out["twin"].append(np.full(len(top), twin[i]))
                out["vec_id"].append(ids[top])
                out["score"].append(s[top].astype(np.int64))
        return pa.table({n: pa.array(np.concatenate(v) if v else np.zeros(0, np.int64), pa.int64())
                         for n, v in out.items()})
    return run


def quantise(vectors: DataFrame, vec_id: str, vector: str, scale: int) -> DataFrame:
    """(id, v): integer vectors of the rows that take part."""
    v = F.col(vector).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (vectors.where(v.isNotNull() & ~bad & F.col(vec_id).isNotNull())
            .select(F.col(vec_id).cast("bigint").alias("id"), F.transform(v, lambda x: F.floor(x * scale)).alias("v")))


def top_k(vectors: DataFrame, is_query: Column, vec_id: str = "vec_id", vector: str = "embedding",
          k: int = K, scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score) of every query's ``k`` best candidates."""
    rows = quantise(vectors, vec_id, vector, scale)
    asked = quantise(vectors.where(is_query), vec_id, vector, scale).distinct().withColumn("twin", F.xxhash64("v"))
    n = rows.count()
    c_blocks = max(1, -(-n // CANDIDATES))
    q_blocks = max(1, -(-asked.count() // QUERIES))

    def dealt(df: DataFrame, own: str, own_n: int, other: str, other_n: int) -> DataFrame:
        # The row's number goes in, so that copies of one row do not share a block.
        return (df.withColumn(own, F.pmod(F.xxhash64("id", "v", F.monotonically_increasing_id()), F.lit(own_n)))
                .withColumn(other, F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(other_n - 1).cast("bigint")))))

    left = dealt(asked, "qb", q_blocks, "cb", c_blocks).groupBy("qb", "cb")
    right = dealt(rows, "cb", c_blocks, "qb", q_blocks).groupBy("qb", "cb")
    best = left.cogroup(right).applyInArrow(_best(k), "query_id bigint, vec_id bigint, score bigint, twin bigint")
    order = Window.partitionBy("query_id", "twin").orderBy(F.desc("score"), "vec_id")
    return (best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op6_term_at_a_time(spark, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


OP6_SQL = f"""
WITH e AS (SELECT vec_id::BIGINT AS id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
s AS (SELECT q.id AS query_id, c.id AS vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
      FROM e q, e c WHERE q.id % 20 = 0 AND q.id <> c.id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {K}
"""
