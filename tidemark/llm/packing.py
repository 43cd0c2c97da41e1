"""Packing by concatenate and cut.

Pass one encodes every document, adds the end id, and writes each partition's
token stream with the running position inside the partition.  The partitions'
totals (a row a partition) are prefix-summed into global offsets.  Pass two adds
its partition's offset to each document and cuts the stream at every multiple
of the window: each piece is a boundary record that says where the piece lies
in its document and in its window.  No token is shuffled; only the last window
can be short, and it alone is padded.

Ids are those of ``tokenizers`` for the vocabulary file, called with
``add_special_tokens=False``: none is added, but the string of an added token
(``<|endoftext|>``) in a text is that token's id.  Texts of plain Latin script
without such a string are encoded by the faster ``tiktoken`` engine over the
same vocabulary (``byte_bpe_50k.tiktoken``), which gives the same ids there
(tested); every other text goes through ``tokenizers``.

Edge cases: a null or empty text has the end id alone; an empty table gives no
row; repeated rows are packed as often as they occur; a very long text has as
many pieces as windows; a caller's column named like an output is replaced.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import materialise, record, table, texts, unpack

VOCABULARY = "byte_bpe_50k"
END = 1
WINDOW = 2048
#: Highest code point that the fast engine is used for (Latin, IPA excluded).
FAST_BELOW = 0x250

_PIECES = "rec {rec}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"


@lru_cache(maxsize=4)
def _engines(vocabulary: str):
    import public_tokenizers as P
    import tiktoken
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(P.path(f"{vocabulary}.json"))
    with open(P.path(f"{vocabulary}.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    fast = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return exact, fast


@lru_cache(maxsize=4)
def _added(vocabulary: str) -> tuple[str, ...]:
    return tuple(t.content for t in _engines(vocabulary)[0].get_added_tokens_decoder().values())


def encode(text: str, vocabulary: str = VOCABULARY) -> np.ndarray:
    """The text's ids, without an end id."""
    exact, fast = _engines(vocabulary)
    latin = text.isascii() or max(text) < chr(FAST_BELOW)
    if latin and not any(t in text for t in _added(vocabulary)):
        return np.array(fast.encode_ordinary(text), np.uint32)
    return np.array(exact.encode(text, add_special_tokens=False).ids, np.uint32)


def tokenise(docs: DataFrame, text: str = "text", vocabulary: str = VOCABULARY,
             end: int | None = END) -> DataFrame:
    """(rec, part, at, n, ids): the record, its partition, tokens before it in
    the partition, its token count, and its ids as little-endian uint32."""
    rec = docs.select(record(docs), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        tail = np.array([] if end is None else [end], np.uint32)
        for batch in batches:
            ids = [np.concatenate((encode(v.decode("utf-8", "replace"), vocabulary), tail))
                   for v in texts(batch.column("text"))]
            n = np.array([len(x) for x in ids], np.int64)
            before = at + np.cumsum(n) - n
            at += int(n.sum())
            yield pa.RecordBatch.from_arrays(
                [batch.column("rec"), pa.array(np.full(len(n), part), pa.int64()),
                 pa.array(before, pa.int64()), pa.array(n, pa.int64()),
                 pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary())],
                names=["rec", "part", "at", "n", "ids"])

    return rec.mapInArrow(run, f"rec {rec.schema['rec'].dataType.simpleString()}, "
                               "part bigint, at bigint, n bigint, ids binary")


def pack(docs: DataFrame, text: str = "text", window: int = WINDOW,
         vocabulary: str = VOCABULARY, keep: list[str] | None = None,
         with_ids: bool = False) -> DataFrame:
    """A row per piece: the columns ``keep`` of its document (all by default),
    ``start length ids_crc32 doc_tokens sequence_id offset`` and, if asked for,
    the piece's ``ids`` as an array."""
    kept = docs.columns if keep is None else keep
    slim = docs.select(F.col(text).alias("_t"), *[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(kept)])
    tokens = tokenise(slim, "_t").select(
        F.struct(*[F.col(f"rec.k{i}") for i in range(len(kept))]).alias("rec") if kept
        else F.struct(F.lit(None).cast("int").alias("k")).alias("rec"), "part", "at", "n", "ids")
    tokens = materialise(tokens, "packing-tokens")
    # A row a partition: prefix sums over partition totals.
    totals = tokens.groupBy("part").agg(F.sum("n").alias("total"))
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("total").over(order), F.lit(0)).alias("base"))
    placed = tokens.join(F.broadcast(offsets), "part").select("rec", "n", "ids", (F.col("at") + F.col("base")).alias("at"))
    schema = _PIECES.format(rec=placed.schema["rec"].dataType.simpleString()) + (", ids binary" if with_ids else "")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column("at").to_numpy()
            n = batch.column("n").to_numpy()
            data = texts(batch.column("ids"))
            first = at // window
            count = np.where(n > 0, (at + n - 1) // window - first + 1, 0)
            row = np.repeat(np.arange(len(n)), count)
            k = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            seq = first[row] + k
            begin = np.maximum(seq * window, at[row])
            stop = np.minimum((seq + 1) * window, (at + n)[row])
            start, length = begin - at[row], stop - begin
            cuts = [data[r][4 * s:4 * (s + m)] for r, s, m in zip(row.tolist(), start.tolist(), length.tolist())]
            out = [batch.column("rec").take(pa.array(row)), start, length,
                   [zlib.crc32(c) for c in cuts], n[row], seq, begin - seq * window]
            out = [out[0], *[pa.array(x, pa.int64()) for x in out[1:]]]
            names = ["rec", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            if with_ids:
                out.append(pa.array(cuts, pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(out, names=names)

    pieces = placed.mapInArrow(cut, schema)
    outs = {c: F.col(c) for c in pieces.columns if c != "rec"}
    taken = {o.lower() for o in outs}
    cols = [F.col(f"rec.k{i}").alias(c) for i, c in enumerate(kept) if c.lower() not in taken]
    return pieces.select(*cols, *[v.alias(k) for k, v in outs.items()])


def op7_concatenate_cut(spark, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), keep=["doc_id"])
