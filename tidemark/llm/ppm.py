"""Prediction by partial matching: code length of every text under a byte trie.

The model is a static PPM of order ``ORDER`` over bytes (method C escapes with
symbol exclusion), trained on the training texts: the trie's counts of every
context of up to four bytes and the byte after it, texts padded with a border
symbol before and ended by it.  A symbol is coded at the longest known context;
if it was never seen there, an escape (distinct symbols over total plus
distinct) leads to the next shorter one, where the symbols of the longer are
excluded.  As every symbol seen after a context was also seen after its suffix,
a node needs three numbers only: total, distinct symbols, and how much of its
suffix's total its own symbols take.  So each (context, symbol) has one log
probability, worked out level by level with joins and sums.

Nothing of the trie passes through the driver or a broadcast.  Texts lie in
chunks of a few megabytes; a chunk sends each of its different (context,
symbol) events and words once, with their training counts; the summed counts
become values; the values go back to the chunks that hold the event, and there
the texts are scored.  The base model (add-one unigrams of words) travels with
them.

Edge cases: null text is empty (its end alone is scored); with no training text
all 257 symbols are equally likely and no word is known; repeated rows count
and are scored each; an empty table gives no row; a text longer
than a chunk is a chunk by itself; a caller's column named like an output is
replaced by it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import U64, blocks, discard, fold, joined, materialise, record, table, texts, unpack, words

ORDER = 4
BORDER = 256
SYMBOLS = 257
#: Bytes of text whose events are kept and sent together.
CHUNK = 16 << 20
#: Keys are written in order, so their differences are smaller than they are.
_DELTAS = {"parquet.writer.version": "v2"}
_WORD = U64(1) << U64(62)
#: The key that counts the ends of texts.
_END = _WORD


def events(values: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Per predicted symbol (each byte, then the end): its event, the last
    ``ORDER + 1`` symbols of 9 bits; and the number of symbols per row."""
    data, begins = joined(values, b"\0" * ORDER)
    symbol = np.concatenate((np.full(ORDER, BORDER, np.uint16), data.astype(np.uint16)))
    ends = begins[1:]  # of rows, behind the first border
    for i in range(ORDER):
        symbol[ends + i] = BORDER
    key = np.zeros(len(data), np.uint64)
    for i in range(ORDER + 1):
        key = (key << U64(9)) | symbol[i:i + len(data)]
    keep = np.ones(len(data), bool)
    for i in range(1, ORDER):
        keep[begins[1:] - ORDER + i] = False
    return key[keep], np.diff(begins) - ORDER + 1


def word_keys(values: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    ids, per, _ = words(values)
    return (ids >> U64(2)) | _WORD, per


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(chunk, blob): compressed blocks of rows, numbered by chunk."""
    part, number, held = TaskContext.get().partitionId(), 0, 0
    for batch in batches:
        values = texts(batch.column("text"))
        for a, b in blocks(values):
            size = sum(map(len, values[a:b]))
            if held and held + size > CHUNK:
                number, held = number + 1, 0
            held += size
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_batch(batch.slice(a, b - a))
            yield pa.RecordBatch.from_arrays([pa.array([(part << 24) | number], pa.int64()),
                                              pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["chunk", "blob"])


def _rows(blob: bytes) -> pa.Table:
    return pa.ipc.open_stream(blob).read_all().combine_chunks()


def _counted(keys: list[np.ndarray], train: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key, n = np.concatenate(keys), np.concatenate(train)
    order = np.argsort(key)
    key, n = key[order], n[order]
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
    return key[first], np.add.reduceat(n, first) if len(first) else n


def _emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(chunk, key, n) of each chunk's different events and words."""
    now, keys, counts = None, [], []

    def out():
        key, n = _counted(keys, counts)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(key), now, np.int64)), pa.array(key.view(np.int64)), pa.array(n)], names=["chunk", "key", "n"])

    for batch in batches:
        for chunk, blob in zip(batch.column("chunk").to_pylist(), batch.column("blob").to_pylist()):
            if now is not None and chunk != now:
                yield out()
                keys, counts = [], []
            now = chunk
            rows = _rows(blob)
            values, train = texts(rows.column("text")), rows.column("train").to_numpy()
            for use in (True, False):
                mine = [v for v, t in zip(values, train) if t == use]
                if mine:
                    for f in (events, word_keys):
                        key, n = np.unique(f(mine)[0], return_counts=True)
                        keys.append(key)
                        counts.append(n.astype(np.int64) * int(use))
            keys.append(np.array([_END]))
            counts.append(np.array([train.sum()], np.int64))
            if sum(map(len, keys)) > 4_000_000:
                key, n = _counted(keys, counts)
                keys, counts = [key], [n]
    if keys:
        yield out()


def _levels(counts: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """(key, value): log10 probability of each event after its whole context;
    and the written tables that these still read."""
    used: list[DataFrame] = []
    level = [counts.select("key", F.col("n").alias("c"))]
    for k in range(ORDER - 1, -1, -1):
        shorter = F.col("key").bitwiseAND(F.lit((1 << (9 * (k + 1))) - 1)).alias("key")
        level.append(materialise(level[-1].groupBy(shorter).agg(F.sum("c").alias("c")), "ppm-level", **_DELTAS))
    level.reverse()  # level[k]: contexts of k symbols
    done = None
    for k, rows in enumerate(level):
        source = [rows] if k < ORDER else []
        # A context has at most 257 symbols, so its window is small.
        own = Window.partitionBy(F.call_function("shiftright", F.col("key"), F.lit(9)))
        seen = F.when(F.col("c") > 0, 1).otherwise(0)
        if done is not None:
            rows = (rows.withColumn("up", F.col("key").bitwiseAND(F.lit((1 << (9 * k)) - 1)))
                    .join(done.toDF("up", "c1", "t1", "q1", "f1", "g1"), "up"))
        rows = rows.withColumn("t", F.sum("c").over(own)).withColumn("q", F.sum(seen).over(own))
        if done is None:
            left = F.lit(SYMBOLS) - F.col("q")
            below = F.when(left > 0, -F.log10(left.cast("double"))).otherwise(F.lit(0.0))
            empty = F.lit(-float(np.log10(SYMBOLS)))
        else:
            rows = rows.withColumn("e", F.sum(F.when(F.col("c") > 0, F.col("c1")).otherwise(0)).over(own))
            q = F.col("q1") - F.col("q")
            room = (F.col("t1") - F.col("e") + q).cast("double")
            below = (F.when(F.col("c1") > 0, F.log10(F.col("c1") / room))
                     .when(q > 0, F.log10(q / room) + F.col("g1")).otherwise(F.col("g1")))
            empty = F.col("f1")
        whole = (F.col("t") + F.col("q")).cast("double")
        rows = rows.withColumn("g", F.when(F.col("c") > 0, F.lit(0.0)).otherwise(below))
        rows = rows.withColumn("f", F.when(F.col("t") == 0, empty).when(F.col("c") > 0, F.log10(F.col("c") / whole))
                               .otherwise(F.log10(F.col("q") / whole) + F.col("g")))
        done = rows.select("key", "c", "t", "q", "f", "g")
        if k < ORDER:
            done = materialise(done, "ppm-node", **_DELTAS)
            discard([*used, *source])
            used = [done]
    return done.select("key", F.col("f").alias("value")), used


def _nullable(kind: pa.DataType) -> pa.DataType:
    if pa.types.is_struct(kind):
        return pa.struct([pa.field(f.name, _nullable(f.type)) for f in kind])
    if pa.types.is_list(kind):
        return pa.list_(_nullable(kind.value_type))
    return kind


def _score(key, docs: pa.Table, values: pa.Table) -> pa.Table:
    values = values.combine_chunks()
    keys = values.column("key").to_numpy().view(np.uint64)
    order = np.argsort(keys)
    keys, value = keys[order], values.column("value").to_numpy()[order]
    rec, codes, found, per, used = [], [], [], [], []
    blobs = docs.column("blob")

    def total(x, per):
        s, ends = np.concatenate(([0.0], np.cumsum(x))), np.cumsum(per)
        return s[ends] - s[ends - per]

    for blob in blobs:
        rows = _rows(blob.as_py())
        data, train = texts(rows.column("text")), rows.column("train").to_numpy()
        rec += [c.cast(_nullable(c.type)) for c in rows.column("rec").chunks]
        k, n = events(data)
        codes.append(total(value[np.searchsorted(keys, k)], n))
        k, n = word_keys(data)
        found.append(k)
        per.append(n)
        used.append(np.repeat(train, n))
    # Words of this chunk only have not come back: their count is here.
    per = np.concatenate(per)
    word, back = np.unique(np.concatenate(found), return_inverse=True)
    count = np.bincount(back, weights=np.concatenate(used), minlength=len(word))
    if len(word):
        at = np.minimum(np.searchsorted(keys, word), len(keys) - 1)
        count = np.where(keys[at] == word, value[at], count)
    return pa.table({"rec": pa.chunked_array(rec), "score": np.concatenate(codes), "log_words": total(np.log10(count + 1)[back], per),
                     "n_words": per, "known_words": total(count[back] > 0, per).astype(np.int64)})


def score(docs: DataFrame, train: Column, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep`` only, so that texts need not travel
    twice) with ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and
    ``score`` (log10 probability of the text and its end)."""
    kept = docs.columns if keep is None else keep
    rows = docs.select(record(docs, keep=kept), F.coalesce(F.col(text), F.lit("")).alias("text"),
                       F.coalesce(train, F.lit(False)).alias("train"))
    rec = rows.schema["rec"].dataType.simpleString()
    rows = materialise(rows.mapInArrow(_chunks, "chunk bigint, blob binary"), "ppm-rows")
    sent = materialise(rows.mapInArrow(_emit, "chunk bigint, key bigint, n bigint"), "ppm-events", **_DELTAS)
    counts = materialise(sent.groupBy("key").agg(F.sum("n").alias("n"), F.count("*").alias("senders")), "ppm-counts", **_DELTAS)
    is_word = F.col("key") >= int(_WORD)
    w = counts.where(is_word & (F.col("n") > 0)).agg(
        F.sum("n").alias("n"), F.count("*").alias("v"), F.sum(F.when(F.col("key") == int(_END), F.col("n"))).alias("ends")).first()
    total, distinct, ends = w["n"] or 0, w["v"], w["ends"] or 0
    codes, used = _levels(counts.where(~is_word))
    values = codes.union(
        # A word of one chunk is counted there again instead of sent back.
        counts.where(is_word & (F.col("senders") > 1)).select("key", F.col("n").cast("double").alias("value")))
    back = materialise(sent.select("chunk", "key").join(values, "key"), "ppm-back")
    discard([sent, counts, *used])
    got = (rows.groupBy("chunk").cogroup(back.groupBy("chunk"))
           .applyInArrow(_score, f"rec {rec}, score double, log_words double, n_words bigint, known_words bigint"))
    n = F.col("n_words") + 1
    return got.select(*unpack(kept, {
        "n_tokens": n, "n_known": F.col("known_words") + (1 if ends else 0),
        "train_tokens": F.lit(total).cast("bigint"),
        "base_score": F.col("log_words") + float(np.log10(ends + 1)) - n * float(np.log10(total + distinct + 1)),
        "score": F.col("score")}))


def op4_partial_matching(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held = fold("doc_id") % 7 == 2
    return score(docs, ~held, keep=["doc_id"]).select("doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens",
                                     "base_score", "score")
