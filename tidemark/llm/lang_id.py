"""Language identification with bit-sliced Bloom filters over n-grams.

Learning counts the byte 4-grams of every labelled training text (letters
lower-cased, everything that is not a letter made one blank) per language, over
all rows, pre-aggregated in the tasks.  A language's filter holds its n-grams
with at least ``min_share`` of all its n-gram places; hence at most
``1 / min_share`` of them, whatever the corpus.  The filters are bit-sliced:
row ``i`` of one shared table holds bit ``i`` of every language's filter, so
``k`` look-ups and a bitwise AND give the set of all languages that contain an
n-gram.  A text's popcount per language is corrected for the filter's
false-positive rate ``f``: ``(hits - n f) / (1 - f)``.  The largest corrected
count decides; its share of the text's n-grams is the score.

Edge cases: a null text, or one without a letter, is ``und`` with score 0; rows
without language are not learned from; with nothing learned every row is
``und``; no hit at all gives the language with most training texts, score 0;
ties go to the smallest language name.  An empty table gives no row; a very long
text counts all its n-grams; a caller's column named like an output is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import K1, K2, U64, blocks, fold, mix, record, table, texts, unpack, write_arrow

N = 4
#: An n-gram enters a language's filter from this share of its n-gram places.
MIN_SHARE = 1e-5
HASHES = 3
#: Table rows per n-gram that a language can hold at most.
ROWS_PER_GRAM = 8

_BLANK = np.arange(256, dtype=np.uint8)
_BLANK[:128] = 32
_BLANK[65:91] = np.arange(97, 123)
_BLANK[97:123] = np.arange(97, 123)

_COUNTS = pa.schema([("lang", pa.string()), ("gram", pa.int64()), ("n", pa.int64())])


def grams(values: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """4-grams (as integers) of all rows, and their number per row.  Rows are
    surrounded by blanks; places with blanks only or two blanks in front count not."""
    gap = b" " * N
    data = _BLANK[np.frombuffer(gap + gap.join(values) + gap, np.uint8)].astype(np.uint32)
    size = len(data) - N + 1
    g = np.zeros(size, np.uint32)
    for i in range(N):
        g = (g << np.uint32(8)) | data[i:i + size]
    begins = np.concatenate(([0], np.cumsum([len(v) + N for v in values])))
    keep = np.flatnonzero((g >> np.uint32(16) != 0x2020) & (g & np.uint32(0xFFFF) != 0x2020))
    per = np.diff(np.searchsorted(keep, begins))
    return g[keep][: per.sum()], per


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values, langs = texts(batch.column("text")), batch.column("lang").to_pylist()
        for name in sorted(set(langs)):
            mine = [v for v, x in zip(values, langs) if x == name]
            for a, b in blocks(mine):
                found, n = np.unique(grams(mine[a:b])[0], return_counts=True)
                yield write_arrow(_COUNTS, lang=[name] * len(found), gram=found.astype(np.int64), n=n)


class Model:
    """Languages, the bit-sliced table and each filter's false-positive rate."""

    def __init__(self, langs: list[str], default: int, grams_of: list[np.ndarray], rows: int):
        self.langs, self.default, self.mask = langs, default, U64(rows - 1)
        self.lanes = max(1, -(-len(langs) // 64))
        self.bits = np.zeros((self.lanes, rows), U64)
        self.rate = np.zeros(len(langs))
        for i, g in enumerate(grams_of):
            for at in self.places(g):
                self.bits[i // 64][at] |= U64(1) << U64(i % 64)
            fill = np.count_nonzero(self.bits[i // 64] >> U64(i % 64) & U64(1)) / rows
            self.rate[i] = min(fill ** HASHES, 0.99)

    def places(self, g: np.ndarray) -> list[np.ndarray]:
        h = mix(g.astype(U64) * K1 + K2)
        step = (h >> U64(40)) | U64(1)
        return [((h + U64(i) * step) & self.mask).astype(np.int64) for i in range(HASHES)]

    def predict(self, values: list[bytes]) -> tuple[list[str], np.ndarray]:
        if not self.langs:
            return ["und"] * len(values), np.zeros(len(values))
        g, per = grams(values)
        at = self.places(g)
        ends = np.concatenate(([0], np.cumsum(per)))
        hits = np.zeros((len(self.langs), len(values)))
        for lane in range(self.lanes):
            found = self.bits[lane][at[0]]
            for a in at[1:]:
                found &= self.bits[lane][a]
            for i in range(lane * 64, min(len(self.langs), lane * 64 + 64)):
                one = np.concatenate(([0], np.cumsum(found >> U64(i % 64) & U64(1))))
                hits[i] = np.diff(one[ends].astype(np.float64))
        rate = self.rate[:, None]
        fixed = np.maximum(0, (hits - per * rate) / (1 - rate))
        best = fixed.argmax(0)
        top = fixed.max(0)
        best[top <= 0] = self.default
        score = np.clip(top / np.maximum(per, 1), 0, 1)
        names = [self.langs[b] for b in best]
        for i, v in enumerate(values):
            if not _has_letter(v):
                names[i], score[i] = "und", 0.0
        return names, score


_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[65:91] = _ASCII_LETTER[97:123] = True


def _has_letter(v: bytes) -> bool:
    if _ASCII_LETTER[np.frombuffer(v, np.uint8)].any():
        return True
    return any(c.isalpha() for c in v.decode("utf-8", "ignore"))


def learn(train: DataFrame, text: str = "text", lang: str = "lang",
          min_share: float = MIN_SHARE) -> Model:
    """Filters of every language in ``train``.  What reaches the driver is at
    most ``1 / min_share`` n-grams a language, never more with more rows."""
    rows = train.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")
                        ).where("lang is not null and text is not null")
    seen = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    counts = (rows.mapInArrow(_count, "lang string, gram bigint, n bigint")
              .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    # The language totals come from the same shuffled counts: n-grams split the
    # load, so one language with most rows is no hot group.
    total = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    kept = (counts.join(F.broadcast(total), "lang")  # a row a language
            .where(F.col("n") >= F.col("total") * F.lit(min_share)).select("lang", "gram"))
    found = kept.toPandas()
    langs = sorted(seen)
    grams_of = [found.loc[found["lang"] == x, "gram"].to_numpy(np.uint32) for x in langs]
    rows_n = 1 << int(np.ceil(np.log2(ROWS_PER_GRAM / min_share)))
    default = max(range(len(langs)), key=lambda i: (seen[langs[i]], -i), default=0)
    return Model(langs, default, grams_of, rows_n)


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``.  The model is broadcast: its
    size is fixed by ``min_share`` (8 MB a 64 languages at 1e-5)."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(model)
    rec = docs.select(record(docs), F.col(text).alias("text"))
    fields = rec.schema["rec"].dataType

    def run(batches):
        m = sent.value
        for batch in batches:
            values = texts(batch.column("text"))
            names, scores = [], []
            for a, b in blocks(values):
                n, s = m.predict(values[a:b])
                names += n
                scores.append(s)
            yield pa.RecordBatch.from_arrays(
                [batch.column("rec"), pa.array(names, pa.string()),
                 pa.array(np.concatenate(scores) if scores else np.zeros(0), pa.float64())],
                names=["rec", "lang_pred", "score"])

    out = rec.mapInArrow(run, f"rec {fields.simpleString()}, lang_pred string, score double")
    return out.select(*unpack(docs.columns, {"lang_pred": F.col("lang_pred"), "score": F.col("score")}))


def held_out(doc_id: str | Column = "doc_id") -> Column:
    return fold(doc_id) % 4 == 2


def op5_language_filters(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = learn(docs.where(~held_out()))
    slim = docs.select("doc_id", "text")
    return identify(slim, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
