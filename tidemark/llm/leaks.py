"""Benchmark decontamination: gapped word-pair seeds, then Smith-Waterman alignment.

A leak is a document's alignment with an item (Smith-Waterman on words, match
2, mismatch and gap -1) that scores ``MIN_SCORE`` of the item's best or more.
The seeds miss none of them: with m matches, x edits and n words in the item,
2m - x >= 2sn for a score of s.  So of the m - 1 pairs of consecutive matches at
most x / 2 <= m - sn have two or more edits between them, and ``ceil(sn) - 1`` or
more have one edit or none: words that are one or two apart in the item and in
the document.  These ordered pairs are the seeds.  An item of which no pair need
be left (two words at 0.5) is looked up by its single words.

Of an item's seeds the commonest of the benchmark go, half as many as must be
hit; the rest must still be hit as often as that leaves, on diagonals no farther
apart than the alignment's gaps allow, before anything is aligned.  What is found
in a document depends on nothing else in the corpus.

The benchmark is taken in blocks of ``BLOCK`` bytes of text, each broadcast and
scanned for by itself; so what is sent never grows with the benchmark.  No
document text is shuffled.

Edge cases: null and empty texts and items match nothing; repeated items give a
row each; repeated documents too.  An empty table on either side gives no leak;
of a very long text only the regions around seeds are aligned; a caller's column
named like an output is replaced by it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import K2, blocks, byte_class, mix, record, table, texts, unpack, words

#: Share of the item's best alignment score that makes a leak.
MIN_SCORE = 0.5
BLOCK = 8 << 20
#: Seed hits that one numpy step works on.
HITS = 1 << 21
#: Everything that is not a letter or digit of ASCII, or beyond ASCII, separates words.
_SEPARATORS = byte_class("".join(chr(i) for i in range(128) if not chr(i).isalnum()))

MATCH, OTHER, GAP = 2, -1, -1


def pairs(ids: np.ndarray, per: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of the pairs of words one and two apart in a row, and the word
    that each pair begins at."""
    left = np.repeat(np.cumsum(per), per) - np.arange(len(ids))
    head = mix(ids) * K2
    one, two = np.flatnonzero(left > 1), np.flatnonzero(left > 2)
    at = np.concatenate((one, two))
    return mix(head[at] + ids[np.concatenate((one + 1, two + 2))]), at


def align(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """Best local alignment score of word ids ``a`` (the item) in ``b`` and
    where in ``b`` it ends (one past).  A row at a time; gaps along the row by a
    running maximum."""
    ramp = np.arange(len(b) + 1) * -GAP
    row = np.zeros(len(b) + 1, np.int64)
    best, where = 0, 0
    for x in a:
        step = np.where(b == x, MATCH, OTHER)
        new = np.maximum(row + GAP, 0)
        new[1:] = np.maximum(new[1:], row[:-1] + step)
        new = np.maximum.accumulate(new + ramp) - ramp
        i = int(new.argmax())
        if new[i] > best:
            best, where = int(new[i]), i
        row = new
    return best, where


class Items:
    """A block of the benchmark: item ids, words and seeds sorted by name and item."""

    def __init__(self, ids: list, values: list[bytes], min_score: float = MIN_SCORE, whole_below: int = 0):
        self.ids = ids
        self.words, self.per, _ = words(values, _SEPARATORS)
        self.begins = np.concatenate(([0], np.cumsum(self.per)))
        # Least score, seeds that it leaves, and words that its gaps can shift it by.
        share = np.where(self.per < whole_below, 1.0, min_score)
        self.least = np.maximum(1, np.ceil(2 * share * self.per - 1e-9)).astype(np.int64)
        left = (self.least + 1) // 2 - 1
        self.shift = np.maximum(0, 2 * self.per - self.least)
        row = np.repeat(np.arange(len(self.per)), self.per)
        single = (left < 1)[row]
        name, at = pairs(self.words, self.per)
        pair = ~single[at]
        name, at = name[pair], at[pair]
        self.pairs = self._sorted(name, row[at], at, np.maximum(left, 0) // 2)
        at = np.flatnonzero(single)
        self.singles = self._sorted(self.words[at], row[at], at, np.zeros(len(self.per), np.int64))
        self.hits = np.maximum(1, left - np.maximum(left, 0) // 2)

    def _sorted(self, name, item, at, drop):
        """(distinct names, rank and item as one key, place in the item) of the
        seeds but the ``drop`` commonest of each item."""
        _, back, count = np.unique(name, return_inverse=True, return_counts=True)
        order = np.lexsort((-count[back], item))
        rank = np.arange(len(order)) - np.searchsorted(item[order], item[order])
        keep = order[rank >= drop[item[order]]]
        names, back = np.unique(name[keep], return_inverse=True)
        key = back * len(self.per) + item[keep]
        order = np.argsort(key, kind="stable")
        return names, key[order], (at - self.begins[item])[keep][order]

    def _hits(self, seeds, name, word, row, first: int, last: int):
        """Pieces of at most ``HITS`` hits, or one item of one row: (row, item, diagonal)."""
        names, key, at = seeds
        if not len(names) or not len(name):
            return
        low = np.searchsorted(names, name)
        ok = np.flatnonzero(names[np.minimum(low, len(names) - 1)] == name)
        ok = ok[np.argsort(row[ok], kind="stable")]
        rank, word, row = low[ok], word[ok], row[ok]
        todo = [(0, len(ok), first, last)]
        while todo:
            a, b, i, j = todo.pop()
            begin = np.searchsorted(key, rank[a:b] * len(self.per) + i)
            count = np.searchsorted(key, rank[a:b] * len(self.per) + j) - begin
            total = int(count.sum())
            if total > HITS and row[a] != row[b - 1]:  # between two rows
                cut = int(np.searchsorted(row[a:b], row[(a + b) // 2]))
                cut = a + (cut or int(np.searchsorted(row[a:b], row[a], "right")))
                todo += [(cut, b, i, j), (a, cut, i, j)]
            elif total > HITS and j - i > 1:
                todo += [(a, b, (i + j) // 2, j), (a, b, i, (i + j) // 2)]
            elif total:
                seed = np.repeat(begin, count) + np.arange(total) - np.repeat(np.cumsum(count) - count, count)
                yield np.repeat(row[a:b], count), key[seed] % len(self.per), np.repeat(word[a:b], count) - at[seed]

    def regions(self, ids: np.ndarray, per: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(row, item, begin, end) of the words that every leak of the rows lies in."""
        row = np.repeat(np.arange(len(per)), per)
        ends = np.cumsum(per)
        found = []
        name, at = pairs(ids, per)
        for seeds, n, w in ((self.pairs, name, at), (self.singles, ids, np.arange(len(ids)))):
            for r, item, diagonal in self._hits(seeds, n, w, row[w], 0, len(self.per)):
                order = np.lexsort((diagonal, item, r))
                r, item, diagonal = r[order], item[order], diagonal[order]
                i = np.arange(len(r))
                j = i + self.hits[item] - 1
                ok = j < len(r)
                i, j = i[ok], j[ok]
                ok = (r[i] == r[j]) & (item[i] == item[j]) & (diagonal[j] - diagonal[i] <= self.shift[item[i]])
                i, j = i[ok], j[ok]
                r, item, shift = r[i], item[i], self.shift[item[i]]
                begin = np.maximum(diagonal[j] - shift, (ends - per)[r])
                end = np.minimum(diagonal[i] + shift + self.per[item], ends[r])
                # Begins and ends both rise within a row and item: overlapping ones are one region.
                new = np.ones(len(r), bool)
                new[1:] = (r[1:] != r[:-1]) | (item[1:] != item[:-1]) | (begin[1:] > end[:-1])
                f = np.flatnonzero(new)
                l = np.append(f[1:], len(r)) - 1 if len(f) else f
                found.append(np.stack((r[f], item[f], begin[f], end[l])))
        for r, item, begin, end in np.concatenate(found, 1).T.tolist() if found else ():
            yield r, item, begin, end

    def leaks(self, ids: np.ndarray, item: int, begin: int, end: int) -> list[tuple[float, int]]:
        """(score, one past its last word) of the passages in a region: the best
        first, then those left and right of it."""
        own = self.words[self.begins[item]:self.begins[item + 1]]
        out, todo = [], [(begin, end)]
        while todo:
            a, b = todo.pop()
            if MATCH * min(len(own), b - a) < self.least[item]:
                continue
            best, size = align(own, ids[a:b])
            if best < self.least[item]:
                continue
            stop = a + size
            back = max(a, stop - len(own) - int(self.shift[item]))
            start = stop - align(own[::-1], ids[back:stop][::-1])[1]
            out.append((best / (MATCH * len(own)), stop))
            todo += [(a, start), (stop, b)]
        return out


def _leaks(items, clean: bool = False):
    """Leaks of each batch; or, if ``clean``, the records without any."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = items.value
        for batch in batches:
            values = texts(batch.column("text"))
            rows, found = [], []
            for x, y in blocks(values):
                ids, per, _ = words(values[x:y], _SEPARATORS)
                begins = np.cumsum(per) - per
                for r, item, begin, end in b.regions(ids, per):
                    if clean and rows and rows[-1] == x + r:
                        continue
                    for score, stop in b.leaks(ids, item, begin, end):
                        rows.append(x + r)
                        found.append((item, score, stop - int(begins[r])))
            if clean:
                left = np.setdiff1d(np.arange(len(values)), rows)
                yield batch.take(pa.array(left, pa.int64()))
                continue
            yield pa.RecordBatch.from_arrays(
                [batch.column("rec").take(pa.array(rows, pa.int64())),
                 b.names.take(pa.array([f[0] for f in found], pa.int64())),
                 pa.array([f[1] for f in found], pa.float64()), pa.array([f[2] for f in found], pa.int64())],
                names=["rec", "item", "score", "stop"])
    return run


def _blocks(benchmark: DataFrame, text: str, item_id: str, limit: int) -> Iterator[tuple[list, list[bytes]]]:
    ids, values, size = [], [], 0
    for r in benchmark.select(F.col(item_id).alias("i"), F.col(text).alias("t")).toLocalIterator():
        v = (r["t"] or "").encode()
        if size and size + len(v) > limit:
            yield ids, values
            ids, values, size = [], [], 0
        ids.append(r["i"])
        values.append(v)
        size += len(v)
    if ids:
        yield ids, values


def _prepared(rows: DataFrame, benchmark: DataFrame, item_text: str, item_id: str, min_score: float, block: int,
              whole_below: int = 0):
    """Blocks of the benchmark with their seeds, broadcast."""
    sc = rows.sparkSession.sparkContext
    kind = benchmark.schema[item_id].dataType.simpleString()
    for ids, values in _blocks(benchmark, item_text, item_id, block):
        items = Items(ids, values, min_score, whole_below)
        items.names = pa.array(ids, pa.int64() if kind in ("int", "bigint", "smallint") else pa.string())
        yield sc.broadcast(items)


def without_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_text: str = "text",
                  item_id: str = "item_id", min_score: float = MIN_SCORE, block: int = BLOCK,
                  whole_below: int = 0) -> DataFrame:
    """The documents that hold no benchmark passage.  Items of fewer than
    ``whole_below`` words must match whole: half of ``the war`` is no leak."""
    rows = docs.select(record(docs), F.col(text).alias("text"))
    out = rows
    for items in _prepared(rows, benchmark, item_text, item_id, min_score, block, whole_below):
        out = out.mapInArrow(_leaks(items, clean=True), rows.schema)
    return out.select(*unpack(docs.columns, {}))


def find_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_text: str = "text",
               item_id: str = "item_id", min_score: float = MIN_SCORE, block: int = BLOCK) -> DataFrame:
    """A row per document and aligned passage: the document's columns,
    ``item_id``, ``score`` and ``stop`` (word where the passage ends)."""
    rows = docs.select(record(docs), F.col(text).alias("text"))
    rec = rows.schema["rec"].dataType.simpleString()
    kind = benchmark.schema[item_id].dataType
    name = "bigint" if kind.simpleString() in ("int", "bigint", "smallint") else "string"
    out = None
    for items in _prepared(rows, benchmark, item_text, item_id, min_score, block):
        found = rows.mapInArrow(_leaks(items), f"rec {rec}, item {name}, score double, stop bigint")
        out = found if out is None else out.union(found)
    if out is None:
        out = rows.select("rec", F.lit(None).cast(name).alias("item"), F.lit(0.0).alias("score"),
                          F.lit(0).cast("bigint").alias("stop")).where("false")
    return out.select(*unpack(docs.columns, {"item_id": F.col("item"), "score": F.col("score"), "stop": F.col("stop")}))


def op8_seed_and_align(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_leaks(docs, table(spark, sf_dir, "benchmark"))
    return found.groupBy("doc_id", "item_id").agg(F.max("score").alias("score"), F.count("*").alias("passages"))
