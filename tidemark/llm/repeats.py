"""Removal of repeated byte strings by bucket-pointer refinement.

A byte is removed where it is covered by a string of ``length`` bytes that also
starts anywhere else in the table, the same text included; matches never cross
texts.  The method is bucket-pointer refinement of the suffixes' leading bytes:

* **Initial buckets.**  Every position gets the name (bucket) of the ``q``-gram
  that starts there.  Only *anchors* enter the shuffle: of each window of
  ``length`` bytes the first smallest ``q``-gram name.  Equal windows have
  equal anchors at equal distances, so equal windows always share a bucket.
* **Refinement by later offsets.**  The name of ``2h`` bytes at ``p`` is made
  from the names of ``h`` bytes at ``p`` and ``p + h``; each level's names are
  reused by the next.  An anchor's bucket is refined by the names of the first
  and the last window that it stands for: together they fix all bytes of its
  extent.  Two members in one refined bucket settle all windows of both at once.
* **Recursion.**  Buckets that the extents split are refined again, one
  representative per refined bucket (all members of it would give the same
  names), so copies are never expanded: first by cells of neighbouring windows
  (named by the bytes that all windows of the cell share, then by the cell's
  extent), and where a cell splits once more, by every single window.

Names are 64-bit fingerprints rather than ranks, since only equality counts;
a comparison always rests on two of them (128 bits).  Grouping is by hash
aggregation with partial sums and by splittable equi-joins, so a string shared
by a third of all rows is no hot task.  Texts are keyed by a 128-bit digest:
rows with one text share one result and nothing needs a row number.

Edge cases: null is empty; texts shorter than ``length`` lose nothing; repeated
rows are each other's copies, so they lose every byte (if long enough).  Very
long texts are cut into overlapping pieces (``PIECE`` windows), no window lost.  An
empty table gives no row; a caller's column named like an output is replaced by it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import (K1, K2, SPACES, U64, blocks, byte_class, discard, joined, materialise, mix,
                                 named, record, table, texts, unpack)

LENGTH = 400
#: The query tells of repeated strings of more words than this, too.
PASSAGE_WORDS = 50
#: Window starts handled at a time.
PIECE = 1 << 18
#: Bytes that a word needs one of: letters and digits of ASCII, and all beyond ASCII.
_LETTERS = ~byte_class("".join(chr(i) for i in range(128) if not chr(i).isalnum()))

_NAME_OF_BYTE = (np.arange(1, 257, dtype=U64) * U64(0xD6E8FEB86659FD93)) ^ (
    np.arange(1, 257, dtype=U64) * K1 >> U64(31))


def _refine(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Names of joint strings from the names of their halves."""
    x = left ^ (left >> U64(29))
    x *= K1
    x += right
    x ^= x >> U64(32)
    x *= K2
    return x


def gram_size(length: int) -> int:
    return 1 << max(0, length.bit_length() - 3)


def names(data: np.ndarray, lengths: list[int]) -> list[np.ndarray]:
    """For each length, the names of its strings at each position."""
    h, name, levels = 1, _NAME_OF_BYTE[data], {}
    while True:
        for x in lengths:
            if h <= x < 2 * h:
                levels[x] = name if h == x else _refine(name[: max(0, len(data) - x + 1)], name[x - h:])
        if 2 * h > max(lengths):
            return [levels[x] for x in lengths]
        name = _refine(name[:-h], name[h:])
        h *= 2


def names_at(value: bytes, places: list[tuple[int, np.ndarray]]) -> list[np.ndarray]:
    """For each (length, positions) of one text: the names there."""
    data = np.frombuffer(value, np.uint8)
    longest = max(x for x, _ in places)
    out = [np.zeros(len(p), U64) for _, p in places]
    for a in range(0, len(value), PIECE):
        mine = [np.flatnonzero((p >= a) & (p < a + PIECE)) for _, p in places]
        if any(len(m) for m in mine):
            got = names(data[a:a + PIECE + longest - 1], [x for x, _ in places])
            for o, m, g, (_, p) in zip(out, mine, got, places):
                o[m] = g[p[m] - a]
    return out


def anchors(grams: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For windows of ``width`` grams: the positions that are some window's first
    smallest name, and the first and last such window of each."""
    n = len(grams)
    if n < width:
        return (np.zeros(0, np.int64),) * 3
    key = (grams ^ (grams >> U64(32))) * K1
    key &= U64(0xFFFFFFFF00000000)  # half a name, then the place: of equal ones the first
    key |= np.arange(n, dtype=U64)
    h = 1
    while 2 * h <= width:
        key = np.minimum(key[:-h], key[h:])
        h *= 2
    key = np.minimum(key[:n - width + 1], key[width - h:])
    at = (key & U64(0xFFFFFFFF)).astype(np.int64)
    first = np.append(0, np.flatnonzero(np.diff(at)) + 1)
    return at[first], first, np.append(first[1:], len(at)) - 1


def pieces(values: list[bytes], length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of pieces: (bytes, row, offset in the row, begin in the block; one
    more begin than pieces).  Every window lies in exactly one piece."""
    held, rows, offsets, size = [], [], [], 0

    def block():
        begins = np.concatenate(([0], np.cumsum([len(x) for x in held])))
        return (np.frombuffer(b"".join(held), np.uint8), np.array(rows), np.array(offsets), begins)

    for row, v in enumerate(values):
        for offset in range(0, len(v) - length + 1, PIECE):
            part = v[offset:offset + PIECE + length - 1]
            if size and size + len(part) > PIECE + length:
                yield block()
                held, rows, offsets, size = [], [], [], 0
            held.append(part)
            rows.append(row)
            offsets.append(offset)
            size += len(part)
    if held:
        yield block()


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _runs(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last of each run of rows that are equal in all columns."""
    n = len(columns[0])
    new = np.flatnonzero(np.logical_or.reduce([np.append(n > 0, c[1:] != c[:-1])[:n] for c in columns]))
    return new, np.append(new[1:], n)[:len(new)] - 1


_KEYS = ["g", "l0", "l1", "e1", "e2"]


def _anchor_rows(length: int):
    """Anchors with the distances to them from the last and the first window
    that they stand for, and the names of their gram and those windows.  Equal
    anchors in a row, as of a line that repeats, are one row; ``more`` is how
    far the last lies behind the first."""
    width = length - gram_size(length) + 1

    def run(batches):
        for batch in batches:
            values = texts(batch.column("text"))
            r1, r2 = batch.column("r1").to_numpy(), batch.column("r2").to_numpy()
            for data, rows, offsets, begins in pieces(values, length):
                grams, whole = names(data, [gram_size(length), length])
                at, first, last = anchors(grams, width)
                piece = np.searchsorted(begins, at, "right") - 1
                first = np.maximum(first, begins[piece])
                last = np.minimum(last, begins[piece + 1] - length)
                ok = first <= last
                at, first, last, piece = at[ok], first[ok], last[ok], piece[ok]
                new, end = _runs(piece, at - last, at - first, grams[at], whole[first], whole[last])
                more = (at[end] - at[new]).astype(np.int32)
                at, first, last, piece = at[new], first[new], last[new], piece[new]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(r1[rows[piece]]), pa.array(r2[rows[piece]]),
                     pa.array(at - begins[piece] + offsets[piece]),
                     pa.array((at - last).astype(np.int32)), pa.array((at - first).astype(np.int32)),
                     _signed(grams[at]), _signed(whole[first]), _signed(whole[last]), pa.array(more)],
                    names=["r1", "r2", "at", "l0", "l1", "g", "e1", "e2", "more"])
    return run


def _expand(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row number and value of every integer in first..last of each row."""
    count = last - first + 1
    row = np.repeat(np.arange(len(first)), count)
    return row, first[row] + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)


def _each_text(make):
    """Batches of ``make(text, needed members)`` with the text's digest in front."""
    def run(batches):
        seen: set[tuple[int, int]] = set()  # a text that meets a task again gives the same rows
        for batch in batches:
            keys = list(zip(batch.column("r1").to_pylist(), batch.column("r2").to_pylist()))
            for i, key in enumerate(keys):
                if key in seen:
                    continue
                seen.add(key)
                need = batch.column("need").slice(i, 1).flatten()
                out = make(texts(batch.column("text").slice(i, 1))[0],
                           [need.field(k).to_numpy(zero_copy_only=False) for k in range(need.type.num_fields)])
                size = len(out["at"])
                for a in range(0, size, 1 << 16):
                    n = min(size - a, 1 << 16)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(n, key[0])), pa.array(np.full(n, key[1])),
                         *[_signed(x[a:a + n]) if x.dtype == U64 else pa.array(x[a:a + n]) for x in out.values()]],
                        names=["r1", "r2", *out])
    return run


def cell_size(length: int) -> int:
    return max(2, length // 12)


def _cells(length: int):
    """An anchor's windows in cells of equal distances: the name of the bytes
    that all windows of a whole cell have in common, and those of the extent."""
    size = cell_size(length)
    core = length - size + 1

    def make(value, need):
        at, l0, l1, g, single = need
        row, cell = _expand(l0 // size, l1 // size)
        at = at[row]
        lo = np.maximum(l0[row], cell * size)
        hi = np.minimum(l1[row], cell * size + size - 1)
        c, x1, x2 = names_at(value, [(core, at - cell * size), (length, at - hi), (length, at - lo)])
        return {"at": at, "g": g[row], "cell": cell.astype(np.int32), "core": c, "lo": lo.astype(np.int32),
                "hi": hi.astype(np.int32), "x1": x1, "x2": x2, "single": single[row]}
    return make


def _windows(length: int):
    def make(value, need):
        at, lo, hi, g, single = need
        row, dist = _expand(lo, hi)
        at = at[row]
        return {"at": at, "g": g[row], "l": dist.astype(np.int32),
                "w": names_at(value, [(length, at - dist)])[0], "single": single[row]}
    return make


def _digest(text):
    return [F.xxhash64(text).alias("r1"), F.xxhash64(F.lit(7), text).alias("r2")]


def _shared(found: DataFrame, written: DataFrame, name: str) -> DataFrame:
    """The anchors whose bucket has two members (a run, two and more, is ``n`` = 2)
    in place of all, ``written``."""
    twice = found.groupBy("g").agg(F.sum("n").alias("n")).where("n > 1").select("g")
    some = materialise(found.join(twice, "g", "left_semi"), name)
    discard([written])
    return some


def repeated_spans(docs: DataFrame, text: str = "text", length: int = LENGTH) -> DataFrame:
    """(r1, r2, spans): places ``[s, e)`` that repeated strings cover, overlapping
    or not, per text digest; texts without any are left out."""
    if length < 8:
        raise ValueError("length must be 8 bytes or more")
    read = docs.select(*_digest(F.col(text)), F.col(text).alias("text"))
    found = materialise(read.mapInArrow(
        _anchor_rows(length),
        "r1 bigint, r2 bigint, at bigint, l0 int, l1 int, g bigint, e1 bigint, e2 bigint, more int"), "anchors")
    found = _shared(found.withColumn("n", F.when(F.col("more") > 0, 2).otherwise(1)), found, "buckets")
    place = ["r1", "r2", "at"]

    def split(rows, bucket, extent):
        """Refined buckets of all buckets that have two members: whether one has
        two itself (``settled``), into how many its bucket split, and a representative."""
        parts = (rows.groupBy(*bucket, *extent)
                 .agg(*[F.first(c).alias(f"p_{c}") for c in place], F.sum("n").alias("n"))  # of one row
                 .withColumn("settled", F.col("n") > 1))
        whole = (parts.groupBy(*bucket)
                 .agg(F.count("*").alias("parts"), F.sum("n").alias("members"))
                 .where("members > 1").select(*bucket, "parts"))
        return materialise(parts.join(whole, bucket), "refined")

    def needed(parts, fields):
        reps = parts.where("parts > 1").select(*[F.col(f"p_{c}").alias(c) for c in place], *fields, "g", (~F.col("settled")).alias("single"))
        need = reps.groupBy("r1", "r2").agg(F.collect_list(F.struct("at", *fields, "g", "single")).alias("need"))
        return read.join(need, ["r1", "r2"])

    # First refinement: by the extents of the anchors.
    parts = coarse = split(found, ["g"], ["l0", "l1", "e1", "e2"])
    whole = (found.join(parts.where("settled").select(*_KEYS), _KEYS, "left_semi")
             .select("r1", "r2", (F.col("at") - F.col("l1")).alias("s"), (F.col("at") + F.col("more") - F.col("l0") + length).alias("e"))
             .distinct())
    # Second: by cells of windows; third: by single windows.
    cells = materialise(needed(parts, ["l0", "l1"]).mapInArrow(
        _each_text(_cells(length)), "r1 bigint, r2 bigint, at bigint, g bigint, cell int, core bigint, lo int, "
                                    "hi int, x1 bigint, x2 bigint, single boolean"), "cells")
    bucket, extent = ["g", "cell", "core"], ["lo", "hi", "x1", "x2"]
    parts = split(cells.withColumn("n", F.when(F.col("single"), 1).otherwise(2)), bucket, extent)
    some = (cells.where("single").join(parts.where("settled").select(*bucket, *extent), bucket + extent, "left_semi")
            .select("r1", "r2", (F.col("at") - F.col("hi")).alias("s"), (F.col("at") - F.col("lo") + length).alias("e")))
    windows = materialise(needed(parts, ["lo", "hi"]).mapInArrow(
        _each_text(_windows(length)), "r1 bigint, r2 bigint, at bigint, g bigint, l int, w bigint, single boolean"),
        "windows")
    twice = (windows.groupBy("g", "l", "w")
             .agg(*[(F.min(c) != F.max(c)).alias(f"d_{c}") for c in place])
             .where("d_r1 or d_r2 or d_at").select("g", "l", "w"))
    single = (windows.where("single").join(twice, ["g", "l", "w"], "left_semi")
              .select("r1", "r2", (F.col("at") - F.col("l")).alias("s"),
                      (F.col("at") - F.col("l") + length).alias("e")))
    spans = materialise(whole.unionByName(some).unionByName(single).groupBy("r1", "r2")
                        .agg(F.collect_list(F.struct("s", "e")).alias("spans")), "spans")
    discard([found, coarse, cells, parts, windows])
    return spans


def word_places(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each word: what stands between blanks and has a letter
    or digit, without the marks at its two ends."""
    edge = np.flatnonzero(np.diff(np.concatenate(([False], _LETTERS[data], [False])).view(np.int8)))
    begin, end = edge[::2], edge[1::2]
    if not len(begin):
        return begin, end
    blanks = np.cumsum(SPACES[data], dtype=np.int32)
    new = blanks[begin[1:]] > blanks[end[:-1] - 1]  # letters with no blank between are one word's
    return begin[np.append(True, new)], end[np.append(new, True)]


def _word_names(data: np.ndarray, begin: np.ndarray, end: np.ndarray, count: int):
    """Names of the words, and a function that names the strings of ``count``
    words that begin at given ones, from the first word's begin to the last one's end."""
    word = named(data, begin, end)
    name, h, rest = None, 1, count - 1
    if rest:
        name = _refine(word[:-1], named(data, end[:-1], begin[1:]))  # a word and what parts it from the next
        while 2 * h <= rest:
            name = _refine(name[:-h], name[h:])
            h *= 2

    def whole(at):
        return _refine(_refine(name[at], name[at + rest - h]), word[at + rest]) if rest else word[at]
    return word, whole


def _word_anchors(count: int):
    """As ``_anchor_rows`` with words for bytes: the name of an anchor's words,
    that of its extent (the strings of ``count`` words that it stands for), and
    the extent's place.  Equal anchors in a row, as of a line that repeats, are
    one row with the first one's end and the last one's."""
    size = 1 << max(0, (count // 3).bit_length() - 1)
    width = count - size + 1

    def run(batches):
        for batch in batches:
            values = texts(batch.column("text"))
            r1, r2 = batch.column("r1").to_numpy(), batch.column("r2").to_numpy()
            for x, y in blocks(values):
                data, edges = joined(values[x:y])
                begin, end = word_places(data)
                if len(begin) < count:
                    continue
                word, whole = _word_names(data, begin, end, count)
                name, h = word, 1
                while h < size:
                    name = _refine(name[:-h], name[h:])
                    h *= 2
                at, first, last = anchors(name, width)
                lines = np.searchsorted(begin, edges)  # words before each row
                row = np.searchsorted(lines, at, "right") - 1
                first = np.maximum(first, lines[row])
                last = np.minimum(last, lines[row + 1] - count)
                ok = first <= last
                at, first, last, row = at[ok], first[ok], last[ok], row[ok]
                extent = _refine(_refine(whole(first), whole(last)), (at - last << 32 | at - first).astype(U64))
                g, s, e = name[at], begin[first] - edges[row], end[last + count - 1] - edges[row]
                new, behind = _runs(row, g, extent, *[begin[first]] * (count == 1))  # no blanks between
                yield pa.RecordBatch.from_arrays(
                    [pa.array(r1[x + row[new]]), pa.array(r2[x + row[new]]), _signed(g[new]), _signed(extent[new]),
                     pa.array(s[new].astype(np.int32)), pa.array(e[new].astype(np.int32)),
                     pa.array(e[behind].astype(np.int32))],
                    names=["r1", "r2", "g", "k", "s", "one", "e"])
    return run


def _word_windows(count: int):
    """Every string of ``count`` words of the needed extents, of many texts at a time."""
    def run(batches):
        seen: set[tuple[int, int]] = set()  # a text that meets a task again gives the same rows
        for batch in batches:
            new = []
            for i, key in enumerate(zip(batch.column("r1").to_pylist(), batch.column("r2").to_pylist())):
                if key not in seen:
                    seen.add(key)
                    new.append(i)
            if not new:
                continue
            batch = batch.take(pa.array(new))
            values, lists = texts(batch.column("text")), batch.column("need")
            for x, y in blocks(values):
                data, edges = joined(values[x:y])
                begin, end = word_places(data)
                _, whole = _word_names(data, begin, end, count)
                text = np.repeat(np.arange(y - x), lists.slice(x, y - x).value_lengths().to_numpy())
                need = lists.slice(x, y - x).flatten()
                s, one, g, single = (need.field(k).to_numpy(zero_copy_only=False) for k in range(4))
                row, at = _expand(np.searchsorted(begin, edges[text] + s),
                                  np.searchsorted(end, edges[text] + one) - count + 1)
                text = text[row]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("r1").take(pa.array(x + text)), batch.column("r2").take(pa.array(x + text)),
                     pa.array((begin[at] - edges[text]).astype(np.int32)),
                     pa.array((end[at + count - 1] - edges[text]).astype(np.int32)),
                     pa.array(g[row]), _signed(whole(at)), pa.array(single[row])],
                    names=["r1", "r2", "s", "e", "g", "w", "single"])
    return run


def repeated_words(docs: DataFrame, text: str, over: int) -> DataFrame:
    """As ``repeated_spans``, of the strings of more than ``over`` words, whatever
    their bytes: anchors are groups of words, refined by the names of their
    extents, and buckets that those split by every string of ``over + 1`` words,
    one representative per refined bucket."""
    read = docs.select(*_digest(F.col(text)), F.col(text).alias("text"))
    found = materialise(read.mapInArrow(
        _word_anchors(over + 1), "r1 bigint, r2 bigint, g bigint, k bigint, s int, one int, e int"),
        "word-anchors")
    found = _shared(found.withColumn("n", F.when(F.col("e") > F.col("one"), 2).otherwise(1)), found, "word-buckets")
    parts = materialise(found.groupBy("g", "k").agg(*[F.first(c).alias(c) for c in ("r1", "r2", "s", "one")],  # of one row
                                                   F.sum("n").alias("n")), "word-parts")
    split = parts.groupBy("g").agg(F.count("*").alias("parts")).where("parts > 1").select("g")
    need = (parts.join(split, "g", "left_semi").groupBy("r1", "r2")
            .agg(F.collect_list(F.struct("s", "one", "g", (F.col("n") == 1).alias("single"))).alias("need")))
    windows = materialise(read.join(need, ["r1", "r2"]).mapInArrow(
        _word_windows(over + 1), "r1 bigint, r2 bigint, s int, e int, g bigint, w bigint, single boolean"),
        "word-windows")
    whole = (found.join(parts.where("n > 1").select("g", "k"), ["g", "k"], "left_semi")
             .select("r1", "r2", "s", "e").distinct())
    again = (windows.groupBy("g", "w").agg(F.sum(F.when(F.col("single"), 1).otherwise(2)).alias("n"))
             .where("n > 1").select("g", "w"))
    single = windows.where("single").join(again, ["g", "w"], "left_semi").select("r1", "r2", "s", "e")
    place = F.struct(F.col("s").cast("bigint").alias("s"), F.col("e").cast("bigint").alias("e"))
    spans = materialise(whole.unionByName(single).groupBy("r1", "r2").agg(F.collect_list(place).alias("spans")),
                        "word-spans")
    discard([found, parts, windows])
    return spans


def _covered(places: pa.Array, size: int) -> np.ndarray:
    """Which bytes of a text some span covers."""
    edge = np.zeros(size + 1, np.int32)
    np.add.at(edge, places.field(0).to_numpy(), 1)
    np.add.at(edge, places.field(1).to_numpy(), -1)
    return np.cumsum(edge[:-1]) > 0


def _cut(batches, whole_characters: bool):
    for batch in batches:
        values = texts(batch.column("text"))
        passages = [0 if p.values is None or not len(p.values) else int(_covered(p.values, len(v)).sum())
                    for v, p in zip(values, batch.column("passages"))]
        kept, removed, runs = [], [], []
        for v, spans in zip(values, batch.column("spans")):
            places = spans.values
            if places is None or not len(places):
                kept.append(v)
                removed.append(0)
                runs.append([])
                continue
            hit = _covered(places, len(v))
            if whole_characters:
                lead = np.flatnonzero((np.frombuffer(v, np.uint8) & 0xC0) != 0x80)
                lead = np.union1d(lead, [0])
                hit = np.repeat(np.logical_or.reduceat(hit, lead), np.diff(np.append(lead, len(v))))
            turn = np.flatnonzero(np.diff(np.concatenate(([False], hit, [False])).astype(np.int8)))
            kept.append(np.frombuffer(v, np.uint8)[~hit].tobytes())
            removed.append(int(hit.sum()))
            runs.append([{"start": int(a), "stop": int(b)} for a, b in zip(turn[::2], turn[1::2])])
        yield pa.RecordBatch.from_arrays(
            [batch.column("rec"), pa.array([len(v) for v in values], pa.int64()),
             pa.array(removed, pa.int64()),
             pa.array(runs, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
             pa.array(kept, pa.binary()), pa.array(passages, pa.int64())],
            names=["rec", "n_bytes", "n_removed", "removed", "kept", "n_passage"])


def remove_repeats(docs: DataFrame, text: str = "text", length: int = LENGTH, keep: list[str] | None = None,
                   whole_characters: bool = False, over_words: int | None = None,
                   tell_words: int | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep`` only, so that texts need not travel
    twice) with ``n_bytes``, ``n_removed``, ``removed`` (maximal runs, an array of
    start and stop) and ``kept`` (the remaining bytes).  With
    ``whole_characters`` a character that a run cuts in two goes as a whole.
    With ``over_words`` repeated strings of more words than that go too, though
    they have fewer bytes than ``length``.  With ``tell_words`` a column
    ``n_passage`` says how many bytes lie in repeated strings of more words than
    that, which stay (a passage of short words has fewer bytes than ``length``)."""
    spans = repeated_spans(docs, text, length)
    told = None
    if tell_words is not None:
        told = repeated_words(docs, text, tell_words).withColumnRenamed("spans", "passages")
    if over_words is not None:
        both = spans.unionByName(repeated_words(docs, text, over_words))
        spans = both.groupBy("r1", "r2").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    names = docs.columns if keep is None else keep
    rows = docs.select(record(docs, keep=names), F.col(text).alias("text"), *_digest(F.col(text)))
    rec = rows.schema["rec"].dataType.simpleString()
    none = F.lit(None).cast("array<struct<s:bigint,e:bigint>>").alias("passages")
    if told is not None:  # one row a text on either side: the texts are dealt once
        spans, none = spans.join(told, ["r1", "r2"], "full_outer"), F.col("passages")
    cut = (rows.join(spans, ["r1", "r2"], "left").select("rec", "text", "spans", none)
           .mapInArrow(lambda batches: _cut(batches, whole_characters), f"rec {rec}, n_bytes bigint, n_removed bigint, "
                             "removed array<struct<start:bigint,stop:bigint>>, kept binary, n_passage bigint"))
    outs = {c: F.col(c) for c in ("n_bytes", "n_removed", "removed", "kept")
            + (("n_passage",) if tell_words is not None else ())}
    return cut.select(*unpack(names, outs))


def op2_bucket_pointers(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    cut = remove_repeats(docs, keep=["doc_id"], tell_words=PASSAGE_WORDS)
    return cut.select("doc_id", "n_bytes", "n_removed", F.size("removed").cast("bigint").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"), "n_passage")
