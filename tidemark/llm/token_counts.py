"""Edit-aware token counts over segment trees of pre-tokens.

Each text is cut at pre-token boundaries into leaves of ``LEAF`` pre-tokens; a
segment tree holds the token count of every leaf and inner node.  An edit
touches the leaves it overlaps.  Those leaves, with a leaf of context before
them (more within a run of blanks), are cut and encoded again from the edited
text; the scan goes on until it meets an old leaf border behind the edit, from
where pre-tokens (which depend on the text ahead only) are the same as before.  The touched leaves are replaced and
the sums above them updated; all other leaves keep their counts.

An edit is ``struct<start:int, stop:int, text:string>`` in characters of the
original text; edits of a text must not overlap and may come in any order
(insertions at one place keep theirs).

Edge cases: null text is empty; null edits are no edits; an edit past the end is
cut to the text; edits must not overlap.  Repeated rows are counted each; an
empty table gives no row; a very long text, or one long word, costs time in
proportion to its length; a caller's column named like an output is replaced.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import record, table, unpack
from tidemark.llm.packing import VOCABULARY, _engines

LEAF = 64


def _pattern():
    import public_tokenizers as P
    import regex

    global _REGEX
    _REGEX = _REGEX or regex.compile(P.PATTERN)
    return _REGEX


_REGEX = None


def tokens(text: str, vocabulary: str = VOCABULARY) -> int:
    return len(_engines(vocabulary)[1].encode_ordinary(text))


_COUNTS: dict[tuple[str, str], int] = {}


def count(pre_token: str, vocabulary: str) -> int:
    """Tokens of one pre-token, remembered for the next time."""
    n = _COUNTS.get((vocabulary, pre_token))
    if n is None:
        n = len(_engines(vocabulary)[1]._core_bpe.encode_single_piece(pre_token.encode()))
        if len(_COUNTS) >= 500_000:
            _COUNTS.clear()
        if len(pre_token) < 64:
            _COUNTS[vocabulary, pre_token] = n
    return n


class Tree:
    """Leaf starts (characters; one more than leaves) and the segment tree of counts."""

    def __init__(self, text: str, leaf: int = LEAF, vocabulary: str = VOCABULARY):
        self.text, self.leaf, self.vocabulary = text, leaf, vocabulary
        starts, counts = self._leaves(_pattern().findall(text), 0)
        self.starts = starts + [len(text)]
        self.encoded = 0
        self._build(counts)

    def _leaves(self, pre_tokens: list[str], at: int) -> tuple[list[int], list[int]]:
        starts, counts = [], []
        for i in range(0, len(pre_tokens), self.leaf):
            own = pre_tokens[i:i + self.leaf]
            starts.append(at)
            counts.append(sum([count(x, self.vocabulary) for x in own]))
            at += sum(map(len, own))
        return starts, counts

    def _build(self, counts: list[int]) -> None:
        size = 1 << max(0, (len(counts) - 1).bit_length())
        level = np.zeros(size, np.int64)
        level[:len(counts)] = counts
        self.leaves = len(counts)
        self.levels = [level]
        while len(level) > 1:
            level = level.reshape(-1, 2).sum(1)
            self.levels.append(level)

    @property
    def total(self) -> int:
        return int(self.levels[-1][0])

    def _set(self, i: int, n: int) -> None:
        change = n - int(self.levels[0][i])
        for level in self.levels:  # sums on the path to the root
            level[i] += change
            i >>= 1

    def apply(self, edits: list[tuple[int, int, str]]) -> "Tree":
        """Edit the text, the last edit first, and bring the counts up to date."""
        size = len(self.text)
        self.encoded = 0
        cut = [(min(a, size), min(max(a, b), size), t or "") for a, b, t in edits]
        for a, b, t in reversed(sorted(cut, key=lambda e: e[:2])):
            self._edit(a, b, t)
        return self

    def _edit(self, a: int, b: int, by: str) -> None:
        old, size = self.starts, len(self.text)
        first = max(0, min(bisect_right(old, a), self.leaves) - 2)
        while first and self.text[old[first] - 1].isspace():
            first -= 1  # a run of blanks may be cut anew
        border = bisect_left(old, b)
        while True:
            stop = min(border + 1, self.leaves)
            region = self.text[old[first]:a] + by + self.text[b:old[stop]]
            found = _pattern().findall(region)
            self.encoded += len(region)
            if old[stop] == size:
                last, keep = self.leaves, len(found)
                break
            sync, at, keep = len(region) - (old[stop] - old[border]), 0, 0
            while at < sync:
                at += len(found[keep])
                keep += 1
            if at == sync:  # back on an old border: all behind it is as before
                last = border
                break
            border += 1
        starts, counts = self._leaves(found[:keep], old[first])
        shift = len(by) - (b - a)
        self.text = self.text[:a] + by + self.text[b:]
        self.starts = old[:first] + starts + [x + shift for x in old[last:]]
        if len(counts) == last - first:
            for i, n in enumerate(counts):
                self._set(first + i, n)
        else:
            kept = self.levels[0].tolist()
            self._build(kept[:first] + counts + kept[last:self.leaves])


def count_edited(docs: DataFrame, edits: str = "edits", text: str = "text", leaf: int = LEAF,
                 vocabulary: str = VOCABULARY) -> DataFrame:
    """``docs`` with ``n_tokens``, ``n_edits``, ``n_tokens_after`` and
    ``encoded_chars`` (characters encoded again for the edits)."""
    rows = docs.select(record(docs), F.col(text).alias("text"), F.col(edits).alias("edits"))
    rec = rows.schema["rec"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            out: list[list[int]] = [[], [], [], []]
            for t, e in zip(batch.column("text").to_pylist(), batch.column("edits").to_pylist()):
                tree = Tree(t or "", leaf, vocabulary)
                before = tree.total
                e = [(x["start"], x["stop"], x["text"]) for x in e or []]
                if e:
                    tree.apply(e)
                for o, x in zip(out, (before, len(e), tree.total, tree.encoded if e else 0)):
                    o.append(x)
            yield pa.RecordBatch.from_arrays([batch.column("rec"), *[pa.array(o, pa.int64()) for o in out]],
                                             names=["rec", "n_tokens", "n_edits", "n_tokens_after", "encoded_chars"])

    got = rows.mapInArrow(run, f"rec {rec}, n_tokens bigint, n_edits bigint, n_tokens_after bigint, encoded_chars bigint")
    names = ("n_tokens", "n_edits", "n_tokens_after", "encoded_chars")
    return got.select(*unpack(docs.columns, {c: F.col(c) for c in names}))


#: What the registered query scrubs: e-mail addresses and runs of seven digits and
#: their signs.  An address is tried where a run of its signs begins or the last
#: match ended, and takes the run whole: no other start can do better, and a long
#: word is read once instead of once from each of its letters.
SCRUB = (r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
         r"|\+?[0-9][0-9() .-]{5,}[0-9]")


def scrub_edits(text: Column, pattern: str = SCRUB, by: str = "[removed]") -> Column:
    """Edits that replace every match of a pattern."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    sizes = F.arrays_zip(F.split(text, pattern, -1).alias("b"), found.alias("f"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,stop:int,text:string>>").alias("out"))
    step = lambda a, x: F.struct(
        (a["at"] + F.length(x["b"]) + F.coalesce(F.length(x["f"]), F.lit(0))).alias("at"),
        F.concat(a["out"], F.array(F.struct(
            (a["at"] + F.length(x["b"])).alias("start"), (a["at"] + F.length(x["b"]) + F.length(x["f"])).alias("stop"),
            F.lit(by).alias("text")))).alias("out"))
    return F.filter(F.aggregate(sizes, start, step)["out"], lambda x: x["stop"].isNotNull())


def op3_segment_trees(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return count_edited(docs.withColumn("edits", scrub_edits(F.col("text")))).drop("text", "edits")
