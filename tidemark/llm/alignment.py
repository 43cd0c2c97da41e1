"""Alignment of two tokenizers over the same texts, by merge-path pieces.

Both tokenizers cut the same bytes, so the sorted byte ends of their tokens are
merged.  Diagonals of the merge matrix, every ``PIECE`` merged ends, are met by
binary search; they cut a document into pieces of equal work that need nothing
of each other.  The pieces of long documents are dealt to all tasks.  A piece
finds the ends that both sides share: each closes a group, and links its two
tokens.  What lies before the first and behind the last shared end of a piece
is a fragment; fragments of neighbouring pieces are stitched into the groups
that run over a boundary.  (A diagonal between two equal ends moves behind
both, so every shared end is seen by one piece.)

How often two ids are linked in the whole corpus is one aggregation.  Its table
is bounded by the vocabularies, whatever the corpus: tokens that end together
over the same bytes are suffixes of one another, so there are no more pairs
than tokens have suffixes (about half a million for the default files).  That
table alone is broadcast.

Edge cases: a null or empty text, and one that either tokenizer does not give
back byte for byte, has no tokens: zeros, and an empty ``groups``.  An empty
table gives no row; repeated rows count as often as they occur; a very long
text is many pieces; strings of special tokens are plain text; a caller's
column named like an output is replaced by it.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import pieces as sentence
from tidemark.llm.common import blocks, materialise, record, table, texts, unpack

VOCABULARY = "byte_bpe_50k"
#: Merged token ends of a piece.
PIECE = 1 << 16
#: Highest code point that the fast byte-pair engine is used for (Latin, IPA excluded).
FAST_BELOW = 0x250

#: A piece that is to be met: its ids, and the bytes before it on both sides.
_CUT = [("row", T.LongType()), ("piece", T.IntegerType()), ("a_from", T.LongType()), ("b_from", T.LongType()),
        ("a", T.BinaryType()), ("b", T.BinaryType())]
_MET = [("row", T.LongType()), ("piece", T.IntegerType()), ("n_a", T.LongType()), ("n_b", T.LongType()),
        ("head_a", T.StringType()), ("head_b", T.StringType()), ("mid", T.StringType()),
        ("tail_a", T.StringType()), ("tail_b", T.StringType()), ("links", T.ArrayType(T.LongType()))]
#: A document: its groups as compressed text, several times as short as plain.
_DONE = [("n_a", T.LongType()), ("n_b", T.LongType()), ("packed", T.BinaryType()), ("links", T.ArrayType(T.LongType()))]
#: Small row groups: a writer holds one in memory, and the rows are wide.
_WRITER = {"parquet.block.size": str(16 << 20)}


#: Bytes of text that are tokenised and met together.
BLOCK = 1 << 18
#: Characters of groups that leave a task together.
OUT_CHARS = 4 << 20


def _pack(values: list[str]) -> pa.Array:
    import zstandard

    squeeze = zstandard.ZstdCompressor(level=1).compress
    return pa.array([squeeze(v.encode()) if v else b"" for v in values], pa.binary())


def _unpack(values: list[bytes]) -> list[str]:
    import zstandard

    expand = zstandard.ZstdDecompressor().decompress
    return [expand(v).decode() if v else "" for v in values]


def _schema(rec: T.DataType, fields: list) -> T.StructType:
    return T.StructType([T.StructField("rec", rec)] + [T.StructField(n, t) for n, t in fields])


class Spelling:
    """Bytes of every id of a vocabulary."""

    def __init__(self, entries: list[bytes]):
        self.data = np.frombuffer(b"".join(entries), np.uint8)
        self.size = np.array([len(e) for e in entries], np.int64)
        self.at = np.cumsum(self.size) - self.size

    def join(self, ids: np.ndarray) -> bytes:
        size = self.size[ids]
        upto = np.cumsum(size)
        total = int(upto[-1]) if len(ids) else 0
        return self.data[np.repeat(self.at[ids] - upto + size, size) + np.arange(total)].tobytes()


@lru_cache(maxsize=2)
def _exact(vocabulary: str):
    import public_tokenizers as P
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(P.path(f"{vocabulary}.json"))
    exact.encode_special_tokens = True
    return exact


@lru_cache(maxsize=2)
def _fast(vocabulary: str):
    """Fast engine over the same vocabulary, and its spelling."""
    import public_tokenizers as P
    import tiktoken

    with open(P.path(f"{vocabulary}.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    entries = [b""] * (max(ranks.values()) + 1)
    for spelt, i in ranks.items():
        entries[i] = spelt
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={}), Spelling(entries)


@lru_cache(maxsize=2)
def _pieces(model: str):
    """The library's engine of a piece model, which holds little memory, and its spelling."""
    import sentencepiece

    engine = sentencepiece.SentencePieceProcessor(model_file=sentence.model_file(model))
    return engine, Spelling([bytes([int(p[3:5], 16)]) if engine.is_byte(i) else p.replace(sentence.SPACE, " ").encode()
                             for i, p in enumerate(engine.id_to_piece(list(range(engine.vocab_size()))))])


def _flat(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    per = np.array([len(x) for x in ids], np.int64)
    return np.fromiter(chain.from_iterable(ids), np.int32, int(per.sum())), per


@lru_cache(maxsize=8)
def _decimals(n: int, after: str) -> np.ndarray:
    out = np.empty(n, object)
    out[:] = [f"{i}{after}" for i in range(n)]
    return out


def tokenise(values: list[bytes], vocabulary: str = VOCABULARY, model: str = sentence.MODEL):
    """(a, n_a, b, n_b): ids of both tokenizers, text behind text, and how many
    a text has; none for a text that is not given back byte for byte."""
    fast, spell_a = _fast(vocabulary)
    engine, spell_b = _pieces(model)
    whole = [v.decode("utf-8", "replace") for v in values]
    a, n_a = _flat([[] if not v else fast.encode_ordinary(" " + v) if v.isascii() or max(v) < chr(FAST_BELOW)
                    else _exact(vocabulary).encode(" " + v, add_special_tokens=False).ids for v in whole])
    b, n_b = _flat(engine.encode(whole, num_threads=1) if whole else [])
    ok = np.ones(len(values), bool)
    for got, per, spell in ((a, n_a, spell_a), (b, n_b, spell_b)):
        spelt = spell.join(got)
        edge = np.concatenate(([0], np.cumsum(spell.size[got])))[np.concatenate(([0], np.cumsum(per)))].tolist()
        ok &= [spelt[s:e] == (b" " + v if v else b"") for s, e, v in zip(edge, edge[1:], values)]
    if not ok.all():
        a, b = a[np.repeat(ok, n_a)], b[np.repeat(ok, n_b)]
        n_a, n_b = np.where(ok, n_a, 0), np.where(ok, n_b, 0)
    return a, n_a, b, n_b


def diagonal(a_end: np.ndarray, b_end: np.ndarray, d: int) -> tuple[int, int]:
    """Where the merge of two sorted lists stands after ``d`` ends (of equal
    ends the first list's comes first), moved behind an equal pair."""
    low, high = max(0, d - len(b_end)), min(d, len(a_end))
    while low < high:
        mid = (low + high) // 2
        if a_end[mid] <= b_end[d - 1 - mid]:
            low = mid + 1
        else:
            high = mid
    i, j = low, d - low
    if 0 < i and j < len(b_end) and a_end[i - 1] == b_end[j]:
        j += 1
    return i, j


def _cut(piece: int, vocabulary: str, model: str):
    """Rows -> documents of one piece, met at once, and the pieces of longer
    ones as they are; the record goes with a document's first piece."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spell_a, spell_b = _fast(vocabulary)[1], _pieces(model)[1]
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            raw = texts(batch.column("text"))
            for lo, hi in blocks(raw, BLOCK):
                a, n_a, b, n_b = tokenise(raw[lo:hi], vocabulary, model)
                a_at, b_at = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
                data_a, data_b = a.astype("<i4").tobytes(), b.astype("<i4").tobytes()
                short = np.flatnonzero(n_a + n_b <= piece)
                zero = np.zeros(len(short), np.int64)
                met = meet([data_a[4 * i:4 * j] for i, j in zip(a_at[short].tolist(), (a_at + n_a)[short].tolist())],
                           [data_b[4 * i:4 * j] for i, j in zip(b_at[short].tolist(), (b_at + n_b)[short].tolist())],
                           zero, zero, zero == 0, spell_a, spell_b)
                out = []  # document, piece, bytes before it, its ids
                for k in np.flatnonzero(n_a + n_b > piece).tolist():
                    x, y, i0, j0 = int(n_a[k]), int(n_b[k]), int(a_at[k]), int(b_at[k])
                    a_end, b_end = np.cumsum(spell_a.size[a[i0:i0 + x]]), np.cumsum(spell_b.size[b[j0:j0 + y]])
                    cuts = [(0, 0)] + [diagonal(a_end, b_end, d) for d in range(piece, x + y, piece)] + [(x, y)]
                    for p, ((i, j), (u, v)) in enumerate(zip(cuts, cuts[1:])):
                        out.append((k, p, int(a_end[i - 1]) if i else 0, int(b_end[j - 1]) if j else 0,
                                    data_a[4 * (i0 + i):4 * (i0 + u)], data_b[4 * (j0 + j):4 * (j0 + v)]))
                rows, wide = len(short), len(out)

                def column(values, kind):  # nothing of the kind for the met documents
                    return pa.array([None] * rows + values, kind)

                yield pa.RecordBatch.from_arrays(
                    [batch.column("rec").take(pa.array((lo + short).tolist() + [None if o[1] else lo + o[0] for o in out], pa.int64())),
                     column([row + o[0] for o in out], pa.int64()), column([o[1] for o in out], pa.int32()),
                     column([o[2] for o in out], pa.int64()), column([o[3] for o in out], pa.int64()),
                     column([o[4] for o in out], pa.binary()), column([o[5] for o in out], pa.binary()),
                     pa.array(met["n_a"].tolist() + [None] * wide, pa.int64()),
                     pa.array(met["n_b"].tolist() + [None] * wide, pa.int64()),
                     pa.concat_arrays([_pack(met["mid"]), pa.nulls(wide, pa.binary())]),
                     pa.concat_arrays([met["links"], pa.nulls(wide, met["links"].type)])],
                    names=["rec"] + [n for n, _ in _CUT + _DONE])
                row += hi - lo
    return run


def meet(a: list[bytes], b: list[bytes], a_from: np.ndarray, b_from: np.ndarray, first: np.ndarray,
         spell_a: Spelling, spell_b: Spelling) -> dict[str, list]:
    """Shared ends of each piece: its groups and fragments as text, its links.
    The fragment before a document's first shared end is a whole group."""
    n = len(a)
    n_a, n_b = (np.array([len(x) >> 2 for x in v], np.int64) for v in (a, b))
    a, b = (np.frombuffer(b"".join(v), "<i4") for v in (a, b))
    of_a, of_b = np.repeat(np.arange(n), n_a), np.repeat(np.arange(n), n_b)

    def ends(ids, per, of, start, spell):
        upto = np.concatenate(([0], np.cumsum(spell.size[ids])))
        before = upto[np.cumsum(per) - per]
        return upto[1:] + (start - before)[of], start + upto[np.cumsum(per)] - before

    a_end, a_stop = ends(a, n_a, of_a, a_from, spell_a)
    b_end, b_stop = ends(b, n_b, of_b, b_from, spell_b)
    # Pieces lie one behind the other on one line, so one merge serves them all.
    low = np.minimum(a_from, b_from)
    span = np.maximum(a_stop, b_stop) - low + 1
    shift = np.cumsum(span) - span - low
    a_end, b_end = a_end + shift[of_a], b_end + shift[of_b]
    at = np.searchsorted(b_end, a_end)
    shared = np.zeros(len(a), bool)
    inside = at < len(b)
    shared[inside] = b_end[at[inside]] == a_end[inside]
    ia = np.flatnonzero(shared)
    ib = at[ia]
    count = np.bincount(of_a[ia], minlength=n)
    # Piece p has count[p] groups and a last fragment, which may be empty.
    closed = np.zeros(len(b), bool)
    closed[ib] = True
    group_a = np.cumsum(shared) - shared + of_a
    group_b = np.cumsum(closed) - closed + of_b
    total = len(ia) + n
    size_a, size_b = np.bincount(group_a, minlength=total), np.bincount(group_b, minlength=total)
    upto_a, upto_b = np.cumsum(size_a), np.cumsum(size_b)
    items = np.empty(len(a) + len(b), object)
    place_a = np.arange(len(a)) + (upto_b - size_b)[group_a]
    place_b = np.arange(len(b)) + upto_a[group_b]
    wide_a, wide_b = len(spell_a.size), len(spell_b.size)
    items[place_a], items[place_b] = _decimals(wide_a, ",")[a], _decimals(wide_b, ",")[b]
    items[place_a[ia]], items[place_b[ib]] = _decimals(wide_a, "|")[a[ia]], _decimals(wide_b, ";")[b[ib]]
    items = items.tolist()
    start = np.concatenate(([0], upto_a + upto_b)).tolist()
    split = (np.concatenate(([0], upto_a + upto_b))[:-1] + size_a).tolist()
    out = {k: [] for k in ("head_a", "head_b", "mid", "tail_a", "tail_b")}

    def say(x, y):
        return "".join(items[x:y])[:-1]

    g = 0
    for c, opens in zip(count.tolist(), first.tolist()):
        head, tail = (g if not opens else None), (g + c if c or opens else None)
        out["head_a"].append(say(start[g], split[g]) if head is not None else "")
        out["head_b"].append(say(split[g], start[g + 1]) if head is not None else "")
        out["mid"].append(say(start[g if opens else min(g + 1, g + c)], start[g + c]))
        out["tail_a"].append(say(start[g + c], split[g + c]) if tail is not None else "")
        out["tail_b"].append(say(split[g + c], start[g + c + 1]) if tail is not None else "")
        g += c + 1
    links = a[ia].astype(np.int64) << 32 | b[ib]
    edge = pa.array(np.concatenate(([0], np.cumsum(count))), pa.int32())
    return {"n_a": n_a, "n_b": n_b, **out, "links": pa.ListArray.from_arrays(edge, pa.array(links, pa.int64()))}


def _meet(vocabulary: str, model: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spell_a, spell_b = _fast(vocabulary)[1], _pieces(model)[1]
        for batch in batches:
            a, b = texts(batch.column("a")), texts(batch.column("b"))
            for lo, hi in blocks(a):
                part = batch.slice(lo, hi - lo)
                got = meet(a[lo:hi], b[lo:hi], part.column("a_from").to_numpy(), part.column("b_from").to_numpy(),
                           part.column("piece").to_numpy() == 0, spell_a, spell_b)
                kinds = {"n_a": pa.int64(), "n_b": pa.int64()}
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in ("rec", "row", "piece")]
                    + [v if isinstance(v, pa.Array) else pa.array(v, kinds.get(k, pa.string())) for k, v in got.items()],
                    names=["rec"] + [n for n, _ in _MET])
    return run


def _stitch(rows: pa.Table) -> pa.Table:
    """The pieces of one document as one row: fragments become groups."""
    rows = rows.sort_by("piece")
    said, left, right = [], [], []
    cells = [rows.column(c).to_pylist() for c in ("head_a", "head_b", "mid", "tail_a", "tail_b")]
    closes = [len(x) > 0 for x in rows.column("links").to_pylist()]
    for head_a, head_b, mid, tail_a, tail_b, closed in zip(*cells, closes):
        left.append(head_a)
        right.append(head_b)
        if not closed:
            left.append(tail_a)
            right.append(tail_b)
            continue
        if any(left) or any(right):
            said.append(",".join(filter(None, left)) + "|" + ",".join(filter(None, right)))
        if mid:
            said.append(mid)
        left, right = [tail_a], [tail_b]
    links = rows.column("links").combine_chunks().flatten()
    return pa.table({
        "rec": rows.column("rec").slice(0, 1),
        "n_a": pa.array([sum(rows.column("n_a").to_pylist())], pa.int64()),
        "n_b": pa.array([sum(rows.column("n_b").to_pylist())], pa.int64()),
        "packed": _pack([";".join(said)]),
        "links": pa.ListArray.from_arrays(pa.array([0, len(links)], pa.int32()), links)})


def align(docs: DataFrame, text: str = "text", vocabulary: str = VOCABULARY, model: str = sentence.MODEL,
          keep: list[str] | None = None, piece: int = PIECE) -> DataFrame:
    """The columns ``keep`` of each row (all by default) and ``n_a n_b n_groups
    n_links n_best count_sum groups``; ``groups`` reads ``a1,a2|b1;a3|b2,b3``."""
    kept = docs.columns if keep is None else keep
    rec = (record(docs, keep=kept) if kept else F.struct(F.lit(None).cast("int").alias("k")).alias("rec"))
    rows = docs.select(rec, F.col(text).alias("text"))
    kind = rows.schema["rec"].dataType
    cut = materialise(rows.mapInArrow(_cut(piece, vocabulary, model), _schema(kind, _CUT + _DONE)),
                      "alignment", **_WRITER)
    names = ["rec"] + [n for n, _ in _DONE]
    parts = (cut.where("row is not null").select("rec", *[n for n, _ in _CUT]).repartition("row", "piece")
             .mapInArrow(_meet(vocabulary, model), _schema(kind, _MET)))
    stitched = materialise(parts.groupBy("row").applyInArrow(_stitch, _schema(kind, _DONE)), "alignment-stitched", **_WRITER)
    done = cut.where("row is null").select(*names).union(stitched)
    # Bounded by the vocabularies: see above.
    pairs = done.select(F.explode("links").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n"))
    best = F.max("n").over(Window.partitionBy(F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))))
    known = pairs.select("pair", "n", (F.col("n") == best).alias("best")).toArrow().sort_by("pair")
    shared = docs.sparkSession.sparkContext.broadcast(
        (known.column("pair").to_numpy(), known.column("n").to_numpy(), known.column("best").to_numpy()))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, times, is_best = shared.value
        for batch in batches:
            column = batch.column("links")
            edge = column.offsets.to_numpy() - column.offsets[0].as_py()
            at = np.searchsorted(pair, column.flatten().to_numpy())
            sums = [np.diff(np.concatenate(([0], np.cumsum(v)))[edge]) for v in (is_best[at].astype(np.int64), times[at])]
            packed = texts(batch.column("packed"))
            # A few documents at a time: their groups are much longer than what came in.
            for lo, hi in blocks(packed, OUT_CHARS >> 3):
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [part.column("rec"), part.column("n_a"), part.column("n_b"),
                     pa.array(_unpack(packed[lo:hi]), pa.string()), pa.array(np.diff(edge)[lo:hi], pa.int64()),
                     *[pa.array(v[lo:hi], pa.int64()) for v in sums]],
                    names=["rec", "n_a", "n_b", "groups", "n_links", "n_best", "count_sum"])

    fields = _DONE[:2] + [("groups", T.StringType())] + [(c, T.LongType()) for c in ("n_links", "n_best", "count_sum")]
    scored = done.mapInArrow(score, _schema(kind, fields))
    # Every group ends where one token of each side ends.
    return scored.select(*unpack(kept, {
        "n_a": F.col("n_a"), "n_b": F.col("n_b"), "n_groups": F.col("n_links"), "n_links": F.col("n_links"),
        "n_best": F.col("n_best"), "count_sum": F.col("count_sum"), "groups": F.col("groups")}))


def op12_merge_path(spark, sf_dir: str) -> DataFrame:
    out = align(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return out.withColumn("groups_sha256", F.when(F.col("groups") != "", F.sha2("groups", 256)).otherwise("")).drop("groups")
