"""SentencePiece encoding and decoding by a table of each prefix's last token.

A byte-pair model merges any two neighbours whose joined text is a piece, the
best score first and the leftmost of equals.  So every prefix of a text has one
encoding, and its last token is the one token that ends there and may stand
behind the last token of the prefix before it.  An Aho-Corasick automaton over
the pieces gives all tokens that end at a position; a compatibility test, which
undoes the merges of both sides in reverse order, tells the one that fits; its
id is the prefix's entry.  The ids are then recovered from the last entry
backwards.

Before that a text is cut wherever no piece holds the two neighbouring
characters, since no merge ever crosses there.  Characters without a piece are
cut off in the same way and become byte pieces.  Short segments recur, so a
worker remembers the ids of a bounded number of them.

The rules of the model file are followed where they are those of a plain model
(identity normaliser, space as U+2581, dummy prefix); any other file is refused
when it is loaded.

Edge cases: a null or empty text has no ids, and no ids decode to an empty
text; an empty table gives no row; repeated rows are encoded as often as they
occur; a very long text costs time in proportion to its length; a caller's
column named like an output is replaced by it; bytes that are no UTF-8 count as
U+FFFD.  Null ids decode like no ids.
"""

from __future__ import annotations

import codecs
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import blocks, record, table, texts, unpack

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
#: Segments that a worker remembers, and the characters of the longest of them.
REMEMBERED, SHORT = 1 << 17, 64
#: Bytes of text that are encoded together.
BLOCK = 1 << 18
#: Kinds of a piece in a model file.
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6


def model_file(name: str) -> str:
    """A name of the public vocabularies, or a path."""
    import os

    import public_tokenizers as P
    return name if os.sep in name else P.path(name)


class Pieces:
    """Tables of one model file."""

    def __init__(self, path: str):
        import ahocorasick
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        spec, trained = proto.normalizer_spec, proto.trainer_spec
        if (trained.model_type != 2 or not trained.byte_fallback or spec.precompiled_charsmap
                or not spec.add_dummy_prefix or spec.remove_extra_whitespaces
                or not spec.escape_whitespaces or trained.treat_whitespace_as_suffix):
            raise ValueError(f"{path}: not a plain byte-pair model with byte fallback")
        if any(p.type not in (NORMAL, UNKNOWN, CONTROL, BYTE) for p in proto.pieces):
            raise ValueError(f"{path}: user-defined and unused pieces are not supported")
        plain = [(i, p.piece, p.score) for i, p in enumerate(proto.pieces) if p.type == NORMAL]
        self.ids = {p: i for i, p, _ in plain}
        order = {s: r for r, s in enumerate(sorted({s for *_, s in plain}, reverse=True))}
        #: Merge order by piece text, least first; a single character has none.
        self.rank = {p: order[s] if len(p) > 1 else -1 for _, p, s in plain}
        self.size = {i: len(p) for i, p, _ in plain}
        self.text = {i: p for i, p, _ in plain}
        letters = sorted(set("".join(self.ids)))
        if any(c not in self.ids for c in letters):
            raise ValueError(f"{path}: a piece holds a character that is no piece")
        self._characters(letters)
        self.last_merge: dict[str, tuple[str, str]] = {}
        self.uneven: set[str] = set()
        automaton = ahocorasick.Automaton()
        for i, p, _ in sorted(plain, key=lambda x: len(x[1])):
            if len(p) > 1 and not self._learn(p):
                continue  # never the result of merges
            automaton.add_word(p, (i, len(p)))
        automaton.make_automaton()
        self.ends = automaton.iter
        self.fit: dict[int, bool] = {}  # by the first id times 2^32, plus the second
        self.known = Segments(self)
        self._surfaces(proto)

    # -- tables --------------------------------------------------------------
    def _characters(self, letters: list[str]) -> None:
        """Number the characters and mark the pairs that some piece holds."""
        self.number = np.zeros(0x110000, np.uint16 if len(letters) < 65_535 else np.uint32)
        self.number[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.width = len(letters) + 1
        pairs = np.zeros(-(-self.width * self.width // 8), np.uint8)
        for a, b in {p[k:k + 2] for p in self.ids for k in range(len(p) - 1)}:
            at = int(self.number[ord(a)]) * self.width + int(self.number[ord(b)])
            pairs[at >> 3] |= 1 << (at & 7)
        self.pairs = pairs

    def _learn(self, piece: str) -> bool:
        """Find the last merge of ``piece``; False if merges give other pieces."""
        parts = self.merge(piece, stop_at=2)
        if len(parts) != 2 or self.merge("", parts=parts) != [piece]:
            return False
        self.last_merge[piece] = parts[0], parts[1]
        r = self.rank[piece]
        if any(self.rank[p] > r or p in self.uneven for p in parts):
            self.uneven.add(piece)
        return True

    def merge(self, text: str, parts: list[str] | None = None, stop_at: int = 1) -> list[str]:
        """Direct merging, for short texts: the best pair, the leftmost of equals."""
        parts = list(text) if parts is None else list(parts)
        rank = self.rank
        while len(parts) > stop_at:
            best = min(((rank[a + b], k) for k, (a, b) in enumerate(zip(parts, parts[1:]))
                        if a + b in rank), default=None)
            if best is None:
                break
            k = best[1]
            parts[k:k + 2] = [parts[k] + parts[k + 1]]
        return parts

    def _surfaces(self, proto) -> None:
        out = []
        for p in proto.pieces:
            if p.type == NORMAL:
                out.append(p.piece.replace(SPACE, " ").encode())
            elif p.type == BYTE:
                out.append(bytes([int(p.piece[3:5], 16)]))
            else:
                out.append(proto.trainer_spec.unk_surface.encode() if p.type == UNKNOWN else b"")
        self.byte_ids = [0] * 256
        for i, p in enumerate(proto.pieces):
            if p.type == BYTE:
                self.byte_ids[out[i][0]] = i
        self.surface_bytes = np.frombuffer(b"".join(out), np.uint8)
        self.surface_size = np.array([len(x) for x in out], np.int64)
        self.surface_at = np.cumsum(self.surface_size) - self.surface_size
        self.opens = np.array([p.type == NORMAL and p.piece.startswith(SPACE) for p in proto.pieces])
        self.silent = np.array([p.type == CONTROL for p in proto.pieces])

    # -- encoding ------------------------------------------------------------
    def fits(self, a: int, b: int) -> bool:
        """Whether token ``b`` may follow token ``a``: no merge crosses."""
        if len(self.fit) >= REMEMBERED:
            self.fit.clear()
        got = self.fit[a << 32 | b] = self._fits(self.text[a], self.text[b])
        return got

    def _fits(self, left: str, right: str) -> bool:
        rank, last_merge = self.rank, self.last_merge
        if left in self.uneven or right in self.uneven:
            return self.merge(left + right) == [left, right]
        # A crossing merge happens if it comes before the merges that take its
        # two sides: of equals the leftmost comes first.
        takes_left = takes_right = len(rank)
        while True:
            crossing = rank.get(left + right)
            if crossing is not None and crossing < takes_left and crossing <= takes_right:
                return False
            l, r = rank[left], rank[right]
            if l < 0 and r < 0:
                return True
            if l > r:
                takes_left, left = l, last_merge[left][1]
            else:
                takes_right, right = r, last_merge[right][0]

    def encode_segment(self, s: str) -> list[int]:
        """Ids of a segment: known characters only, or one unknown character."""
        if len(s) == 1 and s not in self.ids:
            return [self.byte_ids[b] for b in s.encode("utf-8", "replace")]
        last = [-1] * (len(s) + 1)
        known = self.fit.get
        for end, (token, size) in self.ends(s):
            end += 1
            if last[end] < 0:
                start = end - size
                if start:
                    before = last[start]
                    if before < 0:
                        continue
                    fits = known(before << 32 | token)
                    if fits is None:
                        fits = self.fits(before, token)
                    if not fits:
                        continue
                last[end] = token
        out, at = [], len(s)
        while at:
            out.append(last[at])
            at -= self.size[last[at]]
        return out[::-1]

    def encode(self, values: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, one text behind the other, and ids per text."""
        prepared = [SPACE + v.replace(" ", SPACE) if v else "" for v in values]
        whole = "".join(prepared)
        if not whole:
            return np.zeros(0, np.int32), np.zeros(len(values), np.int64)
        begins = np.cumsum([0] + [len(p) for p in prepared])
        number = self.number[np.frombuffer(whole.encode("utf-32-le"), np.uint32)].astype(np.int64)
        at = number[:-1] * self.width + number[1:]
        cut = np.ones(len(whole) + 1, bool)
        cut[1:-1] = (self.pairs[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 0
        cut[begins] = True
        edge = np.flatnonzero(cut)
        ends = edge.tolist()
        got = list(map(self.known.__getitem__, [whole[a:b] for a, b in zip(ends, ends[1:])]))
        ids = np.frombuffer(b"".join(got), "<i4")
        upto = np.concatenate(([0], np.cumsum(np.fromiter(map(len, got), np.int64, len(got)) >> 2)))
        return ids, np.diff(upto[np.searchsorted(edge, begins)])

    # -- decoding ------------------------------------------------------------
    def decode(self, ids: np.ndarray, per: np.ndarray) -> list[str]:
        """The texts of ids that lie one behind the other, ``per`` of them each."""
        sizes = self.surface_size[ids]
        upto = np.concatenate(([0], np.cumsum(sizes)))
        data = self.surface_bytes[np.repeat(self.surface_at[ids] - upto[:-1], sizes) + np.arange(upto[-1])].tobytes()
        edge = np.concatenate(([0], np.cumsum(per)))
        spoken = np.append(np.flatnonzero(~self.silent[ids]), len(ids))
        first = spoken[np.searchsorted(spoken, edge[:-1])]
        dummy = np.append(self.opens[ids], False)[first] & (first < edge[1:])
        # Bytes on the two sides of a control piece make no character together.
        silent = np.flatnonzero(self.silent[ids])
        parts = np.unique(np.concatenate((edge, silent, silent + 1)))
        begin, end = upto[parts[:-1]], upto[parts[1:]]
        begin[np.searchsorted(parts[:-1], first[dummy])] += 1
        out = [data[a:b].decode("utf-8", "each_byte") for a, b in zip(begin.tolist(), end.tolist())]
        if len(parts) == len(edge):
            return out
        at = np.searchsorted(parts, edge).tolist()
        return ["".join(out[a:b]) for a, b in zip(at, at[1:])]


class Segments(dict):
    """Ids of short segments as little-endian int32.  When full, the segments
    not asked for again since the last time it was full are forgotten."""

    def __init__(self, pieces: Pieces):
        super().__init__()
        self.pieces, self.older = pieces, {}

    def __missing__(self, s: str) -> bytes:
        got = self.older.get(s)
        if got is None:
            got = np.array(self.pieces.encode_segment(s), "<i4").tobytes()
        if len(s) <= SHORT:
            if len(self) >= REMEMBERED:
                self.older = dict(self)
                self.clear()
            self[s] = got
        return got


codecs.register_error("each_byte", lambda e: ("�" * (e.end - e.start), e.end))


@lru_cache(maxsize=2)
def load(model: str = MODEL) -> Pieces:
    """The tables of a model file, made once a worker."""
    return Pieces(model_file(model))


def _lists(values: np.ndarray, per: np.ndarray) -> pa.Array:
    at = pa.array(np.concatenate(([0], np.cumsum(per))), pa.int32())
    return pa.ListArray.from_arrays(at, pa.array(values, pa.int32()))


def encode(docs: DataFrame, text: str = "text", model: str = MODEL, output: str = "ids",
           keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of each row (all by default) and its ``ids`` (array of int)."""
    kept = docs.columns if keep is None else keep
    rows = docs.select(record(docs, keep=kept), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load(model)
        for batch in batches:
            raw = texts(batch.column("text"))
            for a, b in blocks(raw, BLOCK):
                ids, per = pieces.encode([v.decode("utf-8", "replace") for v in raw[a:b]])
                yield pa.RecordBatch.from_arrays([batch.column("rec").slice(a, b - a), _lists(ids, per)],
                                                 names=["rec", "ids"])

    out = rows.mapInArrow(run, f"rec {rows.schema['rec'].dataType.simpleString()}, ids array<int>")
    return out.select(*unpack(kept, {output: F.col("ids")}))


def decode(rows: DataFrame, ids: str = "ids", model: str = MODEL, output: str = "decoded") -> DataFrame:
    """All columns of ``rows`` and the text of its ids.  An id outside the model fails."""
    names = rows.columns
    slim = rows.select(record(rows), F.coalesce(F.col(ids), F.array().cast("array<int>")).alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load(model)
        for batch in batches:
            column = batch.column("ids")
            at = column.offsets.to_numpy()
            per = np.diff(at).astype(np.int64)
            # About as many ids at a time as a block has bytes.
            steps = np.unique(np.concatenate(([0], np.searchsorted(at, np.arange(at[0], at[-1], 1 << 18)), [len(per)])))
            for a, b in zip(steps.tolist(), steps[1:].tolist()):
                flat = column.values.slice(at[a], at[b] - at[a]).to_numpy(zero_copy_only=False)
                out = pieces.decode(flat, per[a:b])
                yield pa.RecordBatch.from_arrays([batch.column("rec").slice(a, b - a), pa.array(out, pa.string())],
                                                 names=["rec", "decoded"])

    out = slim.mapInArrow(run, f"rec {slim.schema['rec'].dataType.simpleString()}, decoded string")
    return out.select(*unpack(names, {output: F.col("decoded")}))


def op11_prefix_table(spark, sf_dir: str) -> DataFrame:
    coded = decode(encode(table(spark, sf_dir, "documents"), keep=["doc_id"]))
    return coded.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
                        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))
