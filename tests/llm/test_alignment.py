"""Token alignment against a direct version over whole documents."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import alignment, pieces

SF = "/root/testdata/sf0.001"
ODD = [(1, "a plain text"), (2, None), (3, ""), (4, "x" * 300_000), (5, "a plain text"), (5, "a plain text"),
       (None, "nobody's é text"), (7, "\x00\t 12,5 \n"), (8, "你好 \U0001f600 é"), (9, "lost ▁ sign"), (10, " two  blanks "),
       (11, "a <|endoftext|> b </s> <0x41>"), (12, "word and\nword " * 20_000), (13, "пример текста " * 30)]


@pytest.fixture(scope="module")
def direct():
    """Token lists and bytes straight from the two libraries."""
    import public_tokenizers as P
    import sentencepiece
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    # The byte-level alphabet: printable bytes stand for themselves, others from U+0100 on.
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in plain}
    byte.update({chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)})

    def spell(i):
        piece = second.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if second.is_byte(i) else piece.replace("▁", " ").encode()

    def tokens(text):
        if not text:
            return None
        a = [(i, bytes(byte[c] for c in first.id_to_token(i)))
             for i in first.encode(" " + text, add_special_tokens=False).ids]
        b = [(i, spell(i)) for i in second.encode(text)]
        whole = (" " + text).encode()
        return (a, b) if b"".join(s for _, s in a) == whole == b"".join(s for _, s in b) else None
    return tokens


def expected(rows, tokens):
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups) per row."""
    seen, counts = [], Counter()
    for doc, text in rows:
        got = tokens(text)
        if got is None:
            seen.append((doc, 0, 0, [], ""))
            continue
        ends = []
        for side in got:
            at, out = 0, {}
            for i, s in side:
                at += len(s)
                out[at] = i
            ends.append(out)
        links = [(ends[0][e], ends[1][e]) for e in sorted(ends[0].keys() & ends[1].keys())]
        counts.update(links)
        groups, a, b = [], [], []
        for e in sorted(ends[0].keys() | ends[1].keys()):
            a += [ends[0][e]] if e in ends[0] else []
            b += [ends[1][e]] if e in ends[1] else []
            if e in ends[0] and e in ends[1]:
                groups.append(",".join(map(str, a)) + "|" + ",".join(map(str, b)))
                a, b = [], []
        assert not a and not b
        seen.append((doc, len(got[0]), len(got[1]), links, ";".join(groups)))
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    return [(doc, na, nb, len(links), len(links), sum(counts[x] == best[x[1]] for x in links),
             sum(counts[x] for x in links), groups) for doc, na, nb, links, groups in seen]


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]


@pytest.mark.parametrize("piece", [alignment.PIECE, 7])
def test_odd_rows(spark, direct, piece):
    rows = ODD if piece > 7 else [(i, t if t is None else t[:400]) for i, t in ODD]
    df = spark.createDataFrame(rows, "doc_id int, text string").repartition(3).withColumns(
        {"GROUPS": F.lit("mine"), "rec": F.lit(1), "a": F.lit(2)})
    got = alignment.align(df, piece=piece)
    assert got.columns == ["doc_id", "text", "rec", "a"] + COLUMNS[1:]
    out = sorted((tuple(r[c] for c in COLUMNS) for r in got.collect()), key=repr)
    assert out == sorted(expected(rows, direct), key=repr)


def test_nothing(spark):
    df = spark.createDataFrame([(1, None), (2, "")], "doc_id int, text string")
    assert [tuple(r)[2:] for r in alignment.align(df).collect()] == [(0, 0, 0, 0, 0, 0, "")] * 2
    assert alignment.align(df.where("false")).count() == 0


def test_diagonals():
    rng = random.Random(2)
    for _ in range(300):
        a, b = (np.array(sorted(rng.sample(range(60), rng.randrange(0, 40)))) for _ in range(2))
        merged = sorted([(x, 0) for x in a] + [(x, 1) for x in b])
        for d in range(1, len(merged)):
            i, j = alignment.diagonal(a, b, d)
            tie = merged[d - 1][0] == merged[d][0]
            assert (i, j) == (sum(s == 0 for _, s in merged[:d]), sum(s == 1 for _, s in merged[:d]) + tie)


def test_links_are_suffixes():
    """The bound of the broadcast table: linked tokens are suffixes of one another."""
    a, _, b, _ = alignment.tokenise([b"some words, and 123 others: internationalisation"])
    spell = alignment._fast(alignment.VOCABULARY)[1], alignment._pieces(pieces.MODEL)[1]
    x = [spell[0].join(a[:k + 1]) for k in range(len(a))]
    y = [spell[1].join(b[:k + 1]) for k in range(len(b))]
    linked = [(a[x.index(s)], b[y.index(s)]) for s in set(x) & set(y)]
    assert len(linked) > 5
    for u, v in linked:
        u, v = spell[0].join(np.array([u])), spell[1].join(np.array([v]))
        assert u.endswith(v) or v.endswith(u)


def test_query(spark, direct):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = [w[:7] + (hashlib.sha256(w[7].encode()).hexdigest() if w[7] else "",) for w in expected(docs, direct)]
    got = alignment.op12_merge_path(spark, SF)
    assert got.columns == COLUMNS[:-1] + ["groups_sha256"]
    assert sorted(map(tuple, got.collect())) == sorted(want)
