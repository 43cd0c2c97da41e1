"""SentencePiece encoding and decoding against the library itself."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import pieces

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=pieces.model_file(pieces.MODEL))


def test_random_texts(library):
    p, rng = pieces.load(), random.Random(7)
    letters, whole = [c for c in p.ids if len(c) == 1], list(p.ids)
    kinds = [lambda: rng.choice("aehinorst  "), lambda: rng.choice(letters), lambda: rng.choice(whole),
             lambda: rng.choice([" ", "   ", "▁", "the", "\n", "\t", "　", "一", "ab", "\x00", "é", "\U0001f600"]),
             lambda: chr(rng.choice([rng.randrange(32, 127), rng.randrange(0x100, 0xD000)])),
             lambda: rng.choice(whole)[:rng.randrange(1, 5)]]
    made = ["".join(rng.choice(kinds)() for _ in range(rng.randrange(0, 30))) for _ in range(3000)]
    made += ["".join(kinds[k % 6]() for _ in range(rng.randrange(1, 40))) for k in range(6000)]
    ids, per = p.encode(made)
    cut = np.split(ids, np.cumsum(per)[:-1])
    assert [c.tolist() for c in cut] == library.encode(made)
    assert p.decode(ids, per) == library.decode([c.tolist() for c in cut])
    # Any ids: halves of characters, control pieces, the unknown piece.
    loose = [[rng.randrange(rng.choice([262, 32000])) for _ in range(rng.randrange(12))] for _ in range(3000)]
    flat = np.array([i for x in loose for i in x], np.int64)
    assert p.decode(flat, np.array([len(x) for x in loose])) == [library.decode(x) for x in loose]


def test_pair_test_against_merging():
    p, rng = pieces.load(), random.Random(11)
    tokens = list(p.size)
    runs = [i for i, t in p.text.items() if set(t) == {pieces.SPACE}]
    pairs = [(rng.choice(tokens), rng.choice(tokens)) for _ in range(4000)] + [(a, b) for a in runs for b in runs]
    for t in rng.sample(tokens, 4000):  # both halves of a token
        s = p.text[t]
        pairs += [(p.ids[s[:k]], p.ids[s[k:]]) for k in range(1, len(s)) if s[:k] in p.ids and s[k:] in p.ids]
    for a, b in pairs:
        assert p._fits(p.text[a], p.text[b]) == (p.merge(p.text[a] + p.text[b]) == [p.text[a], p.text[b]])


def test_forgetting_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED", 5)
    p = pieces.Pieces(pieces.model_file(pieces.MODEL))
    made = ["one two three four five six seven eight nine ten " * 3, "one", "two six ten"]
    ids, per = p.encode(made)
    assert [c.tolist() for c in np.split(ids, np.cumsum(per)[:-1])] == library.encode(made)
    assert len(p.known) <= 5


def test_odd_rows(spark, library):
    rows = [(1, "a plain text"), (2, None), (3, ""), (4, "x" * 300_000), (5, "a plain text"), (5, "a plain text"),
            (None, "nobody's é text"), (7, "\x00\t 12,5 \n"), (8, "你好 \U0001f600 é ▁"), (9, " " * 700 + "end  "),
            (10, "ab" * 1_500_000)]
    df = spark.createDataFrame(rows, "doc_id int, text string").repartition(3).withColumns(
        {"IDS": F.lit("mine"), "rec": F.lit(1), "Decoded": F.lit(2.0)})
    got = pieces.decode(pieces.encode(df))
    assert got.columns == ["doc_id", "text", "rec", "ids", "decoded"]
    out = sorted(((r.doc_id, r.text, list(r.ids), r.decoded) for r in got.collect()), key=repr)
    want = [(i, t, library.encode(t or ""), library.decode(library.encode(t or ""))) for i, t in rows]
    assert out == sorted(want, key=repr)
    assert pieces.decode(pieces.encode(df.where("false"))).count() == 0
    nothing = spark.createDataFrame([(1, None), (2, [])], "id int, ids array<int>")
    assert [r.decoded for r in pieces.decode(nothing).collect()] == ["", ""]


def test_query(spark, library):
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in pieces.op11_prefix_table(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = library.encode(d.text or "")
        assert got[d.doc_id] == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                                 hashlib.sha256(library.decode(ids).encode()).hexdigest())
