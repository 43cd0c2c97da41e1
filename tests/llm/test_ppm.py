"""PPM against a direct implementation with explicit exclusion sets."""

import math
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.llm.ppm import ORDER, op4_partial_matching, score

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def lower(t):
    return bytes(c + 32 if 65 <= c <= 90 else c for c in (t or "").encode())


def brute(rows, train):
    trie, words = defaultdict(Counter), Counter()

    def walk(t):
        s = [256] * ORDER + list((t or "").encode()) + [256]
        for i in range(ORDER, len(s)):
            yield s[i - ORDER:i], s[i]

    for (i, t), use in zip(rows, train):
        if use:
            words.update(WORD.findall(lower(t)) + [None])
            for ctx, x in walk(t):
                for k in range(ORDER + 1):
                    trie[tuple(ctx[ORDER - k:])][x] += 1
    n, v = sum(words.values()), len(words)

    def code(ctx, x):
        out, gone = 0.0, set()
        for k in range(ORDER, -1, -1):
            node = trie.get(tuple(ctx[ORDER - k:]))
            if not node:
                continue
            left = {s: c for s, c in node.items() if s not in gone}
            if not left:
                continue
            total = sum(left.values()) + len(left)
            if x in left:
                return out + math.log10(left[x] / total)
            out += math.log10(len(left) / total)
            gone |= set(left)
        return out - math.log10(257 - len(gone))

    out = []
    for i, t in rows:
        w = WORD.findall(lower(t)) + [None]
        out.append((i, len(w), sum(words[x] > 0 for x in w), n,
                    sum(math.log10((words[x] + 1) / (n + v + 1)) for x in w), sum(code(c, x) for c, x in walk(t))))
    return out


def same(got, want):
    got = sorted(got, key=repr)
    want = sorted(want, key=repr)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    for g, w in zip(got, want):
        assert g[4:] == pytest.approx(w[4:], rel=1e-9, abs=1e-9)


def rows_of(df):
    return [(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in df.collect()]


def test_small(spark):
    rows = [(1, "the cat the CAT"), (2, None), (3, ""), (4, "the cat sat é"), (5, "abracadabra " * 9), (6, "zq\x00zq"),
            (7, "the cat the CAT"), (8, "brand new words")]
    df = spark.createDataFrame(rows, "doc_id int, text string").repartition(3)
    same(rows_of(score(df, F.col("doc_id") % 4 != 0)), brute(rows, [i % 4 != 0 for i, _ in rows]))


def test_nothing_learned_and_empty(spark):
    rows = [(1, "ab c")]
    df = spark.createDataFrame(rows, "doc_id int, text string")
    same(rows_of(score(df, F.lit(False))), brute(rows, [False]))
    assert score(df.where("false"), F.lit(True)).count() == 0
    wide = df.withColumn("chunk", F.lit("x")).withColumn("key", F.lit(2))
    assert score(wide, F.lit(True)).first()["chunk"] == "x"


def test_query(spark):
    d = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    train = [zlib.crc32(str(i).encode()) % 7 != 2 for i, _ in rows]
    got = op4_partial_matching(spark, d)
    assert {r.doc_id for r in got.collect() if r.held_out} == {i for (i, _), t in zip(rows, train) if not t}
    same(rows_of(got), brute(rows, train))
