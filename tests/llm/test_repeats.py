"""Repeated strings against a dictionary of all strings."""

import hashlib
import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from tidemark.llm.repeats import op2_bucket_pointers, remove_repeats


def brute(values, length):
    data = [(v or "").encode() for v in values]
    places = defaultdict(list)
    for i, v in enumerate(data):
        for p in range(len(v) - length + 1):
            places[v[p:p + length]].append((i, p))
    hit = [bytearray(len(v)) for v in data]
    for found in places.values():
        if len(found) > 1:
            for i, p in found:
                hit[i][p:p + length] = b"\1" * length
    out = []
    for v, h in zip(data, hit):
        spans = sum(1 for j, x in enumerate(h) if x and (j == 0 or not h[j - 1]))
        out.append((len(v), sum(h), spans, bytes(b for b, x in zip(v, h) if not x)))
    return out


def check(spark, values, length):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "doc_id int, text string")
    got = {r.doc_id: (r.n_bytes, r.n_removed, len(r.removed), bytes(r.kept))
           for r in remove_repeats(df.repartition(3), length=length).collect()}
    assert got == dict(enumerate(brute(values, length)))


def test_random_texts(spark):
    rng = random.Random(5)
    base = "".join(rng.choice("abcdefgh ") for _ in range(600))
    values = [None, "", "short", "a" * 200, "ab" * 90, base, base, "x" + base[:300] + "y" + base[280:]]
    for _ in range(30):
        s = list(base[rng.randrange(200):rng.randrange(300, 600)])
        for _ in range(rng.randrange(5)):
            s[rng.randrange(len(s))] = rng.choice("xyzé")
        a, n = rng.randrange(400), rng.choice((39, 40, 41, 80))
        values.append("".join(s) + "".join(rng.choice("klmn") for _ in range(50)) + base[a:a + n])
    check(spark, values, 40)


def test_small_alphabet(spark):
    rng = random.Random(6)
    check(spark, ["".join(rng.choice("ab") for _ in range(rng.randrange(120))) for _ in range(60)], 12)


def test_long_text_in_pieces(spark, monkeypatch):
    import tidemark.llm.repeats as R

    rng = random.Random(7)
    part = "".join(rng.choice("abcdefgh ") for _ in range(3000))
    v = [part + "Z" + part[100:2900], part[500:1500], "q" * 3000]
    monkeypatch.setattr(R, "PIECE", 700)
    rows = list(R.pieces([x.encode() for x in v], 40))
    starts = [(r, o + p) for d, rs, os_, b in rows for r, o, x, y in zip(rs, os_, b, b[1:])
              for p in range(y - x - 39)]
    assert sorted(starts) == [(i, p) for i, x in enumerate(v) for p in range(len(x) - 39)]
    check(spark, v, 40)


def test_empty_and_clashing(spark):
    assert remove_repeats(spark.createDataFrame([], "doc_id int, text string")).count() == 0
    df = spark.createDataFrame([(1, "t" * 500, "a", 3, "k")], "doc_id int, text string, rec string, r1 int, KEPT string")
    out = remove_repeats(df)
    assert out.columns == ["doc_id", "text", "rec", "r1", "n_bytes", "n_removed", "removed", "kept"]
    r = out.first()
    assert (r.rec, r.r1, r.n_removed, bytes(r.kept)) == ("a", 3, 500, b"")


def test_query(spark):
    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()
    want = {r.doc_id: (a, b, c, hashlib.sha256(k).hexdigest())
            for r, (a, b, c, k) in zip(docs, brute([r.text for r in docs], 400))}
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in op2_bucket_pointers(spark, d).collect()}
    assert got == want


def test_over_words(spark):
    """Strings of more than a number of words against a direct version."""
    rng = random.Random(8)
    alphabet = ["a", "bé", "c.", "(d", "--", "e-e", "f"]
    values = ["".join(rng.choice(alphabet) + rng.choice((" ", " ", " ", "\n", "  ")) for _ in range(rng.randrange(90)))
              for _ in range(60)]
    values += [values[3], f"x{values[4]}y", "", None]
    for over in (5, 9):
        places, hits = defaultdict(list), [bytearray(len((v or "").encode())) for v in values]
        for i, v in enumerate(values):
            v = (v or "").encode()
            w = [(t.start() + m.start(), t.start() + m.end()) for t in re.finditer(rb"[^\x20\x09-\x0D]+", v)
                 for m in [re.search(rb"[0-9A-Za-z\x80-\xff](?:.*[0-9A-Za-z\x80-\xff])?", t.group())] if m]
            for (s, _), (_, e) in zip(w, w[over:]):
                places[v[s:e]].append((i, s, e))
        for found in places.values():
            for i, s, e in found if len(found) > 1 else ():
                hits[i][s:e] = b"\1" * (e - s)
        df = spark.createDataFrame(list(enumerate(values)), "doc_id int, text string").repartition(3)
        got = {r.doc_id: r.kept for r in remove_repeats(df, length=4000, over_words=over).collect()}
        want = {i: bytes(c for c, h in zip((v or "").encode(), hits[i]) if not h) for i, v in enumerate(values)}
        assert got == want and any(map(any, hits)) and not all(map(all, hits))


def test_told_passages(spark):
    """Bytes in repeated strings of more than so many words, which stay."""
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdef") for _ in range(rng.randrange(1, 5)))
    shared = [[word() for _ in range(n)] for n in (9, 12, 30)]
    rows = []
    for i in range(60):
        parts = [word() + str(i) for _ in range(rng.randrange(30))]
        if i % 3 == 0:
            at = rng.randrange(len(parts) + 1)
            parts[at:at] = shared[i % 4 % 3]
        rows.append((i, " ".join(parts)))
    rows += [(60, None), (61, ""), (62, " ".join(shared[2][:11])), (63, " ".join(shared[2][:10]))]
    over = 10
    count = Counter()
    for _, t in rows:
        w = (t or "").split()
        count.update(tuple(w[k:k + over + 1]) for k in range(len(w) - over))
    want = {}
    for i, t in rows:
        w = (t or "").split()
        begin, at = [], 0
        for x in w:
            at = (t or "").index(x, at)
            begin.append(at)
            at += len(x)
        hit = set()
        for k in range(len(w) - over):
            if count[tuple(w[k:k + over + 1])] > 1:
                hit.update(range(begin[k], begin[k + over] + len(w[k + over])))
        want[i] = len(hit)
    df = spark.createDataFrame(rows, "doc_id int, text string").repartition(4).withColumn("N_passage", F.lit("x"))
    got = remove_repeats(df, tell_words=over)
    assert {r.doc_id: r.n_passage for r in got.collect()} == want and any(want.values()) and not all(want.values())
    assert all(r.kept.decode() == (r.text or "") and r.n_removed == 0 for r in got.collect())  # under 400 bytes
    assert got.columns == ["doc_id", "text", "n_bytes", "n_removed", "removed", "kept", "n_passage"]


def test_query_tells_passages(spark, scratch):
    """Repeated strings of over 50 words but under 400 bytes: the query tells
    of them, and what it removes stays that of 400-byte strings."""
    rng = random.Random(13)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    shared, short = " ".join(word() for _ in range(51)), " ".join(word() for _ in range(50))
    own = lambda: " ".join(word() for _ in range(80))
    line = "to be. "
    rows = [(i, f"{own()} q{i} {shared} p{i} {own()}") for i in range(4)]
    rows += [(i, f"{own()} q{i} {short} p{i} {own()}") for i in range(4, 7)]  # 50 words only
    rows += [(7, shared[:-1] + "z " + own()), (8, own()), (9, ""), (10, None), (None, own())]
    rows += [(11, line * 40), (12, f"q {shared}"), (13, own() + " " + line * 30)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    df.repartition(3).write.parquet(f"{scratch}/documents.parquet")
    got = {r.doc_id: r for r in op2_bucket_pointers(spark, scratch).collect()}
    told = {i: len(shared) for i in (0, 1, 2, 3, 12)} | {11: len(line) * 40 - 2, 13: len(line) * 30 - 2}
    assert {i: r.n_passage for i, r in got.items()} == {i: told.get(i, 0) for i, _ in rows}
    want = {i: (a, b, c, hashlib.sha256(k).hexdigest())
            for (i, _), (a, b, c, k) in zip(rows, brute([t for _, t in rows], 400))}
    assert {i: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for i, r in got.items()} == want


def test_single_words_told(spark):
    df = spark.createDataFrame([(0, "a a a b"), (1, "c a. d")], "doc_id int, text string")
    assert {r.doc_id: r.n_passage for r in remove_repeats(df, tell_words=0).collect()} == {0: 3, 1: 1}
