"""Every stage of the corpus pipeline against a direct version, and the whole run."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline as P
from tidemark.llm import leaks

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def lower(t):
    return bytes(c + 32 if 65 <= c <= 90 else c for c in (t or "").encode())


# -- direct versions, each from rows to the rows that stay ---------------------
def language(rows):
    def blank(t):
        low = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c > 127 else 32 for c in (t or "").encode())
        s = b"    " + low + b"   "
        found = [s[i:i + 4] for i in range(len(low) + 4)]
        return [w for w in found if w[:2] != b"  " and w[2:] != b"  "]

    counts = defaultdict(Counter)
    for i, t, lang, *_ in rows:
        if t is not None and lang is not None and zlib.crc32(("" if i is None else str(i)).encode()) % 4 != 2:
            counts[lang].update(blank(t))
    known = {x: {g for g, n in c.items() if n >= sum(c.values()) * 1e-5} for x, c in counts.items()}
    out = []
    for r in rows:
        g = blank(r[1])
        share = max((sum(x in k for x in g) for k in known.values()), default=0) / max(1, len(g))
        assert abs(share - P.MIN_SHARE) > 0.03  # the filters' false positives decide nothing here
        if any(c.isalpha() for c in r[1] or "") and share >= P.MIN_SHARE:
            out.append(r)
    return out


def duplicates(rows):
    def shingles(t):
        w = WORD.findall(lower(t))
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())

    sets = [shingles(r[1]) for r in rows]
    group = list(range(len(rows)))
    for a, x in enumerate(sets):
        for b in range(a):
            y = sets[b]
            if x and y and 100 * len(x & y) >= 80 * len(x | y) and group[a] != group[b]:
                old = group[a]
                group = [group[b] if g == old else g for g in group]
    best = {}
    for g, r in zip(group, rows):
        best[g] = min(best.get(g, r), r, key=lambda r: (r[0] is None, r[0] or 0, str(r)))
    return [r for g, r, s in zip(group, rows, sets) if not s] + [r for g, r in best.items() if sets[g]]


def repeats(rows):
    data = [(r[1] or "").encode() for r in rows]
    places = defaultdict(list)
    for i, v in enumerate(data):
        for p in range(len(v) - 399):
            places[v[p:p + 400]].append((i, p))
    hit = [bytearray(len(v)) for v in data]
    for found in places.values():
        if len(found) > 1:
            for i, p in found:
                hit[i][p:p + 400] = b"\1" * 400
    out = []
    for r, h in zip(rows, hit):
        kept, at = [], 0
        for c in r[1] or "":
            size = len(c.encode())
            if not any(h[at:at + size]):
                kept.append(c)
            at += size
        out.append((r[0], None if r[1] is None else "".join(kept), *r[2:]))
    return out


def clean(rows, items):
    def plain(t):
        return re.findall(rb"[0-9a-z\x80-\xff]+", lower(t))

    def share(item, doc):
        row, best = [0] * (len(item) + 1), 0
        for w in doc:
            new = [0] * (len(item) + 1)
            for j, x in enumerate(item):
                new[j + 1] = max(0, row[j] + (2 if x == w else -1), row[j + 1] - 1, new[j] - 1)
            best, row = max(best, max(new)), new
        return best / (2 * len(item))

    wanted = [plain(t) for _, t in items if plain(t)]
    return [r for r in rows if all(share(x, plain(r[1])) < leaks.MIN_SCORE for x in wanted)]


def packed(rows, pieces):
    """Whether ``pieces`` are those of ``rows``, gapless and in windows of 2048."""
    from public_tokenizers import path
    from tokenizers import Tokenizer

    engine = Tokenizer.from_file(str(path("byte_bpe_50k.json")))
    ids = {r[0]: np.array([*engine.encode(r[1] or "", add_special_tokens=False).ids, 1], "<u4") for r in rows}
    assert len(ids) == len(rows)
    end, total = defaultdict(int), 0
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert (p.sequence_id, p.offset) == divmod(total, 2048) and 0 < p.length <= 2048 - p.offset
        assert p.start == end[p.doc_id] and p.doc_tokens == len(ids[p.doc_id])
        end[p.doc_id] += p.length
        assert p.ids_crc32 == zlib.crc32(ids[p.doc_id][p.start:end[p.doc_id]].tobytes())
        total += p.length
    assert dict(end) == {i: len(x) for i, x in ids.items()}


# -- a fixture with every case ------------------------------------------------
ITEMS = [(i, " ".join(f"quiz{i}the{j}" for j in range(30))) for i in range(4)] + [(9, None), (10, "")]


def corpus():
    rng = random.Random(11)
    words = {x: ["".join(rng.choice(a) for _ in range(rng.randrange(3, 8))) for _ in range(80)]
             for x, a in (("aa", "abcdeé"), ("bb", "klmnoü"))}

    def prose(lang, n):
        return " ".join(rng.choice(words[lang]) for _ in range(n))

    texts = [(x, prose(x, n)) for n in (3, 12, 40, 150, 400) for x in ("aa", "bb") for _ in range(4)]
    base, passage = prose("aa", 150).split(), prose("bb", 90) + " é"
    for k in range(6):  # near copies: chained edits, some between 0.8 and 0.85 of the last
        base = base[:20 * k + 5] + [f"abc{k}é"] * (1 + k % 2) + base[20 * k + 6:]
        texts.append(("aa", " ".join(base)))
    for k in range(5):  # a passage that repeats, cut inside two-byte characters
        texts.append(("bb", prose("bb", 60) + " " + "èéê"[k % 3] + passage + "üöé"[k % 3] + " � " + prose("bb", 60)))
    for k in range(3):
        leak = [w if j % 9 else "edited" for j, w in enumerate(ITEMS[k][1].split())]
        texts.append(("aa", prose("aa", 80) + " " + " ".join(leak) + " " + prose("aa", 80)))
    texts += [("aa", None), (None, None), ("aa", ""), ("bb", " \n"), (None, "12 34 ,.;"), (None, "zzzz xxxx wwww " * 20),
              (None, texts[9][1]), ("bb", texts[10][1].upper().replace("Ü", "ü"))]
    rows = [(i, t, lang, f"src{i % 3}", len(t or "")) for i, (lang, t) in enumerate(texts)]
    rng.shuffle(rows)
    return rows + rows[5:8] + [(None, prose("aa", 50), "aa", None, None)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("stages"))
    spark.createDataFrame(corpus(), SCHEMA).repartition(3).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(ITEMS, "item_id bigint, text string").write.parquet(f"{d}/benchmark.parquet")
    return d


def test_stages_and_run(spark, folder):
    rows = corpus()
    direct = [language, duplicates, repeats, lambda r: clean(r, ITEMS)]
    lost = []
    for (name, stage), version in zip(P.STAGES, direct):
        df = spark.createDataFrame(rows, SCHEMA).repartition(3)
        out = stage(spark, df, folder)
        assert out.columns == df.columns, name
        want = version(rows)
        assert Counter(map(tuple, out.collect())) == Counter(want), name
        lost.append(Counter(rows) != Counter(want))
        rows = want
    assert all(lost)  # every stage had something to do
    packed(rows, P.run(spark, folder).collect())


def test_edge_cases(spark, folder):
    for name, stage in P.STAGES:
        none = spark.createDataFrame([], SCHEMA)
        assert stage(spark, none, folder).count() == 0, name
    odd = [(1, "the same words", "x", 1, "r"), (1, "the same words", "x", 1, "r"), (2, None, None, 2, "s"), (2, None, None, 2, "s")]
    df = spark.createDataFrame(odd, "doc_id int, text string, rec string, size int, node string")
    want = {"near_duplicates": odd[1:], "repeats": odd, "decontaminate": odd}
    for name, stage in P.STAGES[1:4]:
        out = stage(spark, df, folder)
        assert out.columns == df.columns, name
        assert Counter(map(tuple, out.collect())) == Counter(want[name]), name


def test_passages_of_short_words(spark, folder):
    """51 shared words go, however few their bytes; 50 stay."""
    rng = random.Random(5)

    def prose(n, low=2, high=5):
        return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randrange(low, high))) for _ in range(n))

    exact, tiny, short = prose(51), " ".join("abcdefghij"[i * i % 7 + i % 3] for i in range(51)), prose(50)
    assert len(exact) < 300 and len(tiny) == 101
    half = [prose(30), prose(30)]  # two repeats of 30 words side by side are no repeat of 60
    rows = []
    for passage, gone, marks in ((exact, True, ("", "")), (tiny, True, ("(", "!")), (short, False, ("", ""))):
        for k in range(3):
            a, b = f"{prose(40)} u{len(rows)}k", f"v{len(rows)}k {prose(40)}"
            left, right = marks if k == 1 else ("", "")
            rows.append((len(rows), f"{a} {left}{passage}{right} {b}", f"{a} {left}{right} {b}" if gone else None))
    for x in (f"q1q {half[0]} {half[1]} q2q", f"q3q {half[0]} q4q", f"q5q {half[1]} q6q"):
        rows.append((len(rows), x, None))
    df = spark.createDataFrame([(i, t, "aa", "s", len(t)) for i, t, _ in rows], SCHEMA).repartition(3)
    got = {r.doc_id: r.text for r in P.repeated_passages(spark, df, folder).collect()}
    assert got == {i: t if want is None else want for i, t, want in rows}
