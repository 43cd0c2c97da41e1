"""Operators against direct versions: nulls, empty and long texts, ties,
repeated rows, empty tables and clashing column names."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import lang_id, leaks, licenses, packing, sharding, token_counts, topk

SF = "/root/testdata/sf0.001"
ODD = [(1, "a plain text"), (2, None), (3, ""), (4, "x" * 300_000), (5, "a plain text"), (5, "a plain text"),
       (None, "nobody's é text"), (7, "\x00\t 12,5 \n"), (8, "你好 \U0001f600 é")]


def frame(spark, rows=ODD, **extra):
    df = spark.createDataFrame(rows, "doc_id int, text string").repartition(3)
    return df.withColumns({k: F.lit(v) for k, v in extra.items()})


def documents(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


# -- op1 ---------------------------------------------------------------------
def test_sharding(spark):
    rows = [(i, "y" * (i % 37)) for i in range(400)] + [(9, "z" * 30)] * 40 + [(None, "n"), (500, None), (501, "w" * 900)]
    limit = 250
    got = sharding.shard(frame(spark, rows, SHARD="mine", rec=1), limit=limit)
    assert [c for c in got.columns if c.lower() == "shard"] == ["shard"] and "rec" in got.columns
    out = [(r.doc_id, r.text, r.shard, r.depth, r.row_bytes, r.shard_bytes) for r in got.collect()]
    assert Counter(o[:2] for o in out) == Counter(rows)

    def bits(key):
        digest = hashlib.md5(("" if key is None else str(key)).encode()).hexdigest()[:15]
        return format(int(digest, 16), "060b")

    size, number, held = Counter(), Counter(), Counter()
    for key, text in rows:
        for d in range(61):
            size[bits(key)[:d]] += len(text or "")
            number[bits(key)[:d]] += 1
    for key, _, shard, depth, own, total in out:
        held[shard] += own
        b = bits(key)
        fit = next((d for d in range(61) if size[b[:d]] <= limit or number[b[:d]] == 1), None)
        if fit is None:  # equal keys: pages
            assert shard.startswith(b + ".") and total <= limit
        else:
            assert (shard, depth, total) == (b[:fit], fit, size[b[:fit]])
    assert all(held[o[2]] == o[5] for o in out)
    assert sharding.shard(frame(spark).where("false")).count() == 0


def test_pages_of_one_key(spark, monkeypatch):
    def sizes(df, limit, **k):
        out = sharding.shard(df, key="source", limit=limit, **k).collect()
        held = Counter()
        for r in out:
            held[r.shard] += r.row_bytes
        assert all(held[r.shard] == r.shard_bytes and (r.shard_bytes <= limit or r.row_bytes == r.shard_bytes) for r in out)
        return out, held

    same = spark.createDataFrame([("web", "x" * 50, i) for i in range(300)], "source string, text string, n int")
    out, held = sizes(same, 1000)
    assert len(out) == 300 and len(held) == 15  # twenty rows of fifty bytes a page
    # Unlike rows whose nulls are swapped, equal rows, and rows over the limit.
    rows = [("web", "y" * 900, None, 5), ("web", "y" * 900, 5, None)] + [("web", "z" * 400, 1, 1)] * 30 + [("web", "w" * 5000, 2, 2)] * 3
    odd = spark.createDataFrame(rows, "source string, text string, a int, b int").repartition(4)
    out, held = sizes(odd, 1000)
    assert len(out) == len(rows) and sorted(held.values())[-3:] == [5000] * 3
    # A third of all rows have one key; several tasks share it.
    monkeypatch.setattr(sharding, "PAGES", 2)
    rng = random.Random(3)
    mixed = [("hot" if i % 3 == 0 else f"s{i % 400}", "t" * rng.randrange(200), i) for i in range(1500)]
    df = spark.createDataFrame(mixed, "source string, text string, n int").repartition(6)
    out, held = sizes(df, 2000)
    assert sorted((r.source, r.text, r.n) for r in out) == sorted(mixed)
    pages = {r.shard for r in out if r.source == "hot"}
    assert len({p.split(".")[1] for p in pages}) > 5  # tasks
    total = sum(len(t) for s, t, _ in mixed if s == "hot")
    assert len(pages) <= total / 2000 * 1.5 + 2


# -- op3 ---------------------------------------------------------------------
#: The scrubbed strings, told without regard to time.
PLAIN = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}|\+?[0-9][0-9() .-]{5,}[0-9]"


def test_scrubbed_strings(spark):
    rng = random.Random(8)
    rows = [(i, "".join(rng.choice(["a", "b.c", "@", "@x.org", "1", "23 45", "(555) ", "-", " ", "+", ".", "é", "9"])
                        for _ in range(rng.randrange(30)))) for i in range(3000)]
    got = frame(spark, rows).withColumn("edits", token_counts.scrub_edits(F.col("text"))).collect()
    for r in got:
        want = [(m.start(), m.end(), "[removed]") for m in re.finditer(PLAIN, r.text)]
        assert [tuple(e) for e in r.edits] == want


def test_segment_trees(spark):
    rows = ODD + [(13, "y" * 3_000_000), (14, "longword" * 30_000 + "@b.org"), (10, "mail a.b@c.org or +1 (555) 010-9999 now " * 40), (11, " " * 500 + "1234567 end"),
                                            (12, "abc" * 20_000 + " a@b.cc")]
    df = frame(spark, rows, n_tokens="mine").withColumn("edits", token_counts.scrub_edits(F.col("text")))
    for r in token_counts.count_edited(df).collect():
        # Each start is tried on short texts only; no match ends inside an address's run in the long ones.
        pattern = PLAIN if len(r.text or "") < 100_000 else r"(?<![A-Za-z0-9._%+-])" + PLAIN.replace("+@", "++@", 1)
        after = re.sub(pattern, "[removed]", r.text or "")
        assert r.n_tokens == token_counts.tokens(r.text or "")
        assert r.n_edits == len(re.findall(pattern, r.text or ""))
        assert r.n_tokens_after == token_counts.tokens(after)
        assert bool(r.encoded_chars) == bool(r.n_edits)
    assert token_counts.count_edited(df.where("false")).count() == 0


# -- op5 ---------------------------------------------------------------------
def test_language_filters(spark):
    got = {r.doc_id: r for r in lang_id.op5_language_filters(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(got) == len(docs)
    judged = [d for d in docs if d.lang and zlib.crc32(str(d.doc_id).encode()) % 4 == 2
              and len((d.text or "").split()) >= 5 and sum(c.isalpha() or c == " " for c in d.text) > 0.9 * len(d.text)]
    assert all(got[d.doc_id].held_out for d in judged)
    assert sum(got[d.doc_id].lang_pred == d.lang for d in judged) >= 0.95 * len(judged) > 0
    model = lang_id.learn(spark.read.parquet(f"{SF}/documents.parquet"))
    odd = [(r.doc_id, r.lang_pred, r.score) for r in lang_id.identify(frame(spark, lang_pred=1, rec="x"), model).collect()]
    assert len(odd) == len(ODD) and all(0 <= s <= 1 for *_, s in odd)
    assert {i for i, p, _ in odd if p == "und"} == {2, 3, 7}
    nothing = lang_id.learn(frame(spark, lang=None).withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in lang_id.identify(frame(spark), nothing).collect()} == {"und"}
    assert lang_id.identify(frame(spark).where("false"), model).count() == 0


# -- op6 ---------------------------------------------------------------------
def test_top_k(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.integers(-2, 3, 4) / 2]) for i in range(60)]
    rows += [(60, None), (61, [1.0, None, 0.0, 0.0]), (62, [float("nan"), 0.0, 0.0, 0.0]), (80, [float("inf"), 0.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id int, embedding array<float>").withColumn("score", F.lit("x"))
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in topk.top_k(df, F.col("vec_id") % 20 == 0, k=7).collect())
    want = []
    for q in (0, 20, 40):
        v = [int(np.floor(64 * x)) for x in rows[q][1]]
        best = sorted((-sum(a * int(np.floor(64 * b)) for a, b in zip(v, rows[c][1])), c) for c in range(60) if c != q)
        want += [(q, i + 1, c, -s) for i, (s, c) in enumerate(best[:7])]
    assert got == sorted(want)
    # Few components each: short postings, and rows that share none with a query.
    thin = [(i, [float(rng.integers(-9, 9)) if rng.random() < .06 else 0.0 for _ in range(30)]) for i in range(200)]
    got = topk.top_k(spark.createDataFrame(thin, "vec_id int, embedding array<double>"), F.col("vec_id") % 40 == 0, k=9)
    want = []
    for q in range(0, 200, 40):
        best = sorted((-sum(int(64 * a) * int(64 * b) for a, b in zip(thin[q][1], thin[c][1])), c) for c in range(200) if c != q)
        want += [(q, i + 1, c, -s) for i, (s, c) in enumerate(best[:9])]
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got.collect()) == want
    assert len(topk.top_k(df.where("vec_id < 3"), F.col("vec_id") == 0).collect()) == 2
    assert topk.top_k(df.where("false"), F.lit(True)).count() == 0


# -- op7 ---------------------------------------------------------------------
def test_packing(spark):
    from public_tokenizers import path
    from tokenizers import Tokenizer

    engine = Tokenizer.from_file(str(path("byte_bpe_50k.json")))
    rows = ODD + documents(spark)[:60]
    got = packing.pack(frame(spark, rows, start="mine"), window=64, with_ids=True).collect()
    cells, whole = {}, defaultdict(dict)
    for r in got:
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length and r.length > 0
        for i, x in enumerate(np.frombuffer(r.ids, "<u4").tolist()):
            at = r.sequence_id * 64 + r.offset + i
            assert at not in cells
            cells[at] = x
            whole[at - r.start - i, r.doc_id, r.text, r.doc_tokens][r.start + i] = x
    assert sorted(cells) == list(range(len(cells)))  # one short window at most
    want = Counter((i, tuple([*engine.encode(t or "", add_special_tokens=False).ids, 1])) for i, t in rows)
    assert Counter((k[1], tuple(v[i] for i in range(k[3]))) for k, v in whole.items()) == want
    assert packing.pack(frame(spark).where("false")).count() == 0


# -- op8 ---------------------------------------------------------------------
def plain(t):
    return re.findall(rb"[0-9a-z\x80-\xff]+", (t or "").lower().encode())


def best_share(item, doc):
    """Smith-Waterman over whole texts: share of the item's best score."""
    row = [0] * (len(item) + 1)
    best = 0
    for w in doc:
        new = [0] * (len(item) + 1)
        for j, x in enumerate(item):
            new[j + 1] = max(0, row[j] + (2 if x == w else -1), row[j + 1] - 1, new[j] - 1)
        best = max(best, max(new))
        row = new
    return best / (2 * len(item)) if item else 0.0


def test_leaks(spark):
    items = [(i, " ".join(f"q{i}w{j}" for j in range(30))) for i in range(5)] + [(9, None), (10, ""), (11, "one two"), (0, None)]
    noise = " ".join(f"n{j}" for j in range(200))
    edited = " ".join(w if j % 8 else "changed" for j, w in enumerate(items[2][1].split()))
    rows = [(1, f"{noise} {items[0][1].upper()} {noise}"), (2, f"{noise} {edited}."), (3, noise), (4, None), (5, ""),
            (6, items[1][1]), (6, items[1][1]), (7, " ".join(items[3][1].split()[:6]) + noise), (None, items[4][1])]
    rows += [(100 + i, f"{items[0][1]} {noise} copy{i}") for i in range(150)]  # a leak that many texts repeat
    bench = spark.createDataFrame(items, "item_id int, text string")
    docs = frame(spark, rows, item_id="mine", score=1)
    found = {(r.doc_id, r.item_id) for r in leaks.find_leaks(docs, bench).collect()}
    want = {(i, k) for i, t in rows for k, x in items if plain(x) and best_share(plain(x), plain(t)) >= leaks.MIN_SCORE}
    assert found == want
    clean = leaks.without_leaks(docs, bench)
    hit = {i for i, _ in want}
    assert Counter(r.doc_id for r in clean.collect()) == Counter(i for i, _ in rows if i not in hit)
    assert clean.columns == docs.columns
    assert leaks.without_leaks(docs, bench.where("false")).count() == len(rows)
    assert leaks.find_leaks(docs.where("false"), bench).count() == 0


# -- op9 ---------------------------------------------------------------------
def test_licenses(spark):
    extra = [(-1, "CC BY cc by, CC-BY-SA 4.0"), (-2, "under the MIT License\nand the Apache License, Version 2.0"),
             (-3, "GNU Lesser General Public License version 3; GNU General Public License")]
    rows = documents(spark) + ODD + extra
    got = licenses.scan(frame(spark, rows, labels="mine", hits=1)).collect()
    assert len(got) == len(rows)
    word = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    for r in got:
        low = bytes(c + 32 if 65 <= c <= 90 else c for c in (r.text or "").encode())
        w = word.findall(low)
        places = [(i, label) for phrase, label in licenses.BASE for k in [phrase.encode().split()]
                  for i in range(len(w) - len(k) + 1) if w[i:i + len(k)] == k]
        at = [i for i, _ in places]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (len(w), len(at), min(at, default=None), max(at, default=None))
        assert r.base_labels == ",".join(sorted({x for _, x in places}))
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
    by = {r.doc_id: r.labels.split(",") for r in got}
    assert "cc-by-sa-4.0" in by[-1] and "apache-2.0" in by[-2] and "lgpl-3" in by[-3] and "gpl" in by[-3]
    assert licenses.scan(frame(spark).where("false")).count() == 0


def samples_of(parts):
    """Every text that a parsed regex stands for."""
    out = [""]
    for op, x in list(parts):
        name = str(op)
        if name == "LITERAL":
            more = [chr(x)]
        elif name == "IN":
            more = [chr(c) for _, c in x]
        elif name == "BRANCH":
            more = [t for b in x[1] for t in samples_of(b)]
        elif name == "SUBPATTERN":
            more = samples_of(x[3])
        else:
            assert name == "MAX_REPEAT" and x[:2] == (0, 1)
            more = ["", *samples_of(x[2])]
        out = [a + b for a in out for b in more]
    return out


def test_license_rules_alone(spark):
    """Every text that a rule matches is found where it stands alone."""
    rows = [(x, label) for _, regex, label, *_ in licenses.rules() for x in samples_of(re._parser.parse(regex))]
    assert len(rows) > 1000
    rows += [("Licensed under the LGPL 2.1", "lgpl-2.1"), ("AGPL v3", "agpl-3"), ("SPDX-License-Identifier: MPL-2.0", "mpl-2.0"),
             ("SPDX-License-Identifier: LGPL-2.1", "lgpl-2.1"), ("the Expat License", "mit"), ("ODbL", "odbl")]
    df = spark.createDataFrame(rows, "text string, want string").repartition(8)
    lost = [(r.text, r.want, r.labels) for r in licenses.scan(df).collect()
            if r.want not in r.labels.split(",")]
    assert not lost, lost[:20]


def test_packing_added_tokens(spark):
    """The string of an added token is its id, in Latin and in other texts."""
    from public_tokenizers import path
    from tokenizers import Tokenizer

    engine = Tokenizer.from_file(str(path("byte_bpe_50k.json")))
    rows = [(1, "a <|endoftext|> b"), (2, "<|endoftext|><|endoftext|>"), (3, "你好<|endoftext|>é"), (4, "a <|endoftext| > b")]
    want = {i: [*engine.encode(t, add_special_tokens=False).ids, 1] for i, t in rows}
    assert want[1] == [64, 220, 50256, 275, 1]
    got = defaultdict(dict)
    for r in packing.pack(frame(spark, rows), window=5, with_ids=True).collect():
        got[r.doc_id].update(enumerate(np.frombuffer(r.ids, "<u4").tolist(), r.start))
    assert {i: [x[k] for k in sorted(x)] for i, x in got.items()} == want


def test_leaks_in_common_prose(spark):
    """A copy with its two rare words edited is found however common the rest is."""
    common = [f"c{j}" for j in range(24)]
    item = common[:8] + ["rare1"] + common[8:16] + ["rare2"] + common[16:]
    copy = [w if not w.startswith("rare") else "edited" for w in item]
    filler = [" ".join(f"f{i}x{j}" for j in range(5)) for i in range(150)]
    rows = [(1, f"some words {' '.join(copy)} and more")]
    # Each common gram in 150 documents, every time between other words.
    rows += [(10 + i, " ".join(f"{x}{j} {' '.join(common[j:j + 4])}" for j in range(21))) for i, x in enumerate(
        f.replace(" ", "") for f in filler)]
    bench = spark.createDataFrame([(0, " ".join(item))], "item_id int, text string")
    want = {i for i, t in rows if best_share(plain(" ".join(item)), plain(t)) >= leaks.MIN_SCORE}
    assert 1 in want
    assert {r.doc_id for r in leaks.find_leaks(frame(spark, rows), bench).collect()} == want
    assert {r.doc_id for r in leaks.without_leaks(frame(spark, rows), bench).collect()} == {i for i, _ in rows} - want


def test_leaks_edited_to_the_threshold(spark, monkeypatch):
    """Copies with words replaced, dropped and put in, up to the score that makes
    a leak and beyond, and short items in longer texts, against whole alignments."""
    rng = random.Random(3)
    vocabulary = [f"w{j}" for j in range(60)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(n))) for i, n in enumerate((24, 24, 40, 9, 5, 4, 3))]
    items += [(20, "one two"), (21, "three"), (22, " ".join(f"u{j}" for j in range(24)))]
    own = items[-1][1].split()
    rows = [" ".join(w if j % 4 else "changed" for j, w in enumerate(own)), " changed ".join(own), " a changed b ".join(own),
            "zero one two more", "one and nothing else", "a three in a text", "text without", f"{items[0][1]} {items[0][1]}"]
    for _ in range(300):
        words = rng.choice(items)[1].split()
        rate, out = rng.choice((0.2, 0.35, 0.45, 0.5, 0.55, 0.6)), []
        for w in words:
            x = rng.random()
            out += [f"x{rng.randrange(99)}"] if x < rate / 2 else [] if x < rate * 0.75 else [w, "put"] if x < rate else [w]
        around = [" ".join(rng.choice((f"y{rng.randrange(99)}", rng.choice(vocabulary))) for _ in range(rng.randrange(30))) for _ in "ab"]
        rows.append(f"{around[0]} {' '.join(out)} {around[1]}")
    rows = list(enumerate(rows))
    shares = {(i, k): best_share(plain(x), plain(t)) for i, t in rows for k, x in items}
    want = {p: s for p, s in shares.items() if s >= leaks.MIN_SCORE}
    assert {(0, 22), (1, 22), (3, 20), (4, 20), (5, 21)} <= set(want) and (2, 22) not in want
    assert sum(s < 0.55 for s in want.values()) > 20 and sum(0.4 < s < 0.5 for s in shares.values()) > 20
    bench = spark.createDataFrame(items, "item_id int, text string")
    found = leaks.find_leaks(frame(spark, rows), bench).collect()
    best = defaultdict(float)
    for r in found:
        best[r.doc_id, r.item_id] = max(best[r.doc_id, r.item_id], r.score)
    assert best == want
    assert sorted(r.stop for r in found if (r.doc_id, r.item_id) == (7, 0)) == [24, 48]
    assert {r.doc_id for r in leaks.without_leaks(frame(spark, rows), bench).collect()} == set(range(len(rows))) - {i for i, _ in want}
    # Few hits at a time give the same regions.
    block = leaks.Items([k for k, _ in items], [x.encode() for _, x in items])
    ids, per, _ = leaks.words([t.encode() for _, t in rows], leaks._SEPARATORS)
    whole = sorted(block.regions(ids, per))
    monkeypatch.setattr(leaks, "HITS", 5)
    assert sorted(block.regions(ids, per)) == whole
