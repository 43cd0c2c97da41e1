"""Jaccard components against all pairs."""

import random
import re

from tidemark.llm.jaccard import near_duplicates, op10_vertical_partitions

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def sets(text, n=4):
    raw = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())
    w = WORD.findall(raw)
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} or ({tuple(w)} if w else set())


def brute(rows):
    got = [(i, sets(t)) for i, t in rows]
    parent = list(range(len(got)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(got)):
        for b in range(a):
            x, y = got[a][1], got[b][1]
            if x and y and min(len(x), len(y)) * 100 >= 85 * max(len(x), len(y)):
                both = len(x & y)
                if 100 * both >= 85 * (len(x) + len(y) - both):
                    parent[root(a)] = root(b)
    low = {}
    for a, (i, _) in enumerate(got):
        r = root(a)
        low[r] = i if low.get(r) is None else (low[r] if i is None else min(low[r], i))
    return sorted(((i, len(s), low[root(a)]) for a, (i, s) in enumerate(got)), key=repr)


def check(spark, rows):
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in near_duplicates(df).collect()), key=repr)
    assert got == brute(rows)


def edited(rng, words, n):
    w = list(words)
    for _ in range(n):
        i = rng.randrange(len(w))
        w[i:i + 1] = rng.choice(([], [f"e{rng.randrange(10**6)}"], [w[i], "x"]))
    return " ".join(w)


def test_near_copies(spark):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(300)]
    rows = [(None, "a b c"), (None, "A  b\tc"), (7, None), (8, ""), (9, " \n"), (7, None), (10, "one"), (11, "ONE"),
            (12, "a b c"), (13, "É b c d e f"), (14, "é b c d e f")]
    for k in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.choice((5, 12, 40, 64, 130, 300)))]
        for _ in range(rng.choice((1, 3, 25))):
            rows.append((100 + len(rows), edited(rng, base, rng.randrange(max(1, len(base) // 25) + 1))))
    rows += rows[20:30]
    rng.shuffle(rows)
    check(spark, rows)


def test_chain_and_small_sets(spark):
    # Each links with its neighbours only: one component end to end.
    words = [f"c{i}" for i in range(60)]
    rows = [(i, " ".join(words[i:i + 45])) for i in range(12)]
    rows += [(50 + i, " ".join("xy"[(i >> b) & 1] for b in range(7))) for i in range(128)]
    check(spark, rows)


def test_empty_and_clashing(spark):
    assert near_duplicates(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0
    df = spark.createDataFrame([(1, "a b", 5, "n"), (2, "a b", 6, "m")], "doc_id bigint, text string, k int, node string")
    out = near_duplicates(df)
    assert out.columns == ["doc_id", "text", "k", "node", "n_shingles", "component_id"]
    assert sorted(map(tuple, out.collect())) == [(1, "a b", 5, "n", 1, 1), (2, "a b", 6, "m", 1, 1)]


def test_query(spark):
    d = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in op10_vertical_partitions(spark, d).collect()), key=repr)
    assert got == brute(rows)


def test_common_fragments_bring_few_together(spark, monkeypatch):
    from tidemark.llm import jaccard

    rng, sizes, real = random.Random(5), [], jaccard.materialise

    def counted(df, name, **options):
        out = real(df, name, **options)
        if name == "near":
            sizes.append(out.count())
        return out

    monkeypatch.setattr(jaccard, "materialise", counted)
    base = [f"b{i}" for i in range(80)]
    jaccard.link_components(spark.createDataFrame([(edited(rng, base, 1),) for _ in range(12)], "text string").repartition(1))
    assert 0 < sizes[-1] < 0.9 * sizes[-2]  # texts like each other have most buckets in common


def test_unlinked_texts_of_a_hot_group_are_not_all_compared(spark, monkeypatch):
    from tidemark.llm import jaccard

    rng, sizes, real = random.Random(8), {}, jaccard.materialise

    def counted(df, name, **options):
        out = real(df, name, **options)
        sizes[name] = sizes.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(jaccard, "materialise", counted)
    # Words left out of one text, up to six: alike in most fragments, often not linked.
    base, rows = [f"b{i}" for i in range(120)], []
    for i in range(240):
        out = set(rng.sample(range(120), rng.randrange(7)))
        rows.append((i, " ".join(w for j, w in enumerate(base) if j not in out)))
    # Two groups with half their text in common, one of texts unlike their group's first.
    for i in range(60):
        other = [f"c{j}" for j in range(60)] + base[60:]
        for _ in range(i % 9):
            other.pop(rng.randrange(len(other)))
        rows.append((1000 + i, " ".join(other)))
    want = brute(rows)
    assert len({c for _, _, c in want}) > 40
    check(spark, rows)
    assert sizes["pairs"] < 2 * len(rows)  # not every pair of a bucket


def test_differences_come_from_one_comparison(spark, monkeypatch):
    from tidemark.llm import jaccard

    made, plans, real = {}, {}, jaccard.materialise

    def noted(df, name, **options):
        out = real(df, name, **options)
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        if name in ("parts", "alone", "compared", "family"):
            made.setdefault(name, []).append([r.asDict(True) for r in out.collect()])
        return out

    monkeypatch.setattr(jaccard, "materialise", noted)
    rng, base, rows = random.Random(9), [f"b{i}" for i in range(120)], []
    for i in range(60):
        out = set(rng.sample(range(120), rng.randrange(7)))
        rows.append((i, " ".join(w for j, w in enumerate(base) if j not in out)))
    rows += rows[:9]
    check(spark, rows)

    def name(node):
        return node["s1"], node["s2"]

    whole, alone = {}, {}
    (parts,), (compared,), (family,) = made["parts"], made["compared"], made["family"]
    for r in parts:
        whole.setdefault(name(r["node"]), []).extend(r["own"])
    assert len(parts) == jaccard.PARTS * len(whole)  # copies are cut once
    apart = {}
    for r in compared:
        apart.setdefault((name(r["x"]), name(r["y"])), []).extend(r["apart"])
    assert len(compared) == jaccard.PARTS * len(apart) and len(family) == len(apart)
    for r in family:
        x, y = set(whole[name(r["x"])]), set(whole[name(r["y"])])
        got = apart[name(r["x"]), name(r["y"])]
        assert len(got) == len(set(got)) and set(got) == x ^ y and r["both"] == len(x & y)
    assert "own#" not in plans["seeds"]  # the sets are not met again
    often = {}
    for own in whole.values():
        for h in own:
            often[h] = often.get(h, 0) + 1
    assert len(made["alone"]) == 2  # half of the n-grams is shuffled at a time
    for r in (r for half in made["alone"] for r in half):
        alone[name(r["node"])] = alone.get(name(r["node"]), 0) + r["alone"]
    want = {k: sum(often[h] == 1 for h in own) for k, own in whole.items()}
    assert alone == {k: v for k, v in want.items() if v}
