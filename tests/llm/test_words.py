"""Word ids: no two words of a text, however built, share one."""

import random

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import common, jaccard, leaks, ppm


def doubling(n, a="a", b="b"):
    """The alternating doubling sequence and its mirror: polynomials modulo a
    power of two give both the same value from about 1024 signs on."""
    x, y = a, b
    while len(x) < n:
        x, y = x + y, y + x
    return x, y


def test_ids_are_those_of_the_words():
    rng = random.Random(1)
    made = ["".join(rng.choice("abAB01é") for _ in range(rng.choice([1, 2, 7, 8, 9, 15, 16, 17, 40]))) for _ in range(4000)]
    for n in (8, 64, 1024, 2048, 4096):
        made += doubling(n)
    made += ["x" * k for k in range(1, 300)] + ["a" * 8 + "b" * 8, "b" * 8 + "a" * 8, "\x00", "\x00" * 2]
    texts = [" ".join(made[k:k + 37]).encode() for k in range(0, len(made), 37)]
    ids, per, first = common.words(texts)
    # As bytes: lower case for A-Z only.
    plain = [w.encode().translate(bytes(common.LOWER.tolist())) for w in made]
    assert per.sum() == len(plain)
    names = {}
    for w, i in zip(plain, ids.tolist()):
        assert names.setdefault(w, i) == i
    assert len(set(names.values())) == len(names)
    at = 0
    for t, n in zip(texts, per):
        assert [t[f:].split()[0] for f in first[at:at + n]] == t.split()
        at += n
    assert [len(x) for x in common.words([])] == [0, 0, 0]
    assert common.words([b"", b"  "])[1].tolist() == [0, 0]


def docs(spark):
    rows = []
    for i, n in enumerate((1024, 2048)):
        x, y = doubling(n)
        rows += [(10 * i + 1, f"{x} {x} {x} {x} {x}"), (10 * i + 2, f"{y} {y} {y} {y} {y}")]
    return spark.createDataFrame(rows, "doc_id bigint, text string")


def test_unlike_texts_are_not_linked(spark):
    df = docs(spark)
    assert jaccard.link_components(df).count() == 0
    kept = corpus_pipeline.near_duplicates(spark, df, "")
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 11, 12]


def test_unlike_words_are_unknown(spark):
    x, y = doubling(1024)
    ids = {False: 1, True: 2}
    df = spark.createDataFrame([(ids[False], x), (ids[True], y)], "doc_id bigint, text string")
    got = {r.doc_id: (r.n_tokens, r.n_known) for r in ppm.score(df, F.col("doc_id") == ids[False]).collect()}
    assert got == {ids[False]: (2, 2), ids[True]: (2, 1)}  # only the end is known


def test_unlike_passages_are_no_leak(spark):
    x, y = doubling(1024)
    items = spark.createDataFrame([(1, f"{x} {x} {x} {x} {x} {x}")], "item_id bigint, text string")
    df = spark.createDataFrame([(1, f"{y} " * 6), (2, f"{x} " * 6)], "doc_id bigint, text string")
    assert [r.doc_id for r in leaks.without_leaks(df, items).select(F.col("doc_id")).collect()] == [1]


def test_short_items_match_whole(spark):
    items = spark.createDataFrame([(1, "the war"), (2, "one two three four five six")], "item_id bigint, text string")
    df = spark.createDataFrame([(1, "the cat sat"), (2, "it was the war again"), (3, "one two three four x y"), (4, "war")],
                               "doc_id bigint, text string")
    left = lambda **k: sorted(r.doc_id for r in leaks.without_leaks(df, items, **k).collect())
    assert left(whole_below=5) == [1, 4] and left() == []
