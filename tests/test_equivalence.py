"""Property: MERGE applied batch by batch == closed-form replay of the log,
for seeded random logs with NULL attributes, ties and random batch splits."""

import random

import pytest

from helpers import log, merge_all, replay

COLS = ["k", "v", "src_created_at", "src_updated_at", "dw_first_seen_at",
        "dw_last_updated_at", "is_deleted"]


def random_log(seed, n=160, keys=12, batches=5):
    rnd = random.Random(seed)
    rows = []
    for _ in range(n):
        rows.append((rnd.randrange(batches), rnd.randrange(keys),
                     rnd.choice("IIUUUD"), rnd.randrange(40),  # minutes: many ties
                     rnd.choice([None, "a", "b", "c", "d"])))
    return rows


def canon(df):
    return sorted(tuple(r[c] for c in COLS) for r in df.collect())


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_merge_equals_replay(spark, seed):
    df = log(spark, random_log(seed)).cache()
    expected = canon(replay(df))
    assert canon(merge_all(spark, df, strategy="broadcast")) == expected
    assert canon(merge_all(spark, df, strategy="shuffle")) == expected


def test_batch_boundaries_matter(spark):
    """I then D of a new key: one batch leaves no row, two leave a deleted row."""
    one = log(spark, [(1, 1, "I", 1, "a"), (1, 1, "D", 2, None)])
    two = log(spark, [(1, 1, "I", 1, "a"), (2, 1, "D", 2, None)])
    assert replay(one).count() == 0
    assert [r["is_deleted"] for r in replay(two).collect()] == [True]
