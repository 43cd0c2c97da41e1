"""Literal scenarios of FIXTURES.md §4: merge batch by batch and closed-form
replay must both give the stated result."""

import pytest

from helpers import SPEC, as_dict, day, log, merge_all, replay

# (name, rows (batch, key, op, minute, value), expected {key: (v, first, last, deleted)})
CASES = [
    ("insert", [(1, 1, "I", 1, "a")], {1: ("a", day(1), day(1), False)}),
    ("update", [(1, 1, "I", 1, "a"), (2, 1, "U", 2, "b")], {1: ("b", day(1), day(2), False)}),
    ("rapid updates", [(1, 1, "I", 1, "a"), (1, 1, "U", 2, "b"), (1, 1, "U", 3, "c")],
     {1: ("c", day(1), day(1), False)}),
    ("update of unknown key", [(1, 1, "U", 1, "a")], {1: ("a", day(1), day(1), False)}),
    ("soft delete", [(1, 1, "I", 1, "a"), (2, 1, "D", 2, None)],
     {1: ("a", day(1), day(2), True)}),
    ("delete of unknown key", [(1, 1, "D", 1, None)], {}),
    ("insert + delete in one batch", [(1, 1, "I", 1, "a"), (1, 1, "D", 2, None)], {}),
    ("update + delete in one batch",
     [(1, 1, "I", 1, "a"), (2, 1, "U", 2, "b"), (2, 1, "D", 3, None)],
     {1: ("a", day(1), day(2), True)}),
    ("resurrect", [(1, 1, "I", 1, "a"), (2, 1, "D", 2, None), (3, 1, "I", 3, "b")],
     {1: ("b", day(1), day(3), False)}),
    ("update to NULL", [(1, 1, "I", 1, "a"), (2, 1, "U", 2, None)],
     {1: (None, day(1), day(2), False)}),
    ("late event across batches", [(1, 1, "I", 5, "new"), (2, 1, "U", 3, "old")],
     {1: ("old", day(1), day(2), False)}),
    ("tie: D wins", [(1, 1, "I", 1, "a"), (2, 1, "U", 2, "b"), (2, 1, "D", 2, None)],
     {1: ("a", day(1), day(2), True)}),
    ("NULL capture time sorts last", [(1, 1, "I", None, "x"), (1, 1, "U", 1, "a")],
     {1: ("a", day(1), day(1), False)}),
]


@pytest.mark.parametrize("name,rows,expected", CASES, ids=[c[0] for c in CASES])
@pytest.mark.parametrize("path", ["broadcast", "shuffle", "replay"])
def test_scenario(spark, name, rows, expected, path):
    df = log(spark, rows)
    out = replay(df) if path == "replay" else merge_all(spark, df, strategy=path)
    assert as_dict(out) == expected


def test_resurrect_keeps_created_time(spark):
    df = log(spark, [(1, 1, "I", 1, "a"), (2, 1, "D", 2, None), (3, 1, "I", 3, "b")])
    for out in (merge_all(spark, df), replay(df)):
        r = out.collect()[0]
        assert r["src_created_at"].minute == 1 and r["src_updated_at"].minute == 3


def test_late_guard_keeps_newer_state(spark):
    df = log(spark, [(1, 1, "I", 5, "new"), (2, 1, "U", 3, "old")])
    out = merge_all(spark, df, guard_late=True)
    assert as_dict(out) == {1: ("new", day(1), day(1), False)}


def test_unknown_op_reference_semantics(spark):
    """Unquarantined: X inserts an unknown key, is ignored on a known key;
    a NULL op matches no clause."""
    df = log(spark, [(1, 1, "X", 1, "a"), (1, 2, "I", 1, "b"), (2, 2, "X", 2, "c"),
                     (1, 3, None, 1, "n")])
    out = as_dict(merge_all(spark, df))
    assert out == {1: ("a", day(1), day(1), False), 2: ("b", day(1), day(1), False)}
