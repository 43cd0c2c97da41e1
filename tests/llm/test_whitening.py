"""Whitening against exact sums and numpy's symmetric eigensolver."""

from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import whitening

SF = "/root/testdata/sf0.001"


def direct(vectors):
    """n, exact deviations, eigenvalues, eigenvectors, centred vectors."""
    x = [[int(np.floor(1024 * c)) + 100_000 for c in v] for v in vectors]
    n, s = len(x), [sum(c) for c in zip(*x)]
    deviation = [sum((n * a - b) ** 2 for a, b in zip(row, s)) for row in x]
    y = np.array([[float(Fraction(n * a - b, n)) for a, b in zip(row, s)] for row in x])
    values, base = np.linalg.eigh(y.T @ y / n)
    return n, deviation, values[::-1], base[:, ::-1].T, y


def check(got, ids, vectors, k=8):
    n, deviation, values, base, y = direct(vectors)
    assert len(got) == len(ids) * k
    at = {i: p for p, i in enumerate(ids)}
    w = np.zeros((len(ids), k))
    for r in got:
        w[at[r.vec_id], r.component - 1] = r.whitened
        assert r.n == n and r.deviation == deviation[at[r.vec_id]] and 0 <= r.identity_error < 1e-9
        assert abs(r.explained * values.sum() / values[r.component - 1] - 1) < 1e-9
    want = y @ base[:k].T / np.sqrt(values[:k])
    sign = np.sign((w * want).sum(0))
    assert np.abs(w - want * sign).max() < 1e-6
    assert np.abs(w.T @ w / n - np.eye(k)).max() < 1e-9


def test_query(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    got = whitening.op13_cholesky_jacobi(spark, SF)
    assert got.columns[:7] == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert dict(got.dtypes)["deviation"] == "bigint"
    check(got.collect(), [r.vec_id for r in rows], [r.embedding for r in rows])


def test_odd_rows(spark):
    rng = np.random.default_rng(1)
    base = (rng.normal(size=(90, 5)) * [9, 4, 2, 1, .5]).astype(np.float32).tolist()
    rows = [(i, v) for i, v in enumerate(base)]
    odd = [(100, None), (101, [1.0, None, 0.0, 0.0, 0.0]), (102, [float("nan")] + [0.0] * 4), (103, [float("-inf")] + [0.0] * 4),
           (104, []), (105, [1.0, 2.0]), (106, [1e30] + [0.0] * 4)]
    df = spark.createDataFrame(rows + odd, "vec_id int, embedding array<float>").repartition(5).withColumns(
        {"N": F.lit("mine"), "rec": F.lit(1), "i": F.lit(2)})
    got = whitening.whiten(df, k=5)
    assert got.columns == ["vec_id", "embedding", "rec", "i", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check(got.collect(), list(range(90)), base, k=5)
    assert len(whitening.whiten(df, k=3).collect()) == 270 and whitening.whiten(df).count() == 450
    # Repeated rows and null ids are rows like others.
    twice = df.union(df).withColumn("vec_id", F.lit(None).cast("int"))
    assert {r.n for r in whitening.whiten(twice).select("n").collect()} == {180}


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0]), (2, [1.0])], [(1, [])]])
def test_no_component(spark, rows):
    df = spark.createDataFrame(rows, "vec_id int, embedding array<double>")
    assert whitening.whiten(df).collect() == []


def test_rank(spark):
    rows = [(i, [float(i), 2.0 * i, 7.0, float(i % 3)]) for i in range(30)]  # two of four dimensions count
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id int, embedding array<double>")).collect()
    assert {r.component for r in got} == {1, 2} and len(got) == 60
    assert abs(sum({r.component: r.explained for r in got}.values()) - 1) < 1e-12


def test_large_entries_stay_exact(spark):
    vectors = [[2.0 ** 31 + i, float(i * i), -2.0 ** 20 * i] for i in range(40)]
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id int, embedding array<double>")
    _, deviation, values, *_ = direct(vectors)
    got = whitening.whiten(df, k=1).collect()
    assert {r.vec_id: int(r.deviation) for r in got} == dict(enumerate(deviation))
    assert abs(got[0].explained - values[0] / values.sum()) < 1e-9


def test_factor_and_rotations():
    rng = np.random.default_rng(3)
    a = rng.normal(size=(40, 17)) * 10.0 ** rng.integers(-3, 4, 17)
    v = a.T @ a / 40
    order, low = whitening.pivoted_cholesky(v)
    assert np.allclose(low, np.tril(low)) and np.allclose(low @ low.T, v[np.ix_(order, order)], rtol=1e-12)
    assert (np.diff(low.diagonal()) <= 1e-9).all()
    values, unit = whitening.eigen(v)
    assert np.allclose(unit @ unit.T, np.eye(17), atol=1e-13)
    assert np.abs(v @ unit.T - unit.T * values).max() < 1e-13 * values[0]
    # Small eigenvalues keep their digits: the singular values of the data itself.
    want = np.linalg.svd(a, compute_uv=False) ** 2 / 40
    assert np.allclose(values, want, rtol=1e-5)
