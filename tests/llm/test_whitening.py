"""Whitening against a reference eigensolver, exact integers and brute-force covariances."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from propense.llm import queries, whitening


def whole(v):
    return [int(np.floor(64.0 * float(c))) + 1_000_000 for c in v]


def usable(v):
    return v is not None and len(v) > 0 and all(c is not None and np.isfinite(c) for c in v)


def check(got, rows, k=32):
    """``got``: collected rows of a whitening of ``rows`` (id, vector), ids unique."""
    rows = [(i, whole(v)) for i, v in rows if usable(v)]
    n, size = len(rows), len(rows[0][1])
    sums = [sum(x[j] for _, x in rows) for j in range(size)]
    exact = [[n * x[j] - sums[j] for j in range(size)] for _, x in rows]
    centred = np.array(exact, dtype=object).astype(float) / n
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(k, size, int((values > size * 1e-15 * values[0]).sum()))
    by_row = {}
    for r in got:
        by_row.setdefault(r.vec_id, {})[r.component] = r
        assert r.n == n
    assert set(by_row) == {i for i, _ in rows} and all(sorted(c) == list(range(1, k + 1)) for c in by_row.values())
    white = np.array([[by_row[i][c].whitened for c in range(1, k + 1)] for i, _ in rows])
    for (i, _), numbers in zip(rows, exact):
        assert {int(r.deviation) for r in by_row[i].values()} == {sum(a * a for a in numbers)}
    explained = np.array([by_row[rows[0][0]][c].explained for c in range(1, k + 1)])
    np.testing.assert_allclose(explained, values[:k] / np.trace(covariance), rtol=1e-9)
    error = np.abs(white.T @ white / n - np.eye(k)).max()
    assert error <= 1e-4 and abs(got[0].identity_error - error) < 1e-9
    gaps = np.abs(values[:, None] - values[None, :]) + np.eye(size) * values[0]
    for c in range(k):
        if gaps[c].min() > 1e-6 * values[0]:
            want = centred @ vectors[:, c] / np.sqrt(values[c])
            sign = np.sign(want @ white[:, c])
            np.testing.assert_allclose(white[:, c] * sign, want, rtol=1e-6, atol=1e-6)


def run(spark, rows, **more):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS component", "2 AS n", "3 AS i")
    return whitening.whiten(df.repartition(3), **more)


@pytest.mark.parametrize("n,size", [(40, 3), (500, 40), (10, 40), (2, 1), (7, 64)])
def test_random_vectors(spark, n, size):
    rng = np.random.default_rng(n + size)
    scale = rng.uniform(0.1, 3, size)
    rows = [(k, (rng.standard_normal(size) * scale).astype(np.float32).tolist()) for k in range(n)]
    check(run(spark, rows).collect(), rows)


def test_hard_vectors(spark):
    rng = np.random.default_rng(3)
    rows = [(k, rng.standard_normal(6).astype(np.float32).tolist()) for k in range(60)]
    odd = [None, [], [float("nan")] + [0.0] * 5, [float("inf")] + [0.0] * 5, [None] + [0.0] * 5]
    rows += [(100 + k, v) for k, v in enumerate(odd)] + [(200 + k, [-0.5] * 6) for k in range(30)]
    check(run(spark, rows).collect(), rows)
    # other lengths and entries no whole number has room for are left out too
    more = [(300, [1.0] * 5), (301, [1.0] * 7), (302, [1e30] + [0.0] * 5), (303, [-1e13] + [0.0] * 5)]
    check(run(spark, rows + more).collect(), rows)


def test_repeats_nulls_and_large_numbers(spark):
    rows = [(None, [1.0, 2.0]), (5, [1.0, 2.0]), (5, [1.0, 2.0]), (6, [3.0, -1.0]), (7, [1e9, 3e8]), (8, [-1e9, 7e8])]
    got = run(spark, rows).collect()
    assert len(got) == 12 and {r.n for r in got} == {6}
    whole_rows = [whole(np.float32(v)) for _, v in rows]
    sums = [sum(x[j] for x in whole_rows) for j in range(2)]
    want = sorted(sum((6 * x[j] - sums[j]) ** 2 for j in range(2)) for x in whole_rows for _ in range(2))
    assert sorted(int(r.deviation) for r in got) == want and max(want) > 2**63
    assert max(r.identity_error for r in got) < 1e-4


def test_no_components(spark):
    assert run(spark, []).collect() == []
    assert run(spark, [(1, None), (2, [])]).collect() == []
    assert run(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])]).collect() == []
    few = run(spark, [(1, [1.0, 2.0]), (2, [2.0, 4.0])]).collect()
    assert sorted((r.vec_id, r.component, round(abs(r.whitened), 9)) for r in few) == [(1, 1, 1.0), (2, 1, 1.0)]


def _symmetric(values, seed):
    rng = np.random.default_rng(seed)
    q, _ = np.linalg.qr(rng.standard_normal((len(values), len(values))))
    return (q * values) @ q.T


@pytest.mark.parametrize(
    "values",
    [
        [5.0], [2.0, 2.0], [1.0, 1.0, 1.0, 5.0], list(range(1, 80)), [10.0**-k for k in range(14)], [0.0] * 5 + [1.0],
        [3.0] * 20 + [3.0 + 1e-9] * 20 + [0.0] * 9, [0.0] * 6, [-1.0, 0.0, 1.0], np.random.default_rng(1).random(200).tolist(),
    ],
)
def test_spectrum(values):
    a = _symmetric(values, 5)
    a = (a + a.T) / 2
    found, vectors = whitening.spectrum(a)
    size, norm = len(values), max(np.abs(values))
    np.testing.assert_allclose(found, np.linalg.eigvalsh(a)[::-1], atol=1e-13 * size * max(norm, 1e-300))
    np.testing.assert_allclose(vectors.T @ vectors, np.eye(size), atol=1e-13 * size)
    assert np.abs(a @ vectors - vectors * found).max() <= 1e-13 * size * max(norm, 1e-300)


def test_spectrum_of_special_matrices():
    for a in (np.diag([3.0, 1.0, 2.0]), np.ones((6, 6)), np.eye(7) - 1 / 7, np.kron(np.eye(3), [[0.0, 1.0], [1.0, 0.0]])):
        found, vectors = whitening.spectrum(a)
        np.testing.assert_allclose(found, np.linalg.eigvalsh(a)[::-1], atol=1e-13)
        np.testing.assert_allclose(a @ vectors, vectors * found, atol=1e-13)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(-3, 3), min_size=1, max_size=12), st.integers(0, 1000))
def test_spectrum_with_ties(values, seed):
    a = _symmetric([float(v) for v in values], seed)
    a = (a + a.T) / 2
    found, vectors = whitening.spectrum(a)
    np.testing.assert_allclose(found, sorted(map(float, values), reverse=True), atol=1e-12)
    np.testing.assert_allclose(a @ vectors, vectors * found, atol=1e-12)


def test_polar_factor():
    rng = np.random.default_rng(2)
    for _ in range(20):
        a = rng.standard_normal((9, 9))
        a = a + a.T
        u = whitening.polar(a)
        np.testing.assert_allclose(u @ u, np.eye(9), atol=1e-13)
        assert np.linalg.eigvalsh(u @ a).min() > -1e-12


def test_query(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    got = queries.op13_embedding_whitening(spark, sf_dir)
    assert dict(got.dtypes)["deviation"] == "bigint"
    check(got.collect(), rows)
