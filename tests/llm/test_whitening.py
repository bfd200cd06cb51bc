"""Whitening against exact sums and a symmetric eigensolver."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyline.llm.whitening import exact_scatter, fit, one_sided_jacobi, per_component, pivoted_cholesky, whiten

TYPE = "vec_id bigint, embedding array<float>"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v]) for i, v in rows], TYPE)


def numbers(vectors):
    return np.floor(64 * np.float32(vectors).astype(float)).astype(np.int64) + 1_000_000


def test_cholesky_and_rotations_give_the_eigenvectors():
    random = np.random.default_rng(1)
    half = random.standard_normal((40, 25)) * 10.0 ** random.uniform(-4, 2, 25)
    matrix = half @ half.T  # rank 25 of 40
    factor = pivoted_cholesky(matrix)
    assert factor.shape[1] <= 25 + 1 and np.allclose(factor @ factor.T, matrix, rtol=0, atol=1e-10 * matrix.max())
    norms, directions = one_sided_jacobi(factor)
    assert np.allclose(directions.T @ directions, np.eye(len(norms)), atol=1e-12) and (np.diff(norms) <= 0).all()
    assert np.allclose(norms[:20] ** 2, np.linalg.eigvalsh(matrix)[::-1][:20], rtol=1e-9, atol=1e-12 * norms[0] ** 2)
    assert np.allclose(matrix @ directions, directions * norms**2, atol=1e-10 * norms[0] ** 2)


def test_small_eigenvalues_keep_their_digits():
    """Graded columns, where a solver of the matrix itself loses all digits of the small ones."""
    scale = 10.0 ** -np.arange(0, 12)
    random = np.random.default_rng(2)
    root = np.eye(12) + 0.1 * random.standard_normal((12, 12))
    norms, _ = one_sided_jacobi(pivoted_cholesky((root * scale).T @ (root * scale)))
    assert np.allclose(norms, np.sqrt(one_sided_jacobi((root * scale).T)[0] ** 2), rtol=1e-9)


def test_degenerate_matrices():
    assert pivoted_cholesky(np.zeros((3, 3))).shape == (3, 0)
    assert one_sided_jacobi(np.empty((3, 0)))[0].shape == (0,)
    norms, directions = one_sided_jacobi(pivoted_cholesky(4 * np.eye(5)))
    assert norms.tolist() == [2.0] * 5 and np.allclose(np.abs(directions).sum(axis=0), 1)


def test_scatter_is_exact_in_blocks():
    random = np.random.default_rng(3)
    rows = random.integers(-(2**26), 2**26, (500, 3))
    assert (exact_scatter(rows) == rows.T @ rows).all()
    with pytest.raises(OverflowError):
        exact_scatter(np.array([[2**27]]))


@pytest.mark.parametrize("dim", [3, 40])
def test_against_brute_force(spark, dim):
    random = np.random.default_rng(dim)
    vectors = np.float32(random.standard_normal((700, dim)) @ random.standard_normal((dim, dim)) + 100 * random.standard_normal(dim))
    vectors[5] = vectors[6]
    x = numbers(vectors)
    rows = per_component(whiten(frame(spark, enumerate(vectors))), "vec_id").collect()
    count, n, sums = min(dim, 32), len(x), x.sum(axis=0)
    assert len(rows) == n * count and {r.n for r in rows} == {n}
    deviation = [sum(int(n * a - s) ** 2 for a, s in zip(row, sums, strict=True)) for row in x]
    whitened = np.zeros((n, count))
    for r in rows:
        whitened[r.vec_id, r.component - 1] = r.whitened
        assert r.deviation == deviation[r.vec_id] and r.identity_error < 1e-9
    centred = x - x.mean(axis=0)
    covariance = centred.T @ centred / n
    values, directions = np.linalg.eigh(covariance)
    values, directions = values[::-1][:count], directions[:, ::-1][:, :count]
    wanted = centred @ directions / np.sqrt(values)
    signs = np.sign((wanted * whitened).sum(axis=0))
    assert np.allclose(whitened, wanted * signs, atol=1e-6 * np.abs(wanted).max())
    assert {r.component: r.explained for r in rows} == pytest.approx({i + 1: v / np.trace(covariance) for i, v in enumerate(values)}, rel=1e-9)


def test_odd_rows_ties_and_clashing_names(spark):
    odd = [(1, None), (2, []), (3, [1, None]), (4, [float("nan"), 1]), (5, [float("inf"), 1])]
    good = [(None, [0, 0]), (10, [1, 0]), (10, [1, 0]), (11, [0, 2]), (12, [1, 2, 3])]
    df = frame(spark, odd + good)
    for name in ("n", "vector", "dim", "whitened", "component", "place"):
        df = df.withColumn(name, F.lit("clash"))
    out = whiten(df).collect()
    assert sorted((str(r.vec_id), r.n, len(r.whitened), r.vector, r.dim) for r in out) == sorted(
        [("None", 4, 2, "clash", "clash"), ("10", 4, 2, "clash", "clash"), ("10", 4, 2, "clash", "clash"), ("11", 4, 2, "clash", "clash"), ("12", 1, 0, "clash", "clash")]
    )
    assert whiten(frame(spark, odd)).count() == 0 == whiten(df.limit(0)).count()


def test_equal_vectors_have_no_component(spark):
    out = whiten(frame(spark, [(i, [3, -1, 2]) for i in range(50)]))
    assert {(r.n, r.deviation, tuple(r.whitened), r.identity_error) for r in out.collect()} == {(50, 0, (), 0.0)}
    assert per_component(out, "vec_id").count() == 0


def test_a_dimension_that_follows_from_others_is_left_out():
    random = np.random.default_rng(9)
    x = random.integers(-50, 50, (300, 4))
    x = np.hstack([x, x[:, :1] + x[:, 1:2], np.full((300, 1), 7)])
    sums = [int(s) for s in x.sum(axis=0)]
    model = fit(300, sums, exact_scatter(x - np.array([s // 300 for s in sums])), 32)
    assert len(model.values) == 4
    whitened = model.project(x)
    assert np.allclose(whitened.T @ whitened / 300, np.eye(4), atol=1e-12)
