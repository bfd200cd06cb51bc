"""Hard negatives against brute force in whole numbers."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyline.llm import hard_negatives as module
from tallyline.llm.hard_negatives import best_places, hard_negatives
from tallyline.llm.residues import PRIMES, TERMS, exact_products, primes_for

TYPE = "vec_id bigint, label int, embedding array<float>"


def expected(rows, every=100, count=5):
    """Rows are (id, label, vector); results as sorted tuples."""
    numbers = [(i, label, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, label, v in rows]
    out = []
    for at, (anchor, label, a) in enumerate(numbers):
        if anchor % every:
            continue
        scored = [(-sum(x * y for x, y in zip(a, v, strict=True)), i, own) for j, (i, own, v) in enumerate(numbers) if j != at]
        for s, positive, _ in sorted((x for x in scored if x[2] == label), key=lambda x: x[:2])[:count]:
            fit = sorted(x[:2] for x in scored if x[2] != label and 80 * -s <= 100 * -x[0] <= 100 * -s)[:count]
            out += [(anchor, positive, rank, i, -s, -t) for rank, (t, i) in enumerate(fit, 1)]
    return sorted(out)


def found(df, **names):
    return sorted(map(tuple, hard_negatives(df, **names).collect()))


@pytest.mark.parametrize(("most", "dim"), [(1, 1), (300, 64), (2**20, 200), (2**28, 64), (2**30, 3)])
def test_products_are_exact(most, dim):
    random = np.random.default_rng(most)
    a, b = random.integers(-most, most + 1, (20, dim)), random.integers(-most, most + 1, (30, dim))
    a[0], b[0], b[1] = most, most, -most
    assert (exact_products(a, b) == a.astype(object) @ b.T.astype(object)).all()


def test_products_that_do_not_fit_are_refused():
    with pytest.raises(OverflowError):
        exact_products(np.array([[2**62, 2**62]]), np.array([[2, 2]]))


def test_primes_keep_single_precision_exact_and_numbers_apart():
    assert all(TERMS * (p // 2) ** 2 < 2**24 for p in PRIMES)
    assert np.prod([float(p) for p in primes_for(2**40)]) > 2**41 and primes_for(0) == []


def test_best_places_break_ties_by_place():
    scores = np.array([3, 9, 9, 1, 9, 9])
    assert best_places(scores, np.array([1, 1, 0, 1, 1, 1], bool), 2).tolist() == [1, 4]
    assert best_places(scores, np.zeros(6, bool), 2).tolist() == []


def test_against_brute_force_over_many_cells(spark, monkeypatch):
    monkeypatch.setattr(module, "ROW_BLOCK", 100)
    monkeypatch.setattr(module, "ANCHOR_BLOCK", 3)
    random = np.random.default_rng(1)
    centres = random.standard_normal((12, 6))
    rows = [(i * 5, int(random.integers(0, 3)), centres[i % 12] + 0.2 * random.standard_normal(6)) for i in range(400)]
    rows = [(i, 0 if i % 3 == 0 else label, v) for i, label, v in rows]  # a label of a third and more
    df = spark.createDataFrame([(i, label, v.tolist()) for i, label, v in rows], TYPE)
    want = expected(rows)
    assert want and found(df) == want


def test_ties_repeated_rows_and_a_vector_that_most_rows_hold(spark):
    rows = [(i, i % 2, [1.0, 0.5]) for i in range(300)] + [(0, 0, [1.0, 0.5]), (0, 0, [0.5, 1.0]), (100, 1, [-1.0, -1.0])]
    df = spark.createDataFrame(rows, TYPE)
    assert found(df) == expected(rows)


def test_odd_rows_take_no_part(spark):
    good = [(0, 1, [1.0, 1.0]), (1, 1, [1.0, 0.9]), (2, 2, [0.9, 0.9]), (3, 2, [0.0, 0.0])]
    odd = [(4, None, [1.0, 1.0]), (5, 2, None), (6, 2, [1.0, None]), (7, 2, [float("nan"), 1.0]), (8, 2, [float("inf"), 1.0]),
           (None, 2, [1.0, 1.0]), (9, 2, []), (10, 2, [1.0, 1.0, 1.0])]
    df = spark.createDataFrame(good + odd, TYPE)
    for name in ("dim", "uid", "score", "vector", "rank", "number"):
        df = df.withColumn(name, F.lit("clash"))
    assert expected(good) and found(df) == expected(good)
    assert found(df.limit(0)) == []


def test_windows_at_their_bounds(spark):
    """A positive of 0 or below has the window that the contract's inequality gives it."""
    rows = [(0, 1, [1.0]), (1, 1, [1.0]), (2, 2, [0.8]), (3, 2, [0.796]), (4, 2, [1.0]), (5, 2, [1.004]), (6, 1, [0.0]), (7, 2, [0.0]), (8, 1, [-1.0]), (9, 2, [-0.9])]
    assert found(spark.createDataFrame(rows, TYPE)) == expected(rows)
