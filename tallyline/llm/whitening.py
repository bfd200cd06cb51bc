"""Whitening of vectors: pivoted Cholesky of the centred scatter, then one-sided Jacobi on its factor.

Components count as whole numbers, so that sums and scatter are exact whatever the partitioning: a first
pass adds up the vectors; a second one multiplies deviations from the mean rounded down, and the scatter
around the mean itself follows by an exact correction of less than one unit per entry. Partial sums
of a task go through a combining aggregation, so that the driver receives one matrix, never one per
task. The scatter's Cholesky factor with pivoting, P L, has its columns rotated against each other until
all are at right angles: their norms are then the roots of the eigenvalues, the normalised columns the
components. The matrix itself is never diagonalised, so that small eigenvalues keep their digits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from tallyline.llm.common import give_back_memory, ship_package
from tallyline.llm.vectors import has_numbers, whole_numbers

EXACT = 2**53
SWEEPS = 60
TINY = np.finfo(float).eps


def pivoted_cholesky(matrix: np.ndarray) -> np.ndarray:
    """``a`` of full column rank with ``a @ a.T`` equal to a positive semidefinite ``matrix``: the rows of a
    lower triangular factor, put back in their own order. Ends where no pivot is left that stands out of
    the rounding of its own diagonal entry, so that a dimension of small numbers counts like any other."""
    rest = matrix.astype(float).copy()
    size, columns = len(rest), []
    least = size * TINY * rest.diagonal()
    left = np.ones(size, bool)
    for _ in range(size):
        pivots = np.where(left & (rest.diagonal() > least), rest.diagonal(), 0.0)
        at = int(pivots.argmax())
        if pivots[at] <= 0:
            break
        column = np.where(left, rest[:, at], 0.0) / np.sqrt(rest[at, at])
        rest -= np.outer(column, column)
        left[at] = False
        columns.append(column)
    return np.array(columns).T if columns else np.empty((size, 0))


def _rounds(count: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of columns in rounds of disjoint ones, as in a tournament."""
    places = np.arange(count + count % 2)
    for _ in range(len(places) - 1):
        a, b = places[: len(places) // 2], places[: len(places) // 2 - 1 : -1]
        real = (a < count) & (b < count)
        yield np.minimum(a, b)[real], np.maximum(a, b)[real]
        places = np.r_[places[:1], places[-1:], places[1:-1]]


def one_sided_jacobi(factor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Norms, largest first, and directions of the columns once rotations have made all of them orthogonal."""
    columns = factor.T.copy()
    for _ in range(SWEEPS):
        widest = 0.0
        for a, b in _rounds(len(columns)):
            x, y = columns[a], columns[b]
            xx, yy, xy = (np.einsum("ij,ij->i", *pair) for pair in ((x, x), (y, y), (x, y)))
            apart = np.abs(xy) / np.sqrt(np.maximum(xx * yy, np.finfo(float).tiny))
            widest = max(widest, apart.max(initial=0.0))
            turn = apart > TINY
            if not turn.any():
                continue
            zeta = (yy[turn] - xx[turn]) / (2 * xy[turn])
            t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            c = 1 / np.hypot(1.0, t)
            s = c * t
            x, y = x[turn], y[turn]
            columns[a[turn]], columns[b[turn]] = c[:, None] * x - s[:, None] * y, s[:, None] * x + c[:, None] * y
        if widest <= len(columns) * TINY:
            break
    norms = np.linalg.norm(columns, axis=1)
    order = np.argsort(-norms, kind="stable")
    return norms[order], (columns[order] / np.maximum(norms[order], np.finfo(float).tiny)[:, None]).T


@dataclass
class Whitening:
    """The fit over vectors of one length."""

    n: int
    sums: np.ndarray  # whole numbers, per dimension
    floor: np.ndarray  # the mean, rounded down
    mean: np.ndarray  # what is left of it
    values: np.ndarray  # eigenvalues, falling
    components: np.ndarray  # one column each
    trace: float

    def project(self, numbers: np.ndarray) -> np.ndarray:
        centred = (numbers - self.floor) - self.mean
        return centred @ self.components / np.sqrt(self.values)

    def deviations(self, numbers: np.ndarray) -> np.ndarray:
        """The sum over dimensions of (n x - S)^2, exact."""
        apart = (numbers - self.floor) * self.n - (self.sums - self.n * self.floor)
        if len(apart) and (apart.astype(float) ** 2).sum(axis=1).max() >= 2.0**63:
            raise OverflowError("a deviation does not fit into 64 bits")
        return (apart * apart).sum(axis=1)


def fit(n: int, sums: list[int], scatter: np.ndarray, components: int) -> Whitening:
    """From the exact sums, and the exact scatter around the mean rounded down (whole numbers)."""
    floor = [s // n for s in sums]
    left = [s - n * f for s, f in zip(sums, floor, strict=True)]
    size = len(sums)
    covariance = np.empty((size, size))
    for i in range(size):
        for j in range(i + 1):
            covariance[i, j] = covariance[j, i] = float(Fraction(n * int(scatter[i, j]) - left[i] * left[j], n * n))
    norms, directions = one_sided_jacobi(pivoted_cholesky(covariance))
    kept = min(components, len(norms))
    directions = directions[:, :kept]
    signs = np.sign(directions[np.abs(directions).argmax(axis=0), np.arange(kept)]) if kept else np.empty(0)
    mean = np.array([x / n for x in left])
    return Whitening(n, np.array(sums), np.array(floor), mean, norms[:kept] ** 2, directions * signs, float(np.trace(covariance)))


def exact_scatter(numbers: np.ndarray) -> np.ndarray:
    """``numbers.T @ numbers`` of whole numbers, in blocks short enough to be exact in doubles."""
    most = int(np.abs(numbers).max(initial=0)) ** 2
    if most >= EXACT:
        raise OverflowError("deviations are too large for an exact scatter")
    rows = max(1, EXACT // max(most, 1))
    total = np.zeros((numbers.shape[1],) * 2, np.int64)
    for start in range(0, len(numbers), min(rows, 1 << 16)):
        block = numbers[start : start + min(rows, 1 << 16)].astype(float)
        total += (block.T @ block).astype(np.int64)
    return total


def _added(vectors: DataFrame, part: Callable[[int, np.ndarray], np.ndarray], scale: float, kind: str = "bigint") -> dict[int, np.ndarray]:
    """The sums of ``part`` (an array per batch of vectors of one length) over all vectors, by length.

    A task adds up what it has read and passes on one row per entry; these are added by a combining aggregation.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            dims = batch.column(1).to_numpy()
            for dim in np.unique(dims).tolist():
                own = part(dim, whole_numbers(batch.column(0).filter(pa.array(dims == dim)), scale))
                totals[dim] = totals[dim] + own if dim in totals else own
        for dim, total in totals.items():
            entries = total.ravel()
            columns = [np.full(len(entries), dim, np.int32), np.arange(len(entries)), entries]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["dim", "entry", "total"])
        give_back_memory()

    parts = vectors.select("__vector", "__dim").mapInArrow(partial, f"dim int, entry bigint, total {kind}")
    rows = parts.groupBy("dim", "entry").agg(F.sum("total").alias("total")).toPandas()  # one matrix per length
    return {int(dim): own.sort_values("entry")["total"].to_numpy() for dim, own in rows.groupby("dim")}


def fit_whitening(vectors: DataFrame, components: int, scale: float) -> dict[int, Whitening]:
    """The fit of each length of vectors that ``usable`` gives."""
    first = _added(vectors, lambda dim, x: np.append(len(x), x.sum(axis=0)), scale)
    counts = {dim: int(total[0]) for dim, total in first.items()}
    sums = {dim: [int(s) for s in total[1:]] for dim, total in first.items()}
    floors = {dim: np.array([s // counts[dim] for s in sums[dim]]) for dim in sums}
    scatters = _added(vectors, lambda dim, x: exact_scatter(x - floors[dim]), scale)
    return {dim: fit(counts[dim], sums[dim], scatters[dim].reshape(dim, dim), components) for dim in sums}


def identity_errors(vectors: DataFrame, models: dict[int, Whitening], scale: float) -> dict[int, float]:
    """By length: the largest entry of the whitened vectors' covariance minus the identity, measured over all."""
    totals = _added(vectors, lambda dim, x: models[dim].project(x).sum(axis=0), scale, "double")
    means = {dim: total / models[dim].n for dim, total in totals.items()}

    def products(dim: int, x: np.ndarray) -> np.ndarray:
        centred = models[dim].project(x) - means.get(dim, 0.0)  # no entries, no mean: a fit without components
        return centred.T @ centred

    errors = dict.fromkeys(models, 0.0)
    for dim, total in _added(vectors, products, scale, "double").items():
        size = len(models[dim].values)
        errors[dim] = float(np.abs(total.reshape(size, size) / models[dim].n - np.eye(size)).max(initial=0.0))
    return errors


def usable(df: DataFrame, embedding: str = "embedding") -> DataFrame:
    """The rows that take part, with ``__vector`` (doubles) and ``__dim``."""
    rows = df.where(has_numbers(embedding))
    return rows.withColumns({"__vector": F.col(embedding).cast("array<double>"), "__dim": F.size(embedding)})


def whiten(df: DataFrame, components: int = 32, scale: float = 64, embedding: str = "embedding") -> DataFrame:
    """The rows whose vector holds numbers throughout, with ``n`` (vectors of the fit), ``deviation`` (the
    sum over dimensions of (n x - S)^2, exact), ``whitened`` (one double per component), ``explained`` (each
    component's share of the variance) and ``identity_error`` (one value per fit). Other columns are kept,
    those of these names replaced.

    A component c counts as x = ``floor(scale * c)``; S are the sums over all vectors. Rows whose vector is
    null or empty or holds a null or non-finite component go. Vectors of each length are a fit of their own.
    Every row counts, repeated ones too. There are as many components as the variance has directions, up to
    ``components``: none where all vectors are equal. Numbers beyond 64 bits are an error.
    """
    ship_package(df.sparkSession)
    rows = usable(df, embedding)
    models = fit_whitening(rows, components, scale)
    errors = identity_errors(rows, models, scale)
    kind = "struct<n:bigint,deviation:bigint,whitened:array<double>,explained:array<double>,identity_error:double>"
    fields = pa.struct([
        ("n", pa.int64()), ("deviation", pa.int64()), ("whitened", pa.list_(pa.float64())),
        ("explained", pa.list_(pa.float64())), ("identity_error", pa.float64()),
    ])
    names = [field.name for field in fields]

    @arrow_udf(kind)
    def whitened(vectors: pa.Array) -> pa.Array:
        out = np.empty(len(vectors), object)
        dims = vectors.value_lengths().to_numpy(zero_copy_only=False)
        for dim in np.unique(dims).tolist():
            model, at = models[dim], np.flatnonzero(dims == dim)
            x = whole_numbers(vectors.take(pa.array(at)), scale)
            shares = (model.values / model.trace).tolist() if model.trace else []
            rows = zip(at.tolist(), model.deviations(x).tolist(), model.project(x).tolist(), strict=True)
            for place, deviation, values in rows:
                out[place] = (model.n, deviation, values, shares, errors[dim])
        return pa.array([dict(zip(names, row, strict=True)) for row in out], fields)

    found = rows.drop(*names).withColumn("__white", whitened(F.col("__vector")))
    return found.select("*", "__white.*").drop("__vector", "__dim", "__white")


def per_component(whitened: DataFrame, *columns: str | Column) -> DataFrame:
    """One row per row and component of ``whiten``'s result: ``component`` (from 1), ``n``, ``deviation``,
    ``whitened``, ``explained``, ``identity_error``."""
    pairs = F.posexplode(F.arrays_zip("whitened", "explained")).alias("place", "pair")
    rows = whitened.select(*columns, "n", "deviation", "identity_error", pairs)
    return rows.select(
        *columns, (F.col("place") + 1).alias("component"), "n", "deviation",
        F.col("pair.whitened").alias("whitened"), F.col("pair.explained").alias("explained"), "identity_error",
    )
