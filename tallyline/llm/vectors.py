"""Vectors as columns: which of them count, and Arrow lists as numpy matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F


def is_vector(column: str) -> Column:
    """Not null or empty, without null or non-finite components, not all zeros."""
    values = F.col(column).cast("array<double>")
    finite = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce((F.size(values) > 0) & finite & F.exists(values, lambda x: x != 0), F.lit(False))


def usable_vectors(df: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """The rows that take part: ``vec_id``, ``vector`` (doubles), ``dim`` and ``row``, a hash of the row."""
    rows = df.where(F.col(vec_id).isNotNull() & is_vector(embedding))
    rows = rows.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(embedding).cast("array<double>").alias("vector"))
    return rows.select("*", F.size("vector").alias("dim"), F.xxhash64("vec_id", "vector").alias("row"))


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """A list column of equally long vectors as rows of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows at length 1; scaled first, so that squares of very large or small numbers stay finite."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def has_numbers(column: str) -> Column:
    """Not null or empty, without null or non-finite components; zeros count as numbers."""
    values = F.col(column).cast("array<double>")
    finite = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce((F.size(values) > 0) & finite, F.lit(False))


def whole_numbers(column: pa.ChunkedArray | pa.Array, scale: float) -> np.ndarray:
    """``floor(scale * component)`` of equally long vectors as 64-bit integers; larger ones are an error."""
    scaled = np.floor(matrix(column) * scale)
    if len(scaled) and np.abs(scaled).max() >= 2.0**63:
        raise OverflowError("a component does not fit into 64 bits")
    return scaled.astype(np.int64)
