"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import contextlib
import ctypes
import hashlib
import os
import tempfile
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

import tallyline
from tallyline.session import scratch_folder, written

CHUNK_BYTES = 1 << 20
BATCH_BYTES = 4 << 20
_SHIPPED: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship_package(spark: SparkSession) -> None:
    """Lets the Python workers import this package, once per application: the driver serves a zip of
    its code. Nothing is done where the package itself came in an archive that the workers have.

    Rows go to the workers in batches of about ``BATCH_BYTES``, if the session doesn't set another size: a
    default batch of 10,000 whole texts takes a task tens of megabytes on either side."""
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(limit, None) is None:
        spark.conf.set(limit, str(BATCH_BYTES))
    root = os.path.dirname(os.path.abspath(tallyline.__file__))
    application = spark.sparkContext.applicationId
    if application in _SHIPPED or not os.path.isdir(root):
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="tallyline-"), "tallyline_code.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(root):
            for name in sorted(n for n in names if n.endswith(".py")):
                path = os.path.join(folder, name)
                out.write(path, os.path.relpath(path, os.path.dirname(root)))
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(application)


def whole_text(text: str | Column) -> Column:
    """The text, with null taken as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def row_key(row_id: str, text: str) -> Column:
    """A hash that tells rows apart which differ in id or text, nulls included; rows that agree in
    both share it."""
    parts = [F.concat(F.lit("="), p) for p in (F.col(row_id).cast("string"), F.md5(text))]
    return F.md5(F.concat_ws("|", *[F.coalesce(p, F.lit("null")) for p in parts]))


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as a table in the cluster's shared folder and read back; lineage ends there."""
    return written(df, scratch_folder(df.sparkSession, label))


def in_chunks(values: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[list]:
    """The values of a text or binary array in lists of about ``limit`` bytes; a longer value is a
    list of its own."""
    upto = np.cumsum(pc.fill_null(pc.binary_length(values), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 8)
    start = 0
    while start < len(values):
        before = upto[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(upto, before + limit, side="right")))
        yield values.slice(start, end - start).to_pylist()
        start = end


def give_back_memory() -> None:
    """Returns what a task's arrays have left unused in a Python worker, which lives on for later stages."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def digest(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def read_bytes(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()
