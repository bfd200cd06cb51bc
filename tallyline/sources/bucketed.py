"""Tables stored in buckets of a key, so that joins and groupings by the key shuffle nothing."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def store_buckets(df: DataFrame, path: str, key: str, buckets: int) -> DataFrame:
    """Write ``df`` to a folder in ``buckets`` files by the hash of ``key`` and read it back with that layout.

    The rows of a key go to one file: choose as many buckets as make files of a few hundred megabytes,
    and the same number for tables that meet.
    """
    name = _entry()
    rows = df.repartition(buckets, key)
    rows.write.mode("overwrite").option("path", path).bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    return _opened(df.sparkSession, name)


def open_buckets(spark: SparkSession, path: str, schema: StructType, key: str, buckets: int) -> DataFrame:
    """A folder that ``store_buckets`` has written, in another session."""
    name = _entry()
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    return _opened(spark, name)


def _entry() -> str:
    return f"buckets_{uuid.uuid4().hex}"


def _opened(spark: SparkSession, name: str) -> DataFrame:
    """The table with its layout; the catalog needs its entry no longer than that, the files stay."""
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return table
