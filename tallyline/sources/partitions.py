"""Replacing partitions of a Parquet table so that a rerun changes nothing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F


def counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """Count the rows of a write while it runs, instead of reading them again."""
    counter = Observation()
    return df.observe(counter, F.count(F.lit(1)).alias("rows")), counter


def replace_partitions(df: DataFrame, table: str, column: str) -> None:
    """Replace exactly the partitions ``df`` has rows for, in the commit of one job."""
    writer = df.write.mode("overwrite").partitionBy(column)
    writer.option("partitionOverwriteMode", "dynamic").parquet(table)


def empty_partition(df: DataFrame, table: str, column: str, value: str) -> None:
    """Leave a partition without rows. A dynamic overwrite skips partitions it has no rows for."""
    df.drop(column).limit(0).write.mode("overwrite").parquet(f"{table}/{column}={value}")


def replace_partition(df: DataFrame, table: str, column: str, value: str, as_column: Column) -> int:
    """Make ``df`` the content of one partition, also if it has no rows; returns its rows."""
    stamped = df.withColumn(column, as_column)
    rows, counter = counted(stamped)
    replace_partitions(rows, table, column)
    written = counter.get["rows"]
    if written == 0:
        empty_partition(stamped, table, column, value)
    return written
