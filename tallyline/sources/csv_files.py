"""Headed CSV files with declared types, read and written."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameReader, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampNTZType

# Quotes are doubled inside a quoted field, and a bad value or a header that
# does not fit stops the read instead of turning into NULL.
READ_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "mode": "FAILFAST",
    "enforceSchema": "false",
}
WRITE_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


#: With it a quoted field may hold line breaks, and a file is read by one task as a whole.
LINE_BREAKS = {"multiLine": "true"}


def header_of(spark: SparkSession, path: str, **options: str) -> list[str]:
    """The column names of a file; reads its first line only."""
    return spark.read.options(**READ_OPTIONS, **options).csv(path).columns


def typed_reader(
    spark: SparkSession, path: str, schema: StructType, keep_corrupt: str | None = None, **options: str
) -> DataFrameReader:
    """A reader whose types follow the header's order, so nothing is inferred.

    A file may order the declared columns differently or carry more; a missing one is an error. With
    ``keep_corrupt`` a line that does not fit is a row with its text in the column of that name.
    """
    header = header_of(spark, path, **options)
    missing = [name for name in schema.names if name not in header]
    if missing:
        raise ValueError(f"{path} lacks columns {missing}")
    in_file_order = StructType(
        [schema[n] if n in schema.names else StructField(n, StringType()) for n in header]
    )
    options = READ_OPTIONS | options
    if keep_corrupt:
        in_file_order = in_file_order.add(keep_corrupt, StringType())
        options |= {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": keep_corrupt}
    return spark.read.schema(in_file_order).options(**options)


def read_csv(spark: SparkSession, path: str, schema: StructType, line_breaks: bool = False, **options: str) -> DataFrame:
    """The declared columns, taken by name.

    ``line_breaks`` reads quoted fields over several lines, as ``write_csv`` writes them; a file
    is then not split. Without it a field that goes over a line's end does not fit its types or
    its number of columns, and a file of one text column must not hold any.
    """
    options = {**(LINE_BREAKS if line_breaks else {}), **options}
    return typed_reader(spark, path, schema, **options).csv(path).select(*schema.names)


def write_csv(
    df: DataFrame, path: str, mode: str = "error", partition_by: str | None = None
) -> None:
    """Result rows under a header, as a folder of part files written by the executors.

    NULL and empty text are both written empty; times as ``2025-09-15 18:00:00``.
    """
    columns = [
        F.col(f.name).cast("string").alias(f.name)
        if isinstance(f.dataType, TimestampNTZType)
        else F.col(f.name)
        for f in df.schema.fields
    ]
    writer = df.select(*columns).write.mode(mode).options(**WRITE_OPTIONS)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.csv(path)


def query_to_csv(spark: SparkSession, query: str, path: str, mode: str = "error") -> None:
    """Run SQL text, or the text of a ``.sql`` file, over the session's views into CSV."""
    if query.endswith(".sql"):
        with open(query, encoding="utf-8") as file:
            query = file.read()
    write_csv(spark.sql(query), path, mode)
