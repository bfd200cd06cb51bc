"""CSV files whose quoted fields may go over several lines, read by many tasks each.

A line break ends a record if as many quotes as make whole pairs stand before it, since quotes inside a
field are doubled. Lines are read by ranges of a file as Spark splits it; the parity of the quotes of each
range, added up over the ranges before it, tells for each line whether it begins inside a field. Lines that
are records by themselves are parsed where they are; only the pieces of longer records are brought
together. Spark's own CSV parser then takes whole records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tallyline.session import scratch_folder, written
from tallyline.sources.csv_files import LINE_BREAKS, READ_OPTIONS, header_of

PARSE_OPTIONS = {name: value for name, value in READ_OPTIONS.items() if name not in ("header", "enforceSchema")}


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Every line with its file, the offset of its range of the file, and a number that rises within the range."""
    text = spark.read.option("lineSep", "\n").text(path)
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return text.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("range"),
        F.monotonically_increasing_id().alias("at"), "value", quotes.alias("quotes"),
    )


def _ranges(lines: DataFrame) -> DataFrame:
    """One row per range of a file: whether it begins inside a field, and the file's first line."""
    ranges = lines.groupBy("file", "range").agg(
        (F.sum("quotes") % 2).alias("odd"), F.min_by("value", "at").alias("first_line"), F.min("at").alias("first_at")
    )
    before = Window.partitionBy("file").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    inside = (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2).alias("inside")
    return ranges.select("*", inside)


def _without_return(text: Column) -> Column:
    return F.when(F.endswith(text, F.lit("\r")), F.expr("substring(record, 1, length(record) - 1)")).otherwise(text)


def records(spark: SparkSession, path: str) -> DataFrame:
    """Every record of every file as text, line breaks inside quotes included: ``file``, ``record`` and
    ``is_header`` for the first one of a file. Blank lines between records are left out. A file that ends
    inside a quoted field is an error."""
    lines = _lines(spark, path)
    ranges = written(_ranges(lines), scratch_folder(spark, "csv-ranges"))
    unclosed = ranges.groupBy("file").agg((F.sum("odd") % 2).alias("odd")).where("odd = 1").select("file").take(1)
    if unclosed:
        raise ValueError(f"{unclosed[0]['file']} ends inside a quoted field")
    order = Window.partitionBy("file", "range").orderBy("at")
    quotes_before = F.coalesce(F.sum("quotes").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = lines.join(ranges.select("file", "range", "inside", "first_at"), ["file", "range"]).select(
        "file", "range", "at", "value", "quotes",
        ((F.col("inside") + quotes_before) % 2 == 0).alias("begins"),
        ((F.col("range") == 0) & (F.col("at") == F.col("first_at"))).alias("is_header"),
    )
    alone = F.col("begins") & (F.col("quotes") % 2 == 0)
    whole = placed.where(alone).select("file", F.col("value").alias("record"), "is_header")
    pieces = written(placed.where(~alone), scratch_folder(spark, "csv-pieces"))

    # A piece belongs to the last piece that begins a record: in its range, or in the last range that has one.
    start = F.when(F.col("begins"), F.struct("range", "at"))
    in_range = pieces.select("*", F.last(start, ignorenulls=True).over(order).alias("own"))
    last_of_range = pieces.where("begins").groupBy("file", "range").agg(F.max("at").alias("at"))
    all_ranges = ranges.select("file", "range").join(last_of_range, ["file", "range"], "left")
    earlier = Window.partitionBy("file").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    carried = F.last(F.when(F.col("at").isNotNull(), F.struct("range", "at")), ignorenulls=True).over(earlier)
    all_ranges = all_ranges.select("file", "range", carried.alias("carried"))
    keyed = in_range.join(all_ranges, ["file", "range"]).withColumn("start", F.coalesce("own", "carried"))
    joined = keyed.groupBy("file", "start").agg(
        F.array_sort(F.collect_list(F.struct("range", "at", "value"))).alias("parts"), F.bool_or("is_header").alias("is_header")
    )
    long = joined.select("file", F.array_join(F.col("parts.value"), "\n").alias("record"), "is_header")
    found = whole.unionByName(long)
    return found.withColumn("record", _without_return(F.col("record"))).where(F.btrim("record") != "")


def read_split_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    r"""The declared columns of a file or folder of files, by name, as ``read_csv(..., line_breaks=True)``
    gives them, from as many tasks as the files have ranges.

    All files must have the header of the first; a bad value, a missing column or an unclosed quote
    stops the read. The order of rows is not kept. A line break inside a field stays as it was delivered,
    also ``\r\n``, which the whole-file reader shortens in files whose records end with it.
    """
    header = header_of(spark, path, **LINE_BREAKS)
    missing = [name for name in schema.names if name not in header]
    if missing:
        raise ValueError(f"{path} lacks columns {missing}")
    in_file_order = StructType([schema[n] if n in schema.names else StructField(n, StringType()) for n in header])
    found = records(spark, path)
    names = StructType([StructField(f"c{i}", StringType()) for i in range(len(header))])
    titles = found.where("is_header").select(F.from_csv("record", names.simpleString()[7:-1].replace(":", " "), PARSE_OPTIONS).alias("h"))
    others = titles.where(~F.array(*[F.col(f"h.{n}") for n in names.names]).eqNullSafe(F.array(*map(F.lit, header)))).take(1)
    if others:
        raise ValueError(f"{path} holds files with other columns than {header}")
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in in_file_order)
    rows = found.where(~F.col("is_header")).select(F.from_csv("record", ddl, PARSE_OPTIONS).alias("r"))
    return rows.select([F.col(f"r.`{name}`").alias(name) for name in schema.names])
