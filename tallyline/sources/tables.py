"""Loading delivered files into Parquet tables."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from tallyline.functions.times import date_literal
from tallyline.operators.orders import daily_orders
from tallyline.operators.quality import assert_empty, null_counts
from tallyline.schemas import DAILY_ORDERS
from tallyline.sources.csv_files import header_of, read_csv, typed_reader
from tallyline.sources.partitions import counted, empty_partition, replace_partition, replace_partitions
from tallyline.sources.split_csv import read_split_csv

BATCHED_ORDERS = StructType([*DAILY_ORDERS.fields, StructField("batch_day", DateType())])

DATES = "order_date date, batch_day date"
CORRUPT = "corrupt_line"
HEADERS_AT_ONCE = 16

# The daily file name, and the columns the daily orders must not leave empty.
DAY_IN_PATH = r"orders_(\d{4}-\d{2}-\d{2})\.csv"
REQUIRED = ["order_id", "order_date", "amount_paise"]


class EmptyDelivery(ValueError):
    """A day's file holds no rows, and dropping the day was not asked for."""


class MalformedDelivery(ValueError):
    """A day's file holds lines that don't fit the declared columns."""


@dataclass(frozen=True)
class Loaded:
    """Rows read from the files, and rows the table now holds for the same scope."""

    rows_read: int
    rows_held: int


def load_whole(spark: SparkSession, files: dict[str, tuple[str, StructType]], folder: str) -> dict[str, int]:
    """Rebuild one table per file; returns the rows of each.

    Every file's header is read before the first table is touched, so a missing file stops the
    load with all tables as they were. Quoted line breaks are read, from large files by many tasks.
    """
    frames = {name: read_split_csv(spark, path, schema) for name, (path, schema) in files.items()}
    loaded = {}
    for name, frame in frames.items():
        rows, counter = counted(frame)
        rows.write.mode("overwrite").parquet(f"{folder}/{name}")
        loaded[name] = counter.get["rows"]
    return loaded


def orders_table(spark: SparkSession, table: str) -> DataFrame:
    return spark.read.schema(BATCHED_ORDERS).parquet(table)


def _day_rows(spark: SparkSession, table: str, day: date | str) -> DataFrame:
    return orders_table(spark, table).where(F.col("batch_day") == date_literal(day))


def _read_day(spark: SparkSession, path: str, day: date | str) -> DataFrame:
    return read_csv(spark, path, DAILY_ORDERS).withColumn("batch_day", date_literal(day))


def _dates(df: DataFrame) -> set[date]:
    """Distinct order dates on the driver; the calendar bounds them."""
    return {row[0] for row in df.select("order_date").where("order_date is not null").distinct().collect()}


def batch_dates(spark: SparkSession, table: str) -> DataFrame:
    """Which order dates each batch holds or once held, a small table beside the orders.

    It is extended before a batch is written and never shrinks, so after a crash it still names
    every date whose figures may be out of step.
    """
    path = f"{table}_dates"
    spark.createDataFrame([], DATES).write.mode("ignore").partitionBy("batch_day").parquet(path)
    return spark.read.schema(DATES).parquet(path)


def _dates_of_batch(spark: SparkSession, table: str, day: date | str) -> set[date]:
    return _dates(batch_dates(spark, table).where(F.col("batch_day") == date_literal(day)))


def _note_dates(spark: SparkSession, table: str, day: date | str, incoming: DataFrame) -> None:
    known = _dates_of_batch(spark, table, day)
    now = known | _dates(incoming)
    if now != known:
        noted = spark.createDataFrame([(d,) for d in sorted(now)], "order_date date")
        replace_partition(noted, f"{table}_dates", "batch_day", str(day), date_literal(day))


def append_day(spark: SparkSession, path: str, day: date | str, table: str) -> Loaded:
    """Append one day's file. Loading a day twice doubles it; :func:`replace_day` does not."""
    incoming = _read_day(spark, path, day)
    _note_dates(spark, table, day, incoming)
    rows, counter = counted(incoming)
    rows.write.mode("append").partitionBy("batch_day").parquet(table)
    return Loaded(counter.get["rows"], _day_rows(spark, table, day).count())


def read_days(spark: SparkSession, paths: str, day_in_path: str = DAY_IN_PATH) -> DataFrame:
    """All daily files, each row stamped with the day named in its file's path.

    Columns are taken by name, file by file: there is one scan for each order of columns that
    occurs. A path without a day fails the cast, a file that lacks a column the read.
    """
    found, by_header = _file_paths(spark, paths), {}
    with ThreadPoolExecutor(HEADERS_AT_ONCE) as pool:  # a header is the first line only, but a job of its own
        for path, header in zip(found, pool.map(lambda path: tuple(header_of(spark, path)), found), strict=True):
            by_header.setdefault(header, []).append(path)
    day = F.regexp_extract(F.col("_metadata.file_path"), day_in_path, 1).cast("date").alias("batch_day")
    scans = [
        typed_reader(spark, some[0], DAILY_ORDERS).csv(some).select(*DAILY_ORDERS.names, day)
        for some in by_header.values()
    ]
    return reduce(DataFrame.unionByName, scans)


def _file_paths(spark: SparkSession, paths: str) -> list[str]:
    """The files below a folder or pattern, bounded by the calendar; their contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
    found = sorted(row["path"] for row in files.select("path").collect())
    if not found:
        raise FileNotFoundError(f"no files at {paths}")
    return found


def load_all_days(spark: SparkSession, paths: str, table: str, day_in_path: str = DAY_IN_PATH) -> Loaded:
    """Rebuild the table from every daily file, without a shuffle: a file holds one day."""
    rows, counter = counted(read_days(spark, paths, day_in_path))
    rows.write.mode("overwrite").partitionBy("batch_day").parquet(table)
    loaded = orders_table(spark, table)
    dates = loaded.select("order_date", "batch_day").distinct()
    dates.write.mode("overwrite").partitionBy("batch_day").parquet(f"{table}_dates")
    return Loaded(counter.get["rows"], loaded.count())


def replace_day(
    spark: SparkSession, path: str, day: date | str, table: str, *, allow_empty: bool = False
) -> Loaded:
    """Load one day so that running it again, or after a broken run, changes nothing.

    The file is staged as Parquet beside the table and checked there; only then is the day's
    partition replaced, in the commit of one job. An empty file is refused, or empties the day
    if allowed; a file with lines that don't fit the declared columns is refused and one of them named.
    """
    staging = f"{table}_staging/{day}"
    with_corrupt = StructType([*DAILY_ORDERS.fields, StructField(CORRUPT, StringType())])
    delivered = typed_reader(spark, path, DAILY_ORDERS, keep_corrupt=CORRUPT).csv(path).select(*with_corrupt.names)
    rows, counter = counted(delivered.withColumn("batch_day", date_literal(day)))
    rows.write.mode("overwrite").parquet(staging)
    staged = spark.read.schema(StructType([*with_corrupt.fields, *BATCHED_ORDERS.fields[-1:]])).parquet(staging)
    malformed = staged.where(F.col(CORRUPT).isNotNull()).select(CORRUPT).take(1)
    if malformed:
        raise MalformedDelivery(f"MALFORMED_RECORD in {path}: {malformed[0][0][:500]}")
    staged = staged.drop(CORRUPT)
    rows_read = counter.get["rows"]
    if rows_read == 0 and not allow_empty:
        raise EmptyDelivery(f"{path} holds no rows; the table keeps its rows of {day}")
    assert_empty(null_counts(staged, REQUIRED), f"{path} leaves required columns empty")
    _note_dates(spark, table, day, staged)
    replace_partition(staged.drop("batch_day"), table, "batch_day", str(day), date_literal(day))
    spark.createDataFrame([], BATCHED_ORDERS).write.mode("overwrite").parquet(staging)
    return Loaded(rows_read, _day_rows(spark, table, day).count())


def rebuild_daily_fact(spark: SparkSession, table: str, fact: str) -> None:
    """Write the whole daily fact, one partition per order date."""
    daily_orders(orders_table(spark, table)).write.mode("overwrite").partitionBy("order_date").parquet(fact)


def daily_fact(spark: SparkSession, fact: str) -> DataFrame:
    schema = "order_rows bigint, orders bigint, delivered_revenue_paise bigint, order_date date"
    columns = ["order_date", "order_rows", "orders", "delivered_revenue_paise"]
    return spark.read.schema(schema).parquet(fact).select(*columns)


def backfill_day(
    spark: SparkSession,
    path: str,
    day: date | str,
    table: str,
    fact: str,
    *,
    allow_empty: bool = False,
) -> Loaded:
    """Replace a day's batch and recompute the fact for every order date it touches.

    A batch feeds more than its own date (late orders), and a corrected batch may no longer
    hold a date it held before: all of them are recomputed.
    """
    loaded = replace_day(spark, path, day, table, allow_empty=allow_empty)
    refresh_daily_fact(spark, table, fact, [day])
    return loaded


def refresh_daily_fact(spark: SparkSession, table: str, fact: str, days: list[date | str]) -> None:
    """Recompute the fact for every order date that one of the batches ``days`` touched.

    Only the batches that hold such a date are read, and of them only its row groups.
    """
    held = batch_dates(spark, table)
    batches = F.col("batch_day").isin([date.fromisoformat(str(day)) for day in days])
    dates = sorted(_dates(held.where(batches)))
    if not dates:
        return
    of_dates = F.col("order_date").isin(dates)
    sources = [row[0] for row in held.where(of_dates).select("batch_day").distinct().collect()]
    orders = orders_table(spark, table).where(F.col("batch_day").isin(sources) & of_dates)
    recomputed = daily_orders(orders)
    replace_partitions(recomputed, fact, "order_date")
    for gone in sorted(set(dates) - _dates(orders)):
        empty_partition(recomputed, fact, "order_date", str(gone))
