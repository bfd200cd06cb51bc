"""Daily files that are delivered again under their names."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyline.operators.digests import digest_columns
from tallyline.sources.tables import DAY_IN_PATH, Loaded, backfill_day

SEEN = "path string, modified timestamp, length bigint, checksum string, day string"


def _seen(spark: SparkSession, manifest: str) -> DataFrame:
    """The last entry of each path."""
    try:
        entries = spark.read.schema(SEEN).parquet(manifest)
    except AnalysisException:  # nothing has been taken yet
        return spark.createDataFrame([], SEEN)
    newest = F.max(F.struct("modified", "length", "checksum", "day")).alias("e")
    return entries.groupBy("path").agg(newest).select("path", "e.*")


def changed_files(spark: SparkSession, folder: str, manifest: str, day_in_path: str = DAY_IN_PATH) -> DataFrame:
    """The files that are new or whose contents differ from what the manifest says was taken: its entry.

    Files whose time and length are known are not opened. Of the others a digest of the lines is taken by
    as many tasks as they have ranges, so that a file that was only touched is not taken again.
    """
    files = spark.read.format("binaryFile").options(recursiveFileLookup="true", pathGlobFilter="*.csv").load(folder)
    stamp = files.select(
        "path", F.col("_metadata.file_path").alias("file"), F.col("modificationTime").alias("modified"), "length",
        F.regexp_extract("path", day_in_path, 1).alias("day"),
    )
    seen = _seen(spark, manifest)
    waiting = stamp.join(seen, ["path", "modified", "length"], "left_anti")
    opened = waiting.collect()  # one row per file delivered since the last run
    if not opened:
        return spark.createDataFrame([], SEEN)
    lines = spark.read.text([row["path"] for row in opened]).select(F.col("_metadata.file_path").alias("file"), "value")
    contents = lines.groupBy("file").agg(*digest_columns(["value"]))
    checksum = F.concat_ws(":", *[F.col(name).cast("string") for name in contents.columns if name != "file"])
    delivered = spark.createDataFrame(opened, waiting.schema).join(contents.select("file", checksum.alias("checksum")), "file", "left")
    delivered = delivered.withColumn("checksum", F.coalesce("checksum", F.lit("no lines")))
    known = seen.select("path", "checksum")
    return delivered.join(known, ["path", "checksum"], "left_anti").select("path", "modified", "length", "checksum", "day")


def take_deliveries(
    spark: SparkSession, folder: str, table: str, fact: str, manifest: str, rejects: str | None = None, day_in_path: str = DAY_IN_PATH
) -> dict[str, Loaded]:
    """Replace the day of every file that is new or was delivered again with other contents, once.

    Returns what was loaded by day. A file is entered into the manifest after its day was replaced: a run that
    breaks off in between replaces that day again, with the same result. A file that is refused (no
    day in its name, no rows, lines that don't fit, empty required columns) stops the run, or is noted in
    ``rejects`` (path, reason) and entered, so that it counts again once its contents change.
    """
    loaded = {}
    entries = sorted(map(tuple, changed_files(spark, folder, manifest, day_in_path).collect()))
    for path, modified, length, checksum, day in entries:
        try:
            if not day:
                raise ValueError("the file's name holds no day")
            loaded[day] = backfill_day(spark, path, day, table, fact)
        except (ValueError, AssertionError) as reason:
            if rejects is None:
                raise
            spark.createDataFrame([(path, str(reason)[:1000])], "path string, reason string").write.mode("append").parquet(rejects)
        spark.createDataFrame([(path, modified, length, checksum, day)], SEEN).write.mode("append").parquet(manifest)
    return loaded
