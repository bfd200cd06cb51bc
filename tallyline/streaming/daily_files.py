"""Pick up delivered daily files as they appear and replace the days they belong to."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyline.sources.tables import DAY_IN_PATH, refresh_daily_fact, replace_day


def stream_daily_files(
    spark: SparkSession, folder: str, table: str, checkpoint: str, fact: str | None = None, rejects: str | None = None
) -> StreamingQuery:
    """Process every file not seen before, then stop; run again when new files may be there.

    A micro-batch only lists which days have something new; file contents are not read by it. Each such day is read whole from its
    file and replaced, so neither a retried batch nor a file split over two batches doubles or
    loses a row. A file delivered again under the same name is not new to the stream:
    ``deliveries.take_deliveries`` finds it, ``backfill_day`` reruns its day.

    Without ``rejects`` a file that names no day, holds no rows or lines that don't fit, or fails its checks stops
    the stream, now and at every restart. With it such files are noted there (batch, path, reason) and the others
    go on; their days keep what they had.
    """

    def replace_days(batch: DataFrame, batch_id: int) -> None:
        loaded, refused = [], []
        for path, day in sorted(map(tuple, batch.select("path", "day").distinct().collect())):
            try:
                if not day:
                    raise ValueError("the file's name holds no day")
                replace_day(spark, f"{folder}/orders_{day}.csv", day, table)
                loaded.append(day)
            except (ValueError, AssertionError) as reason:
                if rejects is None:
                    raise
                refused.append((batch_id, path, str(reason)[:1000]))
        if refused:  # one folder per batch: a batch that runs again notes its files once
            noted = spark.createDataFrame(refused, "batch bigint, path string, reason string")
            noted.write.mode("overwrite").parquet(f"{rejects}/batch={batch_id}")
        if fact and loaded:
            refresh_daily_fact(spark, table, fact, loaded)

    listing = "path string, modificationTime timestamp, length bigint, content binary"
    files = (
        spark.readStream.format("binaryFile")
        .schema(listing)
        .options(pathGlobFilter="orders_*.csv", maxFilesPerTrigger="31")
        .load(folder)
    )
    return (
        files.select("path", F.regexp_extract("path", DAY_IN_PATH, 1).alias("day"))
        .writeStream.foreachBatch(replace_days)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
