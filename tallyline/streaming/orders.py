"""Orders as a stream of rows: late ones are taken, repeated ones dropped by a state store."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from tallyline.operators.digests import SEEDS, row_hash
from tallyline.schemas import DAILY_ORDERS
from tallyline.sources.csv_files import READ_OPTIONS
from tallyline.sources.tables import BATCHED_ORDERS, DAY_IN_PATH, REQUIRED

CORRUPT = "corrupt_line"


def stream_orders(
    spark: SparkSession, folder: str, table: str, checkpoint: str, rejects: str, repeat_within: str = "7 days",
    day_in_path: str = DAY_IN_PATH, files_at_once: int = 1,
) -> StreamingQuery:
    """Take the rows of every file not seen before, then stop; run again when new files may be there.

    A row that the stream has taken within ``repeat_within`` before, from whichever file, is dropped: two
    hashes of its columns are the key of ``dropDuplicatesWithinWatermark``, so that the state store holds
    16 bytes per row and forgets them after that time. The watermark follows the time of arrival, which
    a restart takes from the checkpoint: an order placed long before its file came is never late. A corrected
    order is another row; ``dedup_orders`` over the result keeps the one of the latest batch.

    Each micro-batch writes a folder of its own and replaces it if it runs again, after a lost driver for
    instance. Lines that don't fit the declared columns, and rows without a day or a required value, go to
    ``rejects`` with the file's path and the reason, and the others go on. With one file at a time the batch
    day of a repeated row is that of its first file.
    """
    schema = StructType([*DAILY_ORDERS.fields, StructField(CORRUPT, StringType())])
    options = READ_OPTIONS | {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "recursiveFileLookup": "true"}
    rows = spark.readStream.schema(schema).options(**options).option("maxFilesPerTrigger", files_at_once).csv(folder)
    path = F.col("_metadata.file_path")
    day = F.try_to_date(F.nullif(F.regexp_extract(path, day_in_path, 1), F.lit("")))
    content = [*DAILY_ORDERS.names, CORRUPT]
    keys = [f"key_{seed}" for seed in SEEDS]
    distinct = (
        rows.select(*content, day.alias("batch_day"), path.alias("path"), F.current_timestamp().alias("arrived"))
        .withColumns({key: row_hash(content, seed) for key, seed in zip(keys, SEEDS, strict=True)})
        .withWatermark("arrived", repeat_within)
        .dropDuplicatesWithinWatermark(keys)
    )
    empty = [F.when(F.col(name).isNull(), F.lit(name)) for name in REQUIRED]
    reason = F.coalesce(
        F.when(F.col(CORRUPT).isNotNull(), "the line does not fit the columns"),
        F.when(F.col("batch_day").isNull(), "the file's name holds no day"),
        F.when(F.greatest(*[F.col(n).isNull() for n in REQUIRED]), F.concat(F.lit("empty: "), F.concat_ws(", ", *empty))),
    )

    def store(batch: DataFrame, batch_id: int) -> None:
        marked = batch.withColumn("reason", reason).persist()
        good = marked.where("reason IS NULL").select(*BATCHED_ORDERS.names)
        good.write.mode("overwrite").partitionBy("batch_day").parquet(f"{table}/batch={batch_id}")
        bad = marked.where("reason IS NOT NULL").select("path", "reason", F.coalesce(CORRUPT, F.to_json(F.struct(*DAILY_ORDERS.names))).alias("line"))
        bad.write.mode("overwrite").parquet(f"{rejects}/batch={batch_id}")
        marked.unpersist()

    return distinct.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def streamed_orders(spark: SparkSession, table: str) -> DataFrame:
    """All rows the stream has taken, in the shape of the daily orders table."""
    schema = StructType([*BATCHED_ORDERS.fields])
    try:
        return spark.read.schema(schema).parquet(table).select(*schema.names)
    except AnalysisException:  # nothing has arrived yet
        return spark.createDataFrame([], schema)
