"""The daily fact from mergeable state per batch, so that a rerun reads its own batch and state only.

The state of a batch has one row per order date and order id it holds: how many rows, and the revenue of
the delivered ones. Rows and revenue add up over batches; an order that several batches hold counts once
because its id is there. State is stored by batch and sorted by date, so that the rows of a few
dates are read by their row groups, in four narrow columns. The batches themselves are read when their
own state is built and never again.
"""

from __future__ import annotations

from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyline.functions.times import date_literal
from tallyline.functions.values import DELIVERED
from tallyline.sources import tables
from tallyline.sources.partitions import empty_partition, replace_partition, replace_partitions

STATE = "order_date date, order_id string, order_rows bigint, delivered_revenue_paise bigint, batch_day date"


def batch_state(orders: DataFrame) -> DataFrame:
    """What batches contribute to the fact. Rows without an id count as rows, not as an order; revenue is
    NULL where nothing was delivered."""
    earned = F.when(F.col("status") == DELIVERED, F.col("amount_paise"))
    return orders.groupBy("batch_day", "order_date", "order_id").agg(
        F.count(F.lit(1)).alias("order_rows"), F.sum(earned).alias("delivered_revenue_paise")
    )


def fact_of(state: DataFrame) -> DataFrame:
    """The fact of the dates that the state covers, from any number of batches.

    The first aggregate brings an order's rows of all batches together, so that a date that holds a third
    of all orders is counted by many tasks.
    """
    per_order = state.groupBy("order_date", "order_id").agg(
        F.sum("order_rows").alias("order_rows"), F.sum("delivered_revenue_paise").alias("revenue")
    )
    return per_order.groupBy("order_date").agg(
        F.sum("order_rows").alias("order_rows"), F.count("order_id").alias("orders"), F.sum("revenue").alias("delivered_revenue_paise")
    )


def stored_state(spark: SparkSession, table: str) -> DataFrame:
    return spark.read.schema(STATE).parquet(f"{table}_state")


def _by_date(state: DataFrame) -> DataFrame:
    return state.sortWithinPartitions("order_date")


def build_state(spark: SparkSession, table: str, fact: str) -> None:
    """State of all batches and the whole fact from it."""
    state = batch_state(tables.orders_table(spark, table)).repartition("batch_day", F.pmod(F.xxhash64("order_id"), F.lit(8)))
    state.sortWithinPartitions("batch_day", "order_date").write.mode("overwrite").partitionBy("batch_day").parquet(f"{table}_state")
    fact_of(stored_state(spark, table)).write.mode("overwrite").partitionBy("order_date").parquet(fact)


def refresh_batch(spark: SparkSession, table: str, fact: str, day: date | str) -> list[date]:
    """Bring state and fact in line with the table's batch of ``day``; returns the dates recomputed.

    Dates are those that the batch holds now or held before by its stored state, which is replaced last:
    a run that breaks off before is repeated from the same state.
    """
    of_batch = F.col("batch_day") == date_literal(day)
    now = batch_state(tables.orders_table(spark, table).where(of_batch)).drop("batch_day")
    try:
        before = stored_state(spark, table)
    except AnalysisException:
        before = spark.createDataFrame([], STATE)
    held = [df.select("order_date").where("order_date IS NOT NULL") for df in (before.where(of_batch), now)]
    dates = sorted(row[0] for row in held[0].unionByName(held[1]).distinct().collect())  # bounded by the calendar
    of_dates = F.col("order_date").isin(dates)
    state = before.where(of_dates & ~of_batch).drop("batch_day").unionByName(now.where(of_dates))
    recomputed = fact_of(state)
    replace_partitions(recomputed, fact, "order_date")
    held_still = {row[0] for row in state.select("order_date").distinct().collect()}
    for gone in sorted(set(dates) - held_still):
        empty_partition(recomputed, fact, "order_date", str(gone))
    replace_partition(_by_date(now), f"{table}_state", "batch_day", str(day), date_literal(day))
    return dates


def backfill_from_state(
    spark: SparkSession, path: str, day: date | str, table: str, fact: str, *, allow_empty: bool = False
) -> tables.Loaded:
    """``tables.backfill_day``, reading the batch and stored state instead of every batch that shares a date."""
    loaded = tables.replace_day(spark, path, day, table, allow_empty=allow_empty)
    refresh_batch(spark, table, fact, day)
    return loaded
