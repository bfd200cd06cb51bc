"""Daily orders: the fact per day, and what repeated loads leave behind."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyline.functions.values import DELIVERED


def daily_orders(staged: DataFrame) -> DataFrame:
    """One row per order date. Revenue is NULL on a day without a delivery.

    Grouped by the order's own date, not by the batch that brought it: orders placed near
    midnight arrive a day later.
    """
    earned = F.when(F.col("status") == DELIVERED, F.col("amount_paise"))
    return (
        staged.groupBy("order_date")
        .agg(
            F.count(F.lit(1)).alias("order_rows"),
            F.count_distinct("order_id").alias("orders"),
            F.sum(earned).alias("delivered_revenue_paise"),
        )
    )


def duplicate_orders(staged: DataFrame) -> DataFrame:
    """Orders held more than once, with the batches they came from."""
    return (
        staged.where(F.col("order_id").isNotNull())
        .groupBy("order_id")
        .agg(
            F.count(F.lit(1)).alias("order_rows"),
            F.min("batch_day").alias("first_batch_day"),
            F.max("batch_day").alias("last_batch_day"),
        )
        .where(F.col("order_rows") > 1)
    )


def dedup_orders(staged: DataFrame) -> DataFrame:
    """One row per order: the copy of the latest batch, ties broken by the remaining columns.

    A maximum over a struct combines before the shuffle, so an order repeated a billion times
    still sends one row per task. Rows without an order id cannot be compared and stay.
    """
    rest = [name for name in staged.columns if name not in ("order_id", "batch_day")]
    kept = (
        staged.where(F.col("order_id").isNotNull())
        .groupBy("order_id")
        .agg(F.max(F.struct("batch_day", *rest)).alias("kept"))
        .select("order_id", "kept.*")
    )
    return kept.select(*staged.columns).unionByName(staged.where(F.col("order_id").isNull()))
