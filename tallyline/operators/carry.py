"""Open items of one business day against the next day's differences."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from tallyline.functions.times import date_literal
from tallyline.functions.values import AFTER_CUTOFF, LATE_REFUND, PRIOR_DAY_CAPTURE

# Causes that time is expected to settle.
CARRIED_CAUSES = [AFTER_CUTOFF, PRIOR_DAY_CAPTURE, LATE_REFUND]


OPEN_ITEM = ["payment_id", "merchant_id", "opened_on", "cause", "difference_paise"]


def open_items(differences: DataFrame, day: date | str) -> DataFrame:
    """The differences of ``day`` that the following days should reverse."""
    return differences.where(F.col("cause").isin(CARRIED_CAUSES)).withColumn("opened_on", date_literal(day)).select(*OPEN_ITEM)


def is_open() -> Column:
    """Whether an item of a day is for the next one to reverse."""
    return (F.col("status") != "closed") & F.col("cause").isin(CARRIED_CAUSES)


def still_open(carried: DataFrame) -> DataFrame:
    """What a day leaves for the next one to reverse, in the shape ``carry_forward`` takes."""
    return carried.where(is_open()).select(*OPEN_ITEM)


def carry_forward(opened: DataFrame, today: DataFrame, day: date | str) -> DataFrame:
    """What is left per payment after ``today``'s differences meet the open items.

    A capture the bank had not settled (+) and the next file's row for it (-) add up to zero.
    One combining aggregate over both inputs; the day's new differences open new items. An item
    keeps the day and cause it was opened with, however many days it is carried.
    """
    before = opened.select(*OPEN_ITEM, F.lit(True).alias("was_open"))
    now = today.withColumn("opened_on", date_literal(day)).select(*OPEN_ITEM, F.lit(False).alias("was_open"))
    was_open, remaining = F.col("was_open"), F.col("difference_paise")
    status = (
        F.when(~F.col("carried"), "new")
        .when(remaining == 0, "closed")
        .when(F.col("today_cause").isNull(), "still_open")
        .otherwise("changed")
    )
    return (
        before.unionByName(now)
        .groupBy("payment_id")
        .agg(
            F.min("merchant_id").alias("merchant_id"),
            F.min("opened_on").alias("opened_on"),
            F.bool_or(was_open).alias("carried"),
            F.min(F.when(was_open, F.col("cause"))).alias("open_cause"),
            F.min(F.when(~was_open, F.col("cause"))).alias("today_cause"),
            F.sum("difference_paise").alias("difference_paise"),
        )
        .withColumn("status", status)
        .withColumn("cause", F.coalesce("open_cause", "today_cause"))
        .drop("carried")
    )


def carry_summary(carried: DataFrame) -> DataFrame:
    return carried.groupBy("status").agg(
        F.count(F.lit(1)).alias("payments"), F.sum("difference_paise").alias("difference_paise")
    )
