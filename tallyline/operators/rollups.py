"""One row per payment on each side, so that the match cannot fan out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from tallyline.functions.values import CAPTURE, REFUND


def _when_captured(value: Column) -> Column:
    return F.when(F.col("entry_type") == CAPTURE, value)


def _when_refunded(value: Column) -> Column:
    return F.when(F.col("entry_type") == REFUND, value)


def signed_paise() -> Column:
    """Captures count up and every other entry counts down, an unknown type included."""
    return _when_captured(F.col("amount_paise")).otherwise(-F.col("amount_paise"))


def ledger_figures(of: Callable[[Column], Column] = lambda value: value) -> list[Column]:
    """The sums and times of a payment's ledger entries; ``of`` may limit them to some rows."""
    amount, moment, nothing = F.col("amount_paise"), F.col("entry_ts"), F.lit(0).cast("bigint")
    return [
        F.sum(of(_when_captured(amount).otherwise(nothing))).alias("captured_paise"),
        F.sum(of(_when_refunded(amount).otherwise(nothing))).alias("refunded_paise"),
        F.sum(of(signed_paise())).alias("net_paise"),
        F.min(of(_when_captured(moment))).alias("captured_ts"),
        F.min(of(_when_refunded(moment))).alias("refunded_ts"),
    ]


def ledger_by_payment(ledger: DataFrame) -> DataFrame:
    return ledger.groupBy("payment_id").agg(
        F.min("merchant_id").alias("merchant_id"),
        F.count(F.lit(1)).alias("entry_count"),
        *ledger_figures(),
    )


def _joined(value: str, order: str) -> Column:
    return F.expr(f"listagg({value}, ',') within group (order by {order})")


def long_payments(settlement: DataFrame, more_than: int) -> DataFrame:
    """Payments with more than so many transfers; reads one column."""
    counts = settlement.groupBy("payment_id").agg(F.count(F.lit(1)).alias("utr_count"))
    return counts.where(F.col("utr_count") > more_than)


def long_payment_utrs(settlement: DataFrame, more_than: int = 1) -> DataFrame:
    """Every transfer of the payments with more than so many of them, as rows."""
    long = long_payments(settlement, more_than).select(F.col("payment_id").alias("long_id"))
    return settlement.join(
        long, F.col("payment_id").eqNullSafe(F.col("long_id")), "left_semi"
    ).select("payment_id", "utr", "remarks", "gross_paise", "settled_on")


def settlement_by_payment(settlement: DataFrame) -> DataFrame:
    """One row per payment; gross is summed over its transfers so a double shows up.

    ``utrs`` and ``remarks`` are the whole texts in the order of transfers. Rows are dealt by
    ranges of payment and transfer, so that a payment with a third of all rows is sorted and
    joined into text piece by piece, each range a piece in a task of its own; only the pieces
    meet in the payment's cell. A cell beyond Spark's size for one fails the job.
    """
    ranges = settlement.repartitionByRange("payment_id", F.asc_nulls_last("utr"))
    pieces = ranges.withColumn("piece", F.spark_partition_id()).groupBy("payment_id", "piece").agg(
        F.min("merchant_id").alias("merchant_id"),
        F.count(F.lit(1)).alias("utr_count"),
        _joined("utr", "utr nulls last").alias("utrs"),
        F.sum("gross_paise").alias("gross_paise"),
        F.sum("net_paise").alias("net_paise"),
        F.min("captured_on").alias("captured_on"),
        F.min("settled_on").alias("settled_on"),
        _joined("remarks", "utr nulls last").alias("remarks"),
    )
    return pieces.groupBy("payment_id").agg(
        F.min("merchant_id").alias("merchant_id"),
        F.sum("utr_count").alias("utr_count"),
        _joined("utrs", "piece").alias("utrs"),
        F.sum("gross_paise").alias("gross_paise"),
        F.sum("net_paise").alias("net_paise"),
        F.min("captured_on").alias("captured_on"),
        F.min("settled_on").alias("settled_on"),
        _joined("remarks", "piece").alias("remarks"),
    )


def lists_of_few(payments: DataFrame, settlement: DataFrame) -> DataFrame:
    """Add ``utrs`` and ``remarks`` to a handful of payments.

    Only for a selection whose size is bounded by its caller: its ids are broadcast, so the
    settlement rows are filtered before anything is shuffled. The lists are as long as they are;
    the planner joins them.
    """
    wanted = payments.select(F.col("payment_id").alias("wanted"))
    rows = settlement.join(F.broadcast(wanted), F.col("payment_id") == F.col("wanted"), "left_semi")
    lists = settlement_by_payment(rows).select("payment_id", "utrs", "remarks")
    return payments.join(lists, "payment_id", "left")
