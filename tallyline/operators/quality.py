"""Checks return the offending rows; an empty result is a pass."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyline.functions import values as v
from tallyline.functions.money import amount_or_zero
from tallyline.operators.reports import totals


class CheckFailed(AssertionError):
    """A check returned rows."""


def assert_empty(violations: DataFrame, message: str) -> None:
    """Raise if a check returned anything; reads no more than one row."""
    found = violations.take(1)
    if found:
        raise CheckFailed(f"{message}: {found[0].asDict()}")


def repeated_keys(df: DataFrame, column: str) -> DataFrame:
    """Values held by more than one row. NULL is the business of the not-null check."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("rows_"))
        .where(F.col("rows_") > 1)
    )


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """All columns of a table in one pass; one row per column that holds a NULL."""
    counts = df.agg(*(F.count_if(F.col(name).isNull()).alias(name) for name in columns))
    per_column = F.array(
        *(F.struct(F.lit(n).alias("column_name"), F.col(n).alias("null_rows")) for n in columns)
    )
    return counts.select(F.inline(per_column)).where(F.col("null_rows") > 0)


def unaccepted_values(df: DataFrame, column: str, accepted: list[str]) -> DataFrame:
    """Values outside the closed set. NULL passes."""
    return (
        df.where(~F.col(column).isin(accepted))
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("rows_"))
    )


def coverage_gaps(ledger_payments: DataFrame, settlement_payments: DataFrame, matched: DataFrame) -> DataFrame:
    """The categories must add up to the payments of each side.

    The sides hold one row per payment: the rollups, or just their distinct payment ids.
    """
    category = F.col("category")
    sides = matched.agg(
        F.count_if(category.isin(v.MATCHED, v.DIFFERING, v.LEDGER_ONLY)).alias("ledger_matched"),
        F.count_if(category.isin(v.MATCHED, v.DIFFERING, v.SETTLEMENT_ONLY)).alias("settlement_matched"),
        F.count_if(~category.isin(v.CATEGORIES)).alias("unbucketed"),
    )
    return sides.select(
        ledger_payments.agg(F.count(F.lit(1))).scalar().alias("ledger_payments"),
        settlement_payments.agg(F.count(F.lit(1))).scalar().alias("settlement_payments"),
        "*",
    ).where(
        (F.col("ledger_payments") != F.col("ledger_matched"))
        | (F.col("settlement_payments") != F.col("settlement_matched"))
        | (F.col("unbucketed") != 0)
    )


def category_gap(summary: DataFrame, ledger: DataFrame, settlement: DataFrame) -> DataFrame:
    """The categories' differences must add up to the gap of the staged rows.

    Sums count an empty side as 0; NULL would make any comparison pass.
    """
    by_category = summary.agg(F.sum("difference_paise")).scalar()
    return (
        totals(ledger, settlement)
        .select(
            amount_or_zero(by_category).alias("by_category"),
            F.col("difference_paise").alias("gap"),
        )
        .where(F.col("by_category") != F.col("gap"))
    )


def cause_gap(differences: DataFrame, ledger: DataFrame, settlement: DataFrame) -> DataFrame:
    """No difference is unexplained, and the explained ones add up to the gap."""
    explained = differences.agg(
        F.count_if(F.col("cause") == v.UNEXPLAINED).alias("unexplained_rows"),
        amount_or_zero(F.sum("difference_paise")).alias("explained_paise"),
    )
    gap = totals(ledger, settlement).select("difference_paise").scalar()
    return explained.withColumn("gap_paise", gap).where(
        (F.col("unexplained_rows") != 0) | (F.col("explained_paise") != F.col("gap_paise"))
    )


def settlement_math(settlement: DataFrame) -> DataFrame:
    """Transfers whose net is not gross less fee less tax; an amount that is missing counts too."""
    expected = F.col("gross_paise") - F.col("fee_paise") - F.col("tax_paise")
    return settlement.where(~F.col("net_paise").eqNullSafe(expected) | expected.isNull()).select(
        "utr",
        "payment_id",
        "gross_paise",
        "fee_paise",
        "tax_paise",
        "net_paise",
        (F.col("net_paise") - expected).alias("off_by_paise"),
    )


def merchant_conflicts(rows: DataFrame) -> DataFrame:
    """Payments whose rows name different merchants; the rollups show the smallest one."""
    return (
        rows.groupBy("payment_id")
        .agg(
            F.min("merchant_id").alias("first_merchant"),
            F.max("merchant_id").alias("last_merchant"),
            F.count(F.lit(1)).alias("rows_"),
        )
        .where(F.col("first_merchant") != F.col("last_merchant"))
    )
