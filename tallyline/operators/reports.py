"""Summaries and reading aids over the match."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tallyline.functions import values as v
from tallyline.functions.money import amount_or_zero
from tallyline.operators.rollups import signed_paise


def category_summary(matched: DataFrame) -> DataFrame:
    return (
        matched.groupBy("category")
        .agg(
            F.count(F.lit(1)).alias("payments"),
            F.sum("ledger_paise").alias("ledger_paise"),
            F.sum("settlement_paise").alias("settlement_paise"),
            F.sum("difference_paise").alias("difference_paise"),
        )
        .orderBy("category")
    )


def reconciliation_report(differences: DataFrame) -> DataFrame:
    """One row per cause and a total row, which is there even without any difference.

    The differences are aggregated once; the handful of per-cause rows is then counted both
    under its own label and under the total's.
    """
    by_cause = differences.groupBy("cause").agg(
        F.bool_or("needs_human").alias("needs_human"),
        F.count(F.lit(1)).alias("payments"),
        F.sum("difference_paise").alias("difference_paise"),
    )
    twice = by_cause.select(
        F.explode(F.array(F.col("cause"), F.lit(v.TOTAL_LABEL))).alias("cause"),
        "needs_human",
        "payments",
        "difference_paise",
    )
    empty_total = differences.sparkSession.range(1).select(
        F.lit(v.TOTAL_LABEL).alias("cause"),
        F.lit(None).cast("boolean").alias("needs_human"),
        F.lit(None).cast("bigint").alias("payments"),
        F.lit(None).cast("bigint").alias("difference_paise"),
    )
    own_cause = F.col("cause") != v.TOTAL_LABEL
    return (
        twice.unionByName(empty_total)
        .groupBy("cause")
        .agg(
            F.bool_or(F.when(own_cause, F.col("needs_human"))).alias("needs_human"),
            F.sum("payments").alias("payments"),
            F.sum("difference_paise").alias("difference_paise"),
        )
        .orderBy(F.asc_nulls_last("needs_human"), F.asc_nulls_last("difference_paise"))
    )


def totals(ledger: DataFrame, settlement: DataFrame) -> DataFrame:
    """Ledger net, settlement gross and the gap, straight from the staged rows.

    Summing per payment first would give the same figures and cost two shuffles. An empty side
    counts as 0, so a missing file cannot hide in a NULL gap.
    """
    net = ledger.agg(F.sum(signed_paise())).scalar()
    gross = settlement.agg(F.sum("gross_paise")).scalar()
    return (
        ledger.sparkSession.range(1)
        .select(
            amount_or_zero(net).alias("ledger_net_paise"),
            amount_or_zero(gross).alias("settlement_gross_paise"),
        )
        .withColumn(
            "difference_paise", F.col("ledger_net_paise") - F.col("settlement_gross_paise")
        )
    )


def _rows_per_key(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("rows_"))


def profile_key(df: DataFrame, key: str, side: str) -> DataFrame:
    """Rows, distinct keys and the surplus of one relation."""
    return (
        _rows_per_key(df, key)
        .agg(
            F.coalesce(F.sum("rows_"), F.lit(0)).alias("rows_"),
            F.count("key").alias(f"distinct_{key}s"),
        )
        .select(
            F.lit(side).alias("side"),
            "rows_",
            f"distinct_{key}s",
            (F.col("rows_") - F.col(f"distinct_{key}s")).alias("extra_rows"),
        )
    )


def key_uniqueness(ledger: DataFrame, settlement: DataFrame) -> DataFrame:
    """Is payment_id unique, per side and per rollup.

    A rollup has one row per key group, so the groups counted for a side are its rollup's rows:
    each side is read and shuffled once for both of its lines.
    """
    parts = []
    for side, df in (("ledger", ledger), ("settlement", settlement)):
        counted = _rows_per_key(df, "payment_id").agg(
            F.coalesce(F.sum("rows_"), F.lit(0)).alias("raw_rows"),
            F.count(F.lit(1)).alias("rollup_rows"),
            F.count("key").alias("keys"),
        )
        both = F.array(
            F.struct(F.lit(side).alias("side"), F.col("raw_rows").alias("rows_")),
            F.struct(F.lit(f"{side}_by_payment").alias("side"), F.col("rollup_rows").alias("rows_")),
        )
        parts.append(counted.select(F.inline(both), F.col("keys").alias("distinct_payment_ids")))
    return parts[0].unionByName(parts[1]).withColumn(
        "extra_rows", F.col("rows_") - F.col("distinct_payment_ids")
    )


def key_duplicates(ledger: DataFrame, settlement: DataFrame) -> DataFrame:
    """How many payments have how many rows, per side."""
    parts = [
        _rows_per_key(df, "payment_id")
        .groupBy(F.lit(side).alias("side"), F.col("rows_").alias("rows_per_payment"))
        .agg(F.count(F.lit(1)).alias("payments"))
        for side, df in (("ledger", ledger), ("settlement", settlement))
    ]
    return parts[0].unionByName(parts[1]).orderBy("side", "rows_per_payment")


def unmatched_sample(matched: DataFrame, per_category: int = 10) -> DataFrame:
    """The first payments of each unmatched category.

    The rank filter is pushed below the shuffle, so each task sends at most ``per_category``
    rows of a category however large the category is.
    """
    ranked = Window.partitionBy("category").orderBy(F.asc_nulls_last("payment_id"))
    return (
        matched.where(F.col("category") != v.MATCHED)
        .withColumn("rn", F.row_number().over(ranked))
        .where(F.col("rn") <= per_category)
        .orderBy("category", "rn")
    )


def difference_report(differences: DataFrame) -> DataFrame:
    """Every difference, the ones for a person first. Sorted by ranges, not in one task."""
    return differences.select(
        "payment_id",
        "merchant_id",
        "cause",
        "needs_human",
        "difference_paise",
        "ledger_paise",
        "settlement_paise",
        "captured_ts",
        "refunded_ts",
        "utrs",
        "bank_captured_on",
        "settled_on",
        "remarks",
    ).orderBy(F.desc("needs_human"), "cause", F.asc_nulls_last("payment_id"))
