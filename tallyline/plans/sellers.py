"""The seller dimension over any number of snapshots."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyline.functions.times import date_literal
from tallyline.operators.sellers import HISTORY_COLUMNS, apply_snapshot, history_of, open_history
from tallyline.schemas import SELLERS
from tallyline.session import written
from tallyline.sources.partitions import replace_partition


def seller_history(snapshots: list[DataFrame], history_columns: tuple[str, ...] = HISTORY_COLUMNS) -> DataFrame:
    """Fold snapshots, oldest first, into the dimension with history.

    For a long series, store the dimension after each snapshot and call ``apply_snapshot`` on
    the stored one, so that the plan stays one join long.
    """
    first, *later = snapshots
    return reduce(lambda dim, snap: apply_snapshot(dim, snap, history_columns), later, open_history(first))


def stored_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(SELLERS).parquet(f"{folder}/seller_snapshots")


def add_snapshots(spark: SparkSession, folder: str, snapshots: dict[date | str, DataFrame]) -> None:
    """Store exports, one partition per date: one that comes again replaces itself, a late one takes its place."""
    for day, snapshot in snapshots.items():
        rows = snapshot.select(*SELLERS.names).where(F.col("snapshot_date") == date_literal(day))
        replace_partition(rows, f"{folder}/seller_snapshots", "snapshot_date", str(day), date_literal(day))


def rebuild_history(spark: SparkSession, folder: str, history_columns: tuple[str, ...] = HISTORY_COLUMNS) -> DataFrame:
    """The dimension over all stored exports, whatever their order and number: one shuffle, then stored."""
    return written(history_of(stored_snapshots(spark, folder), history_columns), f"{folder}/dim_sellers_history")
