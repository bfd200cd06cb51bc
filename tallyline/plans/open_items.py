"""Open items over a chain of business days, each of which takes up what the day before it left open.

``differences`` and ``open_items`` have one partition per business day; ``open_items_days`` names every
day, also one without any item, and whether it has to be computed again. A day that is rerun makes the
next one due if what it leaves open changes, and so on until a day comes out as it was. The next
day is marked before its predecessor is replaced, so that a driver lost in between leaves a
mark that the next run takes up.
"""

from __future__ import annotations

from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tallyline.functions.times import date_literal
from tallyline.operators.carry import OPEN_ITEM, carry_forward, is_open, still_open
from tallyline.operators.digests import SEEDS, row_hash
from tallyline.session import scratch_folder, written
from tallyline.sources.partitions import replace_partition

OPEN_ITEM_TYPE = "payment_id string, merchant_id string, opened_on date, cause string, difference_paise bigint"
CARRIED_TYPE = (
    "payment_id string, merchant_id string, opened_on date, open_cause string, today_cause string, "
    "difference_paise bigint, status string, cause string"
)
DIFFERENCE_TYPE = "payment_id string, merchant_id string, cause string, difference_paise bigint"


def _days(spark: SparkSession, folder: str, name: str, schema: str) -> DataFrame:
    """A table by business day, empty if nothing is stored yet."""
    schema = StructType.fromDDL(f"{schema}, business_day date")
    try:
        return spark.read.schema(schema).parquet(f"{folder}/{name}")
    except AnalysisException:
        return spark.createDataFrame([], schema)


def _of_day(table: DataFrame, day: date) -> DataFrame:
    return table.where(F.col("business_day") == date_literal(day)).drop("business_day")


def open_items_of(spark: SparkSession, folder: str, day: date | str) -> DataFrame:
    """The stored items of a day, open and closed."""
    return _of_day(_days(spark, folder, "open_items", CARRIED_TYPE), day)


def known_days(spark: SparkSession, folder: str) -> dict[date, bool]:
    """Every day of the chain and whether it is due; bounded by the calendar. Items that are stored without
    marks, by an earlier version, give the days themselves."""
    marks = {day: due for due, day in _days(spark, folder, "open_items_days", "due boolean").collect()}
    if not marks:
        days = _days(spark, folder, "open_items", CARRIED_TYPE).select("business_day").distinct()
        marks = {row[0]: False for row in days.collect()}
    return dict(sorted(marks.items()))


def _mark(spark: SparkSession, folder: str, day: date | str, due: bool) -> None:
    mark = spark.createDataFrame([(due,)], "due boolean")
    replace_partition(mark, f"{folder}/open_items_days", "business_day", str(day), date_literal(day))


def mark_due(spark: SparkSession, folder: str, day: date | str) -> None:
    """A day is to be computed again. One that is new takes its place in the chain: the day behind it, which
    has followed from an earlier one so far, is then due whatever the new one leaves open."""
    days = known_days(spark, folder)
    behind = [d for d in days if d > date.fromisoformat(str(day))]
    if behind and date.fromisoformat(str(day)) not in days:
        _mark(spark, folder, behind[0], True)
    _mark(spark, folder, day, True)


def _compared(items: DataFrame, before: DataFrame) -> tuple[bool, bool]:
    """Whether a day's items differ from the stored ones, and whether what they leave open does."""
    columns, kept = sorted(items.columns), sorted(OPEN_ITEM)
    stays = F.lit("all"), F.when(is_open(), F.lit("open"))
    sides = [df.withColumn("side", F.lit(i)).withColumn("part", F.explode(F.array_compact(F.array(*stays)))) for i, df in enumerate((items, before))]
    hashes = [F.when(F.col("part") == "all", row_hash(columns, seed)).otherwise(row_hash(kept, seed)) for seed in SEEDS]
    sums = [F.sum(h.cast("decimal(20,0)")).alias(f"h{i}") for i, h in enumerate(hashes)]
    found = sides[0].unionByName(sides[1]).groupBy("side", "part").agg(F.count(F.lit(1)).alias("n"), *sums).collect()
    digests = {(row["side"], row["part"]): tuple(row)[2:] for row in found}
    return tuple(digests.get((0, part)) != digests.get((1, part)) for part in ("all", "open"))


def replay(spark: SparkSession, folder: str) -> list[date]:
    """Bring every day that is due up to date, in order; returns the days whose items have changed.

    A day costs one aggregate over its differences and what the day before left open. Nothing is
    computed beyond the last day that is due or that a changed day makes due.
    """
    days = known_days(spark, folder)
    chain, changed = list(days), []
    for at, day in enumerate(chain):
        if not days[day]:
            continue
        opened = still_open(open_items_of(spark, folder, chain[at - 1])) if at else spark.createDataFrame([], OPEN_ITEM_TYPE)
        today = _of_day(_days(spark, folder, "differences", DIFFERENCE_TYPE), day)
        items = written(carry_forward(opened, today, day), scratch_folder(spark, "open-items"))
        before = open_items_of(spark, folder, day)
        differ, open_differ = _compared(items, before)
        if differ:
            if open_differ and at + 1 < len(chain):
                days[chain[at + 1]] = True
                _mark(spark, folder, chain[at + 1], True)
            replace_partition(items, f"{folder}/open_items", "business_day", str(day), date_literal(day))
            changed.append(day)
        _mark(spark, folder, day, False)
    return changed


def close_day(spark: SparkSession, folder: str, day: date | str, differences: DataFrame) -> list[date]:
    """Store a day's differences and take them, and what follows from them, through the chain.

    Days may come in any order and again: the tables then are those of all days in order.
    """
    mark_due(spark, folder, day)
    replace_partition(differences, f"{folder}/differences", "business_day", str(day), date_literal(day))
    return replay(spark, folder)
