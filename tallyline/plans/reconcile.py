"""One business day of two-system reconciliation, from staged rows to stored results."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DateType, StructField, StructType

from tallyline.functions.times import date_literal
from tallyline.operators import quality
from tallyline.operators.matching import classify_differences, match_figures, match_payments
from tallyline.operators.reports import category_summary, reconciliation_report, unmatched_sample
from tallyline.operators.rollups import ledger_by_payment, lists_of_few, settlement_by_payment
from tallyline.plans.checks import assert_checks
from tallyline.plans.open_items import mark_due, open_items_of, replay
from tallyline.session import scratch_folder, written
from tallyline.sources.partitions import replace_partition


def match_day(ledger: DataFrame, settlement: DataFrame) -> DataFrame:
    """Every payment of both sides with its category, the transfer lists included."""
    return match_payments(ledger_by_payment(ledger), settlement_by_payment(settlement))


def report_day(ledger: DataFrame, settlement: DataFrame, cutoff: datetime | str, day: date | str) -> DataFrame:
    """From staged rows to the report finance reads: one scan per side, one large shuffle."""
    return reconciliation_report(classify_differences(match_figures(ledger, settlement), cutoff, day))


def sample_day(ledger: DataFrame, settlement: DataFrame, per_category: int = 10) -> DataFrame:
    """The first unmatched payments of each category, with their transfer lists.

    The lists are gathered for the sampled payments only: ``per_category`` rows for each of three
    categories, stored first so that the match runs once.
    """
    sample = unmatched_sample(match_figures(ledger, settlement), per_category)
    few = written(sample, scratch_folder(sample.sparkSession, "sample"))
    return lists_of_few(few, settlement).orderBy("category", "rn")


def reconcile_day(
    ledger: DataFrame, settlement: DataFrame, cutoff: datetime | str, day: date | str, folder: str
) -> dict[str, DataFrame]:
    """Store and check one day's results; rerunning the day replaces them.

    The rollups and the match are written once and read by everything after them. Each table
    has one partition per business day. The checks run on the stored rows, the input checks
    before the match; a failed one raises and names its rows. Open items of later days that are
    stored already follow from the new ones.
    """
    spark = ledger.sparkSession

    def stored(df: DataFrame, name: str) -> DataFrame:
        table, business_day = f"{folder}/{name}", date_literal(day)
        replace_partition(df, table, "business_day", str(day), business_day)
        schema = StructType([*df.schema.fields, StructField("business_day", DateType())])
        stored_days = df.sparkSession.read.schema(schema).parquet(table)
        return stored_days.where(F.col("business_day") == business_day).drop("business_day")

    tables = {"stg_ledger": ledger, "stg_settlement": settlement}
    assert_checks(tables)
    for name, rollup in (
        ("ledger_by_payment", ledger_by_payment(ledger)),
        ("settlement_by_payment", settlement_by_payment(settlement)),
    ):
        tables[name] = stored(rollup, name)
    ours, bank = tables["ledger_by_payment"], tables["settlement_by_payment"]
    matched = stored(match_payments(ours, bank), "matched")
    mark_due(spark, folder, day)
    differences = stored(classify_differences(matched, cutoff, day), "differences")
    summary = stored(category_summary(matched), "category_summary")
    tables |= {"matched": matched, "differences": differences, "category_summary": summary}
    replay(spark, folder)
    tables["open_items"] = open_items_of(spark, folder, day)
    tables["reconciliation_report"] = stored(reconciliation_report(differences), "reconciliation_report")

    assert_checks({name: tables[name] for name in ("ledger_by_payment", "settlement_by_payment", "matched", "differences")})
    quality.assert_empty(quality.coverage_gaps(ours, bank, matched), "categories do not cover both sides")
    quality.assert_empty(quality.category_gap(summary, ledger, settlement), "categories do not add up to the gap")
    quality.assert_empty(quality.cause_gap(differences, ledger, settlement), "causes do not add up to the gap")
    return tables
