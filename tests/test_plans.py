"""The physical plans the operators are meant to have."""

from __future__ import annotations

import re

import pytest

from tallyline.catalog import QUERIES
from tallyline.operators import rollups
from tallyline.operators.matching import match_payments
from tallyline.operators.reports import unmatched_sample
from tallyline.operators.rollups import ledger_by_payment
from tallyline.sources import bucketed
from tallyline.sources.partitions import replace_partitions
from tallyline.sources.tables import orders_table

SMALL = "/root/testdata/sf0.001"
ACTING = set(
    """load_whole load_all_days load_day_append backfill_day export_csv check_all unmatched_sample product_pairs backfill_from_state
    take_deliveries stream_orders carry_replayed dim_sellers_history_late matched_stored""".split()
)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


NAMES = sorted(set(QUERIES) - ACTING)


@pytest.mark.parametrize("name", NAMES)
def test_no_cross_join_and_no_python_rows(spark, name):
    text = plan(QUERIES[name](spark, SMALL))
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|EvalPython", text)
    assert "MapInPandas" not in text


def test_transfer_lists_read_the_settlement_once(spark):
    text = plan(QUERIES["settlement_by_payment"](spark, SMALL))
    assert text.count("FileScan") == 1 and "rangepartitioning(payment_id" in text


def test_report_reads_each_side_once_and_joins_nothing(spark):
    text = plan(QUERIES["reconciliation_report"](spark, SMALL))
    assert text.count("FileScan") == 2 and "Join" not in text
    assert len(re.findall(r"Exchange hashpartitioning\(payment_id", text)) == 1
    assert "ObjectHashAggregate" not in text and "merchant" not in text.split("Union")[-1]


def test_totals_do_not_shuffle_by_payment(spark):
    assert "hashpartitioning" not in plan(QUERIES["recon_totals"](spark, SMALL))


def test_match_of_unstored_rollups_adds_no_shuffle(spark):
    ledger = QUERIES["stg_ledger"](spark, SMALL)
    rolled = ledger_by_payment(ledger)
    other = rolled.selectExpr(
        "payment_id", "merchant_id", "net_paise as gross_paise", "entry_count as utr_count", "merchant_id as utrs",
        "merchant_id as remarks", "cast(captured_ts as date) as captured_on", "cast(captured_ts as date) as settled_on",
    )
    text = plan(match_payments(rolled, other))
    assert len(re.findall(r"Exchange hashpartitioning\(payment_id", text)) == 2
    assert "SortMergeJoin" in text and "FullOuter" in text


def test_sample_is_limited_before_its_shuffle(spark):
    text = plan(unmatched_sample(QUERIES["matched"](spark, SMALL)))
    assert "WindowGroupLimit" in text and "Partial" in text.split("Exchange hashpartitioning(category")[1]


def test_narrow_reads_of_wide_tables(spark):
    text = plan(QUERIES["daily_orders"](spark, SMALL))
    schema = re.search(r"ReadSchema: struct<(.*?)>", text).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {"event_id", "ts", "event_type", "value"}


def test_day_and_date_filters_reach_the_scan(spark, tmp_path):
    table = str(tmp_path / "orders")
    replace_partitions(QUERIES["stg_daily_orders"](spark, SMALL), table, "batch_day")
    day = orders_table(spark, table).where("batch_day = date'2024-01-10'")
    assert re.search(r"PartitionFilters: \[isnotnull\(batch_day#\d+\), \(batch_day#\d+ = ", plan(day))
    dates = orders_table(spark, table).where("order_date in (date'2024-01-09', date'2024-01-10')")
    assert "PushedFilters: [In(order_date" in plan(dates)


def test_rollups_in_buckets_meet_without_a_shuffle(spark, ledger, settlement, tmp_path):
    ours = rollups.ledger_by_payment(ledger(*((f"p{i}", "capture", i, "09:00:00") for i in range(50)), (None, "capture", 1, "09:00:00")))
    bank = rollups.settlement_by_payment(settlement(*((f"U{i}", f"p{i}", i, "2025-09-15", None) for i in range(20, 70))))
    stored = [bucketed.store_buckets(df, f"{tmp_path}/{i}", "payment_id", 4) for i, df in enumerate((ours, bank))]
    again = [bucketed.open_buckets(spark, f"{tmp_path}/{i}", df.schema, "payment_id", 4) for i, df in enumerate((ours, bank))]
    expected = sorted(map(tuple, match_payments(ours, bank).collect()), key=repr)
    for sides in (stored, again):
        matched = match_payments(*sides)
        assert "Exchange" not in plan(matched)
        assert sorted(map(tuple, matched.collect()), key=repr) == expected
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("buckets_")]
