from __future__ import annotations

import random
from datetime import datetime

import pytest
from helpers import LEDGER, SETTLEMENT, rows
from pyspark.sql import functions as F

from tallyline.functions import values as v
from tallyline.operators import quality, reports, rollups
from tallyline.operators.matching import classify_differences, match_figures
from tallyline.plans import reconcile

DAY, CUTOFF = "2025-09-15", "2025-09-15 18:00:00"


def causes(ledger, settlement, cutoff=CUTOFF, day=DAY):
    found = classify_differences(reconcile.match_day(ledger, settlement), cutoff, day)
    return {r.payment_id: (r.cause, r.needs_human) for r in found.collect()}


def test_rollup_counts_any_other_entry_type_against_net_only(ledger):
    df = ledger(
        ("p", "capture", 100, "10:00:00"),
        ("p", "refund", 30, "11:00:00"),
        ("p", "chargeback", 5, "12:00:00"),
        ("p", None, 1, "13:00:00"),
    )
    row = rollups.ledger_by_payment(df).first()
    assert (row.captured_paise, row.refunded_paise, row.net_paise, row.entry_count) == (100, 30, 64, 4)
    assert row.refunded_ts == datetime(2025, 9, 15, 11)


def test_settlement_lists_are_ordered_by_utr_and_skip_nulls(settlement):
    df = settlement(
        ("U3", "p", 10, DAY, "RESUBMIT"), ("U1", "p", 10, DAY, None), ("U2", "p", 10, DAY, "LATE"), ("U9", "q", 5, DAY, None)
    )
    assert rows(rollups.settlement_by_payment(df), "payment_id", "utr_count", "utrs", "gross_paise", "remarks") == {
        ("p", 3, "U1,U2,U3", 30, "LATE,RESUBMIT"),
        ("q", 1, "U9", 5, None),
    }


def test_a_payment_with_a_third_of_all_rows_has_its_whole_list_in_order(settlement):
    number = [f"U{i * 7919 % 3000:05}" for i in range(3000)]
    df = settlement(
        *((u, "hot", 1, DAY, f"r{u}" if i % 3 else None) for i, u in enumerate(number)),
        *((f"N{i:03}", None, 1, DAY, None) for i in range(40)),
        *((f"X{i}", f"p{i % 2500}", 7, DAY, None) for i in range(5000)),
    ).repartition(5)
    found = {r.payment_id: r for r in rollups.settlement_by_payment(df).collect()}
    assert len(found) == 2502 and found["hot"].utr_count == found["hot"].gross_paise == 3000
    assert found["hot"].utrs == ",".join(sorted(number))
    assert found["hot"].remarks == ",".join(sorted(f"r{u}" for i, u in enumerate(number) if i % 3))
    assert found[None].utrs == ",".join(f"N{i:03}" for i in range(40)) and found["p7"].utrs == "X2507,X7"
    as_rows = rollups.long_payment_utrs(df, more_than=20)
    assert as_rows.count() == 3040 and rows(as_rows.select("payment_id").distinct()) == {("hot",), (None,)}


def test_cutoff_second_itself_is_after_the_cutoff(ledger, settlement):
    found = causes(
        ledger(("before", "capture", 1, "17:59:59"), ("at", "capture", 1, "18:00:00")), settlement()
    )
    assert found == {"before": (v.NEVER_SETTLED, True), "at": (v.AFTER_CUTOFF, False)}


def test_cutoff_and_day_are_arguments(ledger, settlement):
    found = causes(ledger(("p", "capture", 1, "17:59:59")), settlement(), cutoff=datetime(2025, 9, 15, 12))
    assert found == {"p": (v.AFTER_CUTOFF, False)}


def test_refund_only_payment_is_missing_but_not_flagged(ledger, settlement):
    assert causes(ledger(("p", "refund", 5, "09:00:00")), settlement()) == {"p": (v.NEVER_SETTLED, False)}


def test_settlement_only_on_the_day_itself_is_unexplained(ledger, settlement):
    found = causes(ledger(), settlement(("U1", "p", 5, DAY, None), ("U2", "q", 5, "2025-09-14", None)))
    assert found == {"p": (v.UNEXPLAINED, False), "q": (v.PRIOR_DAY_CAPTURE, False)}


def test_two_transfers_that_add_up_are_a_match(ledger, settlement):
    found = causes(
        ledger(("p", "capture", 10, "09:00:00")), settlement(("U1", "p", 4, DAY, None), ("U2", "p", 6, DAY, None))
    )
    assert found == {}


def test_rule_order_doubled_before_late_refund_before_rounding(ledger, settlement):
    found = causes(
        ledger(
            ("double", "capture", 100, "09:00:00"),
            ("double", "refund", 10, "19:00:00"),
            ("late", "capture", 100, "09:00:00"),
            ("late", "refund", 1, "19:00:00"),
            ("early", "capture", 100, "09:00:00"),
            ("early", "refund", 1, "12:00:00"),
            ("big", "capture", 100, "09:00:00"),
        ),
        settlement(
            ("U1", "double", 50, DAY, None),
            ("U2", "double", 50, DAY, "RESUBMIT"),
            ("U3", "late", 100, DAY, None),
            ("U4", "early", 100, DAY, None),
            ("U5", "big", 98, DAY, None),
        ),
    )
    assert found == {
        "double": (v.SETTLED_TWICE, True),
        "late": (v.LATE_REFUND, False),
        "early": (v.ROUNDING, False),
        "big": (v.UNEXPLAINED, False),
    }


def test_null_keys_never_meet_and_null_amounts_differ(ledger, settlement):
    matched = reconcile.match_day(
        ledger((None, "capture", 5, "09:00:00"), ("p", "capture", None, "09:00:00")),
        settlement(("U1", None, 5, DAY, None), ("U2", "p", 1, DAY, None)),
    )
    found = rows(matched, "payment_id", "category", "difference_paise")
    assert ("p", v.DIFFERING, -1) in found
    assert {r for r in found if r[0] is None} == {(None, v.LEDGER_ONLY, 5), (None, v.LEDGER_ONLY, -5)}
    figures = match_figures(
        ledger((None, "capture", 5, "09:00:00"), ("p", "capture", None, "09:00:00")),
        settlement(("U1", None, 5, DAY, None), ("U2", "p", 1, DAY, None)),
    )
    assert rows(figures) == rows(matched, *figures.columns)


def test_report_has_its_total_row_on_empty_input(ledger, settlement):
    report = reconcile.report_day(ledger(), settlement(), CUTOFF, DAY)
    assert [tuple(r) for r in report.collect()] == [(v.TOTAL_LABEL, None, None, None)]


def test_report_lists_people_last_but_total(ledger, settlement):
    report = reconcile.report_day(
        ledger(("a", "capture", 10, "19:00:00"), ("b", "capture", 3, "09:00:00")),
        settlement(("U1", "c", 4, "2025-09-14", None)),
        CUTOFF,
        DAY,
    )
    assert [tuple(r) for r in report.collect()] == [
        (v.PRIOR_DAY_CAPTURE, False, 1, -4),
        (v.AFTER_CUTOFF, False, 1, 10),
        (v.NEVER_SETTLED, True, 1, 3),
        (v.TOTAL_LABEL, None, 3, 9),
    ]


def test_totals_and_checks_treat_an_empty_side_as_zero(ledger, settlement):
    ours, bank = ledger(("p", "capture", 10, "09:00:00")), settlement()
    assert tuple(reports.totals(ours, bank).first()) == (10, 0, 10)
    nothing = reports.category_summary(match_figures(ledger(), settlement()))
    assert rows(quality.category_gap(nothing, ours, bank)) == {(0, 10)}


def test_sample_takes_the_first_of_each_category(ledger, settlement):
    matched = reconcile.match_day(
        ledger(*((f"p{i:02}", "capture", 1, "09:00:00") for i in range(30))),
        settlement(*((f"U{i}", f"q{i}", 1, DAY, None) for i in range(3))),
    )
    sample = reports.unmatched_sample(matched, 10)
    assert rows(sample.where(F.col("category") == v.LEDGER_ONLY), "payment_id", "rn") == {
        (f"p{i:02}", i + 1) for i in range(10)
    }
    assert sample.count() == 13


def test_every_payment_lands_once_and_differences_close_the_gap(spark):
    rng = random.Random(7)
    moments = [datetime(2025, 9, 15, h, m) for h in range(24) for m in (0, 30)]
    ours = [
        (f"e{i}", f"p{rng.randint(0, 300)}", "M", rng.choice(["capture", "capture", "refund"]), rng.randint(1, 9), "INR", rng.choice(moments), "upi")
        for i in range(500)
    ]
    bank = [
        (f"U{i}", f"p{rng.randint(100, 400)}", "M", rng.randint(1, 9), 0, 0, 0, None, None, None) for i in range(400)
    ]
    ledger, settlement = spark.createDataFrame(ours, LEDGER), spark.createDataFrame(bank, SETTLEMENT)
    matched = match_figures(ledger, settlement)
    assert sorted(r.payment_id for r in matched.collect()) == sorted({r[1] for r in ours} | {r[1] for r in bank})
    assert quality.category_gap(reports.category_summary(matched), ledger, settlement).count() == 0
    rolled = rollups.ledger_by_payment(ledger), rollups.settlement_by_payment(settlement)
    assert quality.coverage_gaps(*rolled, matched).count() == 0
    joined = reconcile.match_day(ledger, settlement)
    assert sorted(matched.collect(), key=repr) == sorted(joined.select(*matched.columns).collect(), key=repr)


def test_stored_day_is_rerunnable_and_other_days_stay(ledger, settlement, tmp_path):
    folder = str(tmp_path)
    ours = ledger(("p", "capture", 10, "09:00:00"), ("q", "capture", 5, "19:00:00"))
    bank = settlement(("U1", "p", 10, DAY, None))
    for _ in range(2):
        tables = reconcile.reconcile_day(ours, bank, CUTOFF, DAY, folder)
    other = reconcile.reconcile_day(ours, bank, "2025-09-16 18:00:00", "2025-09-16", folder)
    assert rows(tables["matched"], "payment_id", "category") == {("p", v.MATCHED), ("q", v.LEDGER_ONLY)}
    assert tables["matched"].columns == reconcile.match_day(ours, bank).columns
    assert other["matched"].count() == 2
    assert tables["reconciliation_report"].count() == 2


def test_stored_day_whose_differences_vanish(ledger, settlement, tmp_path):
    ours = ledger(("p", "capture", 10, "19:00:00"))
    first = reconcile.reconcile_day(ours, settlement(), CUTOFF, DAY, str(tmp_path))
    assert first["differences"].count() == 1
    again = reconcile.reconcile_day(ours, settlement(("U1", "p", 10, DAY, None)), CUTOFF, DAY, str(tmp_path))
    assert again["differences"].count() == 0
    assert rows(again["reconciliation_report"]) == {(v.TOTAL_LABEL, None, None, None)}


def test_stored_day_stops_on_a_failed_check(ledger, settlement, tmp_path):
    unexplained = settlement(("U1", "p", 10, DAY, None))
    with pytest.raises(quality.CheckFailed, match="accepted_values"):
        reconcile.reconcile_day(ledger(), unexplained, CUTOFF, DAY, str(tmp_path))
    with pytest.raises(quality.CheckFailed, match="payment_id"):
        reconcile.reconcile_day(ledger((None, "capture", 1, "09:00:00")), settlement(), CUTOFF, DAY, str(tmp_path))


def test_stored_days_carry_their_open_items(ledger, settlement, tmp_path):
    folder = str(tmp_path)
    first = reconcile.reconcile_day(ledger(("p", "capture", 10, "19:00:00")), settlement(), CUTOFF, DAY, folder)
    assert rows(first["open_items"], "payment_id", "status") == {("p", "new")}
    bank = settlement(("U1", "p", 10, "2025-09-15", None))
    again = reconcile.reconcile_day(ledger(), bank, "2025-09-16 18:00:00", "2025-09-16", folder)
    assert rows(again["open_items"], "payment_id", "status", "difference_paise") == {("p", "closed", 0)}
    third = reconcile.reconcile_day(ledger(), settlement(), "2025-09-17 18:00:00", "2025-09-17", folder)
    assert third["open_items"].count() == 0
