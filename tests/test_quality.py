from __future__ import annotations

from datetime import date

import pytest
from helpers import rows

from tallyline.functions import values as v
from tallyline.operators import carry, compare, quality
from tallyline.operators.matching import classify_differences, match_figures
from tallyline.plans import checks

DAY, CUTOFF = "2025-09-15", "2025-09-15 18:00:00"


def test_there_are_38_column_checks():
    sizes = [(len(c.unique), len(c.not_null), len(c.accepted)) for c in checks.CHECKS.values()]
    assert tuple(map(sum, zip(*sizes))) == (12, 24, 2)


def test_column_checks_find_planted_faults(spark):
    df = spark.createDataFrame(
        [("a", "matched"), ("a", "odd"), (None, "matched"), (None, None)], "payment_id string, category string"
    )
    found = checks.run_checks({"matched": df, "not checked": df})
    assert rows(found) == {
        ("matched", "payment_id", "not_null", 2),
        ("matched", "category", "not_null", 1),
        ("matched", "category", "accepted_values", 1),
        ("matched", "payment_id", "unique", 1),
    }
    with pytest.raises(quality.CheckFailed):
        checks.assert_checks({"matched": df})


def test_unique_ignores_null_and_accepted_lets_null_pass(spark):
    df = spark.createDataFrame([(None,), (None,), ("x",)], "c string")
    assert quality.repeated_keys(df, "c").count() == 0
    assert quality.unaccepted_values(df, "c", ["x"]).count() == 0
    assert rows(quality.null_counts(df, ["c"])) == {("c", 2)}


def test_settlement_math_counts_missing_amounts_as_wrong(spark):
    df = spark.createDataFrame(
        [("ok", 100, 2, 1, 97), ("off", 100, 2, 1, 98), ("gap", 100, None, 1, 97), ("none", None, 2, 1, None)],
        "utr string, gross_paise bigint, fee_paise bigint, tax_paise bigint, net_paise bigint",
    ).selectExpr("*", "utr as payment_id")
    assert rows(quality.settlement_math(df), "utr", "off_by_paise") == {("off", 1), ("gap", None), ("none", None)}


def test_one_merchant_per_payment(spark):
    df = spark.createDataFrame([("p", "A"), ("p", "B"), ("q", "A"), ("q", "A")], "payment_id string, merchant_id string")
    assert rows(quality.merchant_conflicts(df)) == {("p", "A", "B", 2)}


def test_compare_results_reports_only_what_moved(spark):
    schema = "day string, orders bigint, note string"
    before = spark.createDataFrame([("a", 1, "x"), ("b", 2, "x"), ("c", 3, None), (None, 5, "n")], schema)
    after = spark.createDataFrame([("a", 1, "x"), ("b", 5, "x"), ("d", 4, "y"), (None, 5, "n")], schema)
    found = compare.compare_results(before, after, ["day"], ["orders", "note"])
    assert rows(found, "day", "status", "orders_before", "orders_after", "orders_delta", "note_after") == {
        ("b", "changed", 2, 5, 3, "x"),
        ("c", "removed", 3, None, -3, None),
        ("d", "added", None, 4, 4, "y"),
    }


def test_compare_sees_a_change_to_null(spark):
    before = spark.createDataFrame([("a", 1)], "k string, n bigint")
    after = spark.createDataFrame([("a", None)], "k string, n bigint")
    assert compare.compare_results(before, after, ["k"], ["n"]).first().status == "changed"


def test_open_items_close_when_the_next_file_brings_them(ledger, settlement):
    def differences(ours, bank, cutoff, day):
        return classify_differences(match_figures(ours, bank), cutoff, day)

    first = differences(
        ledger(("late", "capture", 100, "19:00:00"), ("stuck", "capture", 40, "20:00:00"), ("lost", "capture", 9, "09:00:00")),
        settlement(),
        CUTOFF,
        DAY,
    )
    opened = carry.open_items(first, DAY)
    assert rows(opened, "payment_id") == {("late",), ("stuck",)}
    second = differences(
        ledger(), settlement(("U1", "late", 100, DAY, None), ("U2", "fresh", 7, DAY, None)), "2025-09-16 18:00:00", "2025-09-16"
    )
    carried = carry.carry_forward(opened, second, "2025-09-16")
    assert rows(carried, "payment_id", "status", "difference_paise") == {
        ("late", "closed", 0),
        ("stuck", "still_open", 40),
        ("fresh", "new", -7),
    }


def test_open_items_over_three_days(spark):
    kind = "payment_id string, merchant_id string, cause string, difference_paise bigint"

    def day(*entries):
        return spark.createDataFrame([(p, "M", cause, paise) for p, cause, paise in entries], kind)

    first = carry.open_items(day(("a", v.AFTER_CUTOFF, 10), ("b", v.AFTER_CUTOFF, 20), ("c", v.ROUNDING, 1)), "2025-09-15")
    second = carry.carry_forward(first, day(("a", v.PRIOR_DAY_CAPTURE, -10), ("d", v.AFTER_CUTOFF, 5)), "2025-09-16")
    third = carry.carry_forward(
        carry.still_open(second), day(("b", v.PRIOR_DAY_CAPTURE, -15), ("d", v.PRIOR_DAY_CAPTURE, -5)), "2025-09-17"
    )
    assert rows(second, "payment_id", "status", "difference_paise") == {("a", "closed", 0), ("b", "still_open", 20), ("d", "new", 5)}
    assert rows(third, "payment_id", "opened_on", "cause", "status", "difference_paise") == {
        ("b", date(2025, 9, 15), v.AFTER_CUTOFF, "changed", 5),
        ("d", date(2025, 9, 16), v.AFTER_CUTOFF, "closed", 0),
    }
    assert carry.still_open(third).columns == first.columns


def test_comparison_names_a_repeated_key(spark):
    df = spark.createDataFrame([("k", 1), ("k", 2)], "key string, n int")
    with pytest.raises(Exception, match="repeated key: k"):
        compare.compare_results(df, df, ["key"], ["n"]).collect()
