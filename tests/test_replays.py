"""Chains of days, late exports, state per batch and digests: reruns and any order give the result of the right order."""

from __future__ import annotations

import itertools
import random
from datetime import date

import pytest
from helpers import rows
from test_dimensions import BEGIN, END, snapshot
from test_sources import GOOD_FACT, deliver, line, month  # noqa: F401

from tallyline.functions import values as v
from tallyline.operators import digests, sellers
from tallyline.operators.compare import compare_results
from tallyline.operators.orders import daily_orders
from tallyline.plans import open_items, reconcile
from tallyline.plans.sellers import add_snapshots, rebuild_history, seller_history
from tallyline.sources import daily_state, tables

DAYS = [f"2025-09-{n}" for n in range(15, 20)]


def differences(spark, *entries):
    """Entries as (payment, paise); positive ones wait for the bank, negative ones come from it."""
    data = [(p, "M1", v.AFTER_CUTOFF if paise > 0 else v.PRIOR_DAY_CAPTURE, paise) for p, paise in entries]
    return spark.createDataFrame(data, open_items.DIFFERENCE_TYPE)


def chain(spark, folder):
    return {day: rows(open_items.open_items_of(spark, str(folder), day), "payment_id", "status", "difference_paise", "opened_on") for day in DAYS}


FIVE = [[("p", 10), ("q", 5)], [("p", -10), ("r", 7)], [("q", -5)], [], [("r", -7)]]


def test_a_rerun_day_reaches_all_later_days(spark, tmp_path):
    for day, entries in zip(DAYS, FIVE, strict=True):
        open_items.close_day(spark, f"{tmp_path}/fresh", day, differences(spark, *entries))
        wrong = [("p", -4)] if day == DAYS[1] else entries
        open_items.close_day(spark, f"{tmp_path}/rerun", day, differences(spark, *wrong))
    assert chain(spark, f"{tmp_path}/rerun") != chain(spark, f"{tmp_path}/fresh")
    changed = open_items.close_day(spark, f"{tmp_path}/rerun", DAYS[1], differences(spark, *FIVE[1]))
    assert [str(d) for d in changed] == DAYS[1:]
    fresh = chain(spark, f"{tmp_path}/fresh")
    assert chain(spark, f"{tmp_path}/rerun") == fresh
    assert fresh[DAYS[3]] == {("r", "still_open", 7, date(2025, 9, 16))} and fresh[DAYS[4]] == {("r", "closed", 0, date(2025, 9, 16))}


def test_the_chain_ends_where_a_day_comes_out_as_it_was(spark, tmp_path, monkeypatch):
    for day, entries in zip(DAYS, FIVE, strict=True):
        open_items.close_day(spark, str(tmp_path), day, differences(spark, *entries))
    computed = []
    real = open_items.carry_forward
    monkeypatch.setattr(open_items, "carry_forward", lambda opened, today, day: computed.append(str(day)) or real(opened, today, day))
    assert [str(d) for d in open_items.close_day(spark, str(tmp_path), DAYS[1], differences(spark, *FIVE[1]))] == []
    assert computed == [DAYS[1]]
    assert open_items.replay(spark, str(tmp_path)) == [] and computed == [DAYS[1]]


def test_days_in_any_order(spark, tmp_path):
    for day, entries in zip(DAYS, FIVE, strict=True):
        open_items.close_day(spark, f"{tmp_path}/fresh", day, differences(spark, *entries))
    for n in (4, 2, 0, 3, 1):
        open_items.close_day(spark, f"{tmp_path}/mixed", DAYS[n], differences(spark, *FIVE[n]))
    assert chain(spark, f"{tmp_path}/mixed") == chain(spark, f"{tmp_path}/fresh")


@pytest.mark.parametrize("lost_at", [1])
def test_a_driver_lost_in_the_middle_of_the_chain(spark, tmp_path, monkeypatch, lost_at):
    for day, entries in zip(DAYS, FIVE, strict=True):
        open_items.close_day(spark, str(tmp_path), day, differences(spark, *([("p", -4)] if day == DAYS[1] else entries)))
    real, calls = open_items.replace_partition, itertools.count()

    def lost(df, table, *rest):
        if table.endswith("/open_items") and next(calls) == lost_at:
            raise RuntimeError("lost")
        return real(df, table, *rest)

    with monkeypatch.context() as m:
        m.setattr(open_items, "replace_partition", lost)
        with pytest.raises(RuntimeError):
            open_items.close_day(spark, str(tmp_path), DAYS[1], differences(spark, *FIVE[1]))
    open_items.replay(spark, str(tmp_path))
    found = chain(spark, tmp_path)
    for day, entries in zip(DAYS, FIVE, strict=True):
        open_items.close_day(spark, f"{tmp_path}/fresh", day, differences(spark, *entries))
    assert found == chain(spark, f"{tmp_path}/fresh")


def test_a_reconciled_day_run_again_updates_the_next_one(spark, ledger, settlement, tmp_path):
    cutoffs = {day: f"{day} 18:00:00" for day in DAYS}
    bank = settlement(("U1", "p", 10, DAYS[0], None))
    reconcile.reconcile_day(ledger(("p", "capture", 9, "19:00:00")), settlement(), cutoffs[DAYS[0]], DAYS[0], str(tmp_path))
    reconcile.reconcile_day(ledger(), bank, cutoffs[DAYS[1]], DAYS[1], str(tmp_path))
    assert {r[:3] for r in chain(spark, tmp_path)[DAYS[1]]} == {("p", "changed", -1)}
    reconcile.reconcile_day(ledger(("p", "capture", 10, "19:00:00")), settlement(), cutoffs[DAYS[0]], DAYS[0], str(tmp_path))
    assert {r[:3] for r in chain(spark, tmp_path)[DAYS[1]]} == {("p", "closed", 0)}


# Seller history


def exports(spark):
    return [
        snapshot(spark, "2025-06-01", ("s", "A", "Kids", "Pune"), ("t", "T", "Home", "Pune")),
        snapshot(spark, "2025-07-01", ("s", "A", "Toys", "Pune")),
        snapshot(spark, "2025-08-01", ("s", "B", "Kids", "Pune"), ("u", "U", None, "Pune")),
        snapshot(spark, "2025-09-01", ("s", "C", "Kids", "Pune"), ("t", "T2", "Home", "Agra"), ("u", "U", None, "Pune")),
    ]


def history(df):
    return rows(df, "seller_id", "seller_name", "category", "city", "valid_from", "valid_to", "is_current", "last_snapshot")


def test_stacked_exports_give_the_history_of_one_by_one(spark):
    snaps = exports(spark)
    expected = history(seller_history(snaps))
    for order in (snaps[::-1], [snaps[2], snaps[0], snaps[3], snaps[1]]):
        stacked = order[0].unionByName(order[1]).unionByName(order[2]).unionByName(order[3]).unionByName(order[1])
        assert history(sellers.history_of(stacked)) == expected


def test_a_late_export_splits_the_version_it_falls_into(spark, tmp_path):
    june, july, august, september = exports(spark)
    add_snapshots(spark, str(tmp_path), {"2025-06-01": june, "2025-09-01": september, "2025-08-01": august})
    before = rebuild_history(spark, str(tmp_path))
    assert rows(before.where("seller_id = 's'"), "category", "valid_from", "valid_to") == {("Kids", BEGIN, END)}
    add_snapshots(spark, str(tmp_path), {"2025-07-01": july})
    after = rebuild_history(spark, str(tmp_path))
    assert rows(after.where("seller_id = 's'"), "seller_name", "category", "valid_from", "valid_to") == {
        ("C", "Kids", BEGIN, date(2025, 7, 1)),
        ("C", "Toys", date(2025, 7, 1), date(2025, 8, 1)),
        ("C", "Kids", date(2025, 8, 1), END),
    }
    add_snapshots(spark, str(tmp_path), {"2025-07-01": july.limit(0)})  # withdrawn
    assert history(rebuild_history(spark, str(tmp_path))) == history(seller_history([june, august, september]))


def test_odd_export_rows(spark):
    odd = spark.createDataFrame(
        [(None, "A", "K", "P", "S", "G", "e", date(2025, 6, 1)), ("s", "A", "K", "P", "S", "G", "e", None),
         ("s", "A", "K", "P", "S", "G", "e", date(2025, 6, 1)), ("s", "B", None, "P", "S", "G", "e", date(2025, 6, 1))],
        exports(spark)[0].schema,
    )
    assert rows(sellers.history_of(odd), "seller_id", "seller_name", "valid_from") == {("s", "B", BEGIN)}
    assert sellers.history_of(odd.limit(0)).count() == 0


# The daily fact from state per batch


def test_state_gives_the_fact_of_the_rows_over_reruns(spark, month):  # noqa: F811
    files, table, fact = month
    daily_state.build_state(spark, table, fact)
    assert rows(tables.daily_fact(spark, fact)) == GOOD_FACT
    chance = random.Random(4)
    for _ in range(4):
        day = chance.choice(["2025-08-01", "2025-08-02", "2025-08-03"])
        held = [line(chance.choice("abcde"), f"2025-08-0{chance.randint(1, 3)}", chance.choice(["delivered", "cancelled"]), chance.randint(1, 9)) for _ in range(chance.randint(0, 6))]
        daily_state.backfill_from_state(spark, deliver(files, day, *held), day, table, fact, allow_empty=True)
        assert rows(tables.daily_fact(spark, fact)) == rows(daily_orders(tables.orders_table(spark, table)))


def test_a_refresh_reads_no_other_batch(spark, month):  # noqa: F811
    files, table, fact = month
    daily_state.build_state(spark, table, fact)
    for path in (files.parent / "orders" / "batch_day=2025-08-01").glob("*.parquet"):
        path.write_bytes(b"")  # unreadable from now on
    path = deliver(files, "2025-08-02", line("b", "2025-08-01"), line("a", "2025-08-01", paise=3))
    daily_state.backfill_from_state(spark, path, "2025-08-02", table, fact)
    assert rows(tables.daily_fact(spark, fact)) == {(date(2025, 8, 1), 3, 2, 203)}


def test_a_run_lost_before_the_state_is_replaced(spark, month, monkeypatch):  # noqa: F811
    files, table, fact = month
    daily_state.build_state(spark, table, fact)
    path = deliver(files, "2025-08-02", line("d", "2025-08-02"))

    def lost(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(daily_state, "replace_partition", lost)
        with pytest.raises(RuntimeError):
            daily_state.backfill_from_state(spark, path, "2025-08-02", table, fact)
    daily_state.backfill_from_state(spark, path, "2025-08-02", table, fact)
    assert rows(tables.daily_fact(spark, fact)) == {(date(2025, 8, 1), 1, 1, 100), (date(2025, 8, 2), 1, 1, 100)}


# Digests


def test_digests_see_order_never_and_differences_always(spark):
    df = spark.createDataFrame([(1, "a", None), (2, None, "a"), (2, None, "a")], "k int, x string, y string")
    same = digests.digest_of(df.orderBy("k", ascending=False).repartition(3))
    assert digests.digest_of(df) == same
    others = [df.distinct(), df.select("k", F_y(df), F_x(df)), df.where("k = 1"), df.limit(0), df.unionByName(df)]
    assert same not in [digests.digest_of(other) for other in others]
    pairs = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (2, "b")], "k int, x string")
    assert digests.digest_of(pairs.where("k = 1")) != digests.digest_of(pairs.where("k = 2"))


def F_x(df):
    return df["x"].alias("y")


def F_y(df):
    return df["y"].alias("x")


@pytest.mark.parametrize("buckets", [1, 7, 4096])
def test_comparison_by_digests_equals_the_full_join(spark, buckets):
    chance = random.Random(buckets)
    before = [(i, chance.choice(["a", None]), i % 7) for i in range(400)]
    after = [(k, x, n + (k % 50 == 0)) for k, x, n in before if k % 90] + [(1000, "new", 1), (None, "null key", 2)]
    old, new = (spark.createDataFrame(x, "k int, x string, n bigint") for x in (before, after))
    full = rows(compare_results(old, new, ["k"], ["x", "n"]))
    assert full and rows(digests.compare_by_digests(old, new, ["k"], ["x", "n"], buckets)) == full
    assert digests.compare_by_digests(old, old, ["k"], ["x", "n"], buckets).count() == 0
    assert digests.unequal_buckets(old, new, ["k"], ["x", "n"], 4096).count() < 30


def test_comparison_of_empty_results(spark):
    empty = spark.createDataFrame([], "k int, n bigint")
    one = spark.createDataFrame([(1, 2)], empty.schema)
    assert rows(digests.compare_by_digests(empty, one, ["k"], ["n"])) == {(1, "added", None, 2, 2)}
    assert digests.compare_by_digests(empty, empty, ["k"], ["n"]).count() == 0
