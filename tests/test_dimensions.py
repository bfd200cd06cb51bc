from __future__ import annotations

from datetime import date, datetime

import pytest
from helpers import rows
from pyspark.sql import functions as F

from tallyline.operators import baskets, orders, sellers
from tallyline.operators.staging import stage_order_lines
from tallyline.plans.sellers import seller_history
from tallyline.schemas import ORDER_LINES, SELLER_ORDERS, SELLERS

BEGIN, END = sellers.BEGINNING, sellers.END_OF_TIME


def snapshot(spark, day, *entries):
    """Entries as (seller, name, category, city)."""
    data = [(s, name, cat, city, "ST", "G", "e@x", date.fromisoformat(day)) for s, name, cat, city in entries]
    return spark.createDataFrame(data, SELLERS)


def order_rows(spark, *entries):
    data = [(f"o{i}", date.fromisoformat(day), s, "U", "K", 100, "delivered") for i, (s, day) in enumerate(entries)]
    return spark.createDataFrame(data, SELLER_ORDERS)


def versions(df):
    return rows(df, "seller_id", "seller_name", "category", "valid_from", "valid_to", "is_current")


def test_history_opens_versions_for_moves_and_overwrites_corrections(spark):
    june = snapshot(spark, "2025-06-01", ("moved", "A", "Kids", "Pune"), ("typo", "Bb", "Home", "Pune"), ("gone", "C", "Home", "Pune"))
    sept = snapshot(spark, "2025-09-01", ("moved", "A2", "Beauty", "Pune"), ("typo", "B", "Home", "Pune"), ("new", "D", "Home", "Pune"))
    dim = seller_history([june, sept])
    change = date(2025, 9, 1)
    assert versions(dim) == {
        ("moved", "A2", "Kids", BEGIN, change, False),
        ("moved", "A2", "Beauty", change, END, True),
        ("typo", "B", "Home", BEGIN, END, True),
        ("gone", "C", "Home", BEGIN, END, True),
        ("new", "D", "Home", BEGIN, END, True),
    }
    assert versions(sellers.apply_snapshot(dim, sept)) == versions(dim)


def test_history_over_three_snapshots_and_null_attributes(spark):
    snaps = [snapshot(spark, f"2025-0{m}-01", ("s", "N", cat, "Pune")) for m, cat in ((6, "Kids"), (7, None), (8, "Kids"))]
    assert rows(seller_history(snaps), "category", "valid_from", "valid_to", "is_current") == {
        ("Kids", BEGIN, date(2025, 7, 1), False),
        (None, date(2025, 7, 1), date(2025, 8, 1), False),
        ("Kids", date(2025, 8, 1), END, True),
    }


def test_an_older_snapshot_again_or_late_changes_nothing(spark):
    june = snapshot(spark, "2025-06-01", ("S1", "Old name", "Grocery", "Pune"))
    sept = snapshot(spark, "2025-09-01", ("S1", "New name", "Fashion", "Pune"))
    both = seller_history([june, sept])
    assert versions(seller_history([june, sept, june])) == versions(both) == versions(seller_history([june, sept, sept]))
    assert rows(both.where("is_current"), "seller_name", "category") == {("New name", "Fashion")}


def test_what_counts_as_history_is_an_argument(spark):
    june = snapshot(spark, "2025-06-01", ("s", "A", "Kids", "Pune"))
    sept = snapshot(spark, "2025-09-01", ("s", "B", "Home", "Pune"))
    dim = seller_history([june, sept], ("seller_name",))
    assert rows(dim, "seller_name", "category") == {("A", "Home"), ("B", "Home")}


def test_orders_find_exactly_one_version(spark):
    june = snapshot(spark, "2025-06-01", ("s", "A", "Kids", "Pune"))
    sept = snapshot(spark, "2025-09-01", ("s", "A", "Home", "Pune"))
    placed = order_rows(spark, ("s", "2025-01-01"), ("s", "2025-08-31"), ("s", "2025-09-01"), ("unknown", "2025-09-01"))
    asof = sellers.orders_as_of(placed, seller_history([june, sept]))
    assert rows(asof, "order_id", "seller_category") == {("o0", "Kids"), ("o1", "Kids"), ("o2", "Home"), ("o3", None)}
    current = sellers.orders_with_current_seller(placed, sellers.current_sellers(sept))
    assert rows(current, "order_id", "seller_category") == {("o0", "Home"), ("o1", "Home"), ("o2", "Home"), ("o3", None)}


def test_changes_per_attribute(spark):
    june = snapshot(spark, "2025-06-01", ("s", "A", "Kids", "Pune"), ("same", "A", "Kids", "Pune"), ("gone", "A", "K", "P"))
    sept = snapshot(spark, "2025-09-01", ("s", "A", "Home", None), ("same", "A", "Kids", "Pune"), ("new", "A", "K", "P"))
    assert rows(sellers.seller_changes(june, sept)) == {
        ("s", "changed", "category", "Kids", "Home"),
        ("s", "changed", "city", "Pune", None),
        ("gone", "removed", None, None, None),
        ("new", "added", None, None, None),
    }


def daily(spark, *entries):
    """Entries as (order, order date, status, paise, batch day)."""
    return spark.createDataFrame(
        [(o, date.fromisoformat(d), s, p, date.fromisoformat(b)) for o, d, s, p, b in entries],
        "order_id string, order_date date, status string, amount_paise bigint, batch_day date",
    )


def test_daily_fact_groups_by_order_date_and_has_no_revenue_without_delivery(spark):
    staged = daily(
        spark,
        ("a", "2025-08-01", "delivered", 5, "2025-08-01"),
        ("b", "2025-08-01", "delivered", 7, "2025-08-02"),
        ("b", "2025-08-01", "delivered", 7, "2025-08-02"),
        ("c", "2025-08-02", "cancelled", 9, "2025-08-02"),
    )
    assert [tuple(r) for r in orders.daily_orders(staged).collect()] == [
        (date(2025, 8, 1), 3, 2, 19),
        (date(2025, 8, 2), 1, 1, None),
    ]


def test_dedup_keeps_the_latest_batch_and_rows_without_an_id(spark):
    staged = daily(
        spark,
        ("a", "2025-08-01", "delivered", 5, "2025-08-01"),
        ("a", "2025-08-01", "cancelled", 5, "2025-08-03"),
        (None, "2025-08-01", "delivered", 1, "2025-08-01"),
        (None, "2025-08-01", "delivered", 1, "2025-08-01"),
    )
    kept = orders.dedup_orders(staged)
    assert kept.count() == 3 and kept.columns == staged.columns
    assert rows(kept.where("order_id = 'a'"), "status") == {("cancelled",)}
    assert rows(orders.duplicate_orders(staged)) == {("a", 2, date(2025, 8, 1), date(2025, 8, 3))}


def lines(spark, *entries):
    """Entries as (order, line, customer, sku, product name, qty, price, fee)."""
    return stage_order_lines(
        spark.createDataFrame(
            [
                (o, n, datetime(2025, 3, 1, 10), c, f"Name {c}", "Pune", sku, name, "Cat", qty, price, fee)
                for o, n, c, sku, name, qty, price, fee in entries
            ],
            ORDER_LINES,
        )
    )


def basket_lines(spark):
    return lines(
        spark,
        ("o1", 1, "C1", "S1", "Bread", 1, 100, 25),
        ("o1", 2, "C1", "S2", "MILK", 2, 50, 25),
        ("o1", 3, "C1", "S1", "Bread", 1, 100, 25),
        ("o2", 1, "", "S1", "bread", 1, 100, 35),
        ("o2", 2, "", "S2", "Milk", 1, 50, 35),
        ("o3", 1, "", "S2", "Milk", 1, 50, 35),
        ("o4", 1, "C1", "S3", "Eggs", 1, 10, 0),
    )


def test_fee_is_counted_once_per_basket(spark):
    fact = baskets.fct_baskets(basket_lines(spark))
    assert rows(fact, "order_id", "basket_lines", "units", "goods_paise", "delivery_fee_paise", "total_paise") == {
        ("o1", 3, 4, 300, 25, 325),
        ("o2", 2, 2, 150, 35, 185),
        ("o3", 1, 1, 50, 35, 85),
        ("o4", 1, 1, 10, 0, 10),
    }
    assert "delivery_fee_paise" not in baskets.fct_order_lines(basket_lines(spark)).columns
    assert rows(baskets.basket_size_profile(basket_lines(spark))) == {(3, 1, 25), (2, 1, 35), (1, 2, 35)}


def test_basket_dimensions(spark):
    staged = basket_lines(spark)
    assert rows(baskets.dim_product(staged), "sku", "product_name", "spellings", "lines") == {
        ("S1", "Bread", 2, 3),
        ("S2", "Milk", 2, 3),
        ("S3", "Eggs", 1, 1),
    }
    assert rows(baskets.dim_customer(staged)) == {("C1", "Name C1", "Pune"), (baskets.GUEST, None, None)}
    days = staged.withColumn("order_date", F.when(F.col("order_id") == "o1", F.lit("2025-02-27").cast("date")).otherwise(F.col("order_date")))
    assert rows(baskets.dim_date(days), "order_date", "iso_weekday", "is_weekend") == {
        (date(2025, 2, 27), 4, False),
        (date(2025, 2, 28), 5, False),
        (date(2025, 3, 1), 6, True),
    }
    assert baskets.dim_date(staged.limit(0)).count() == 0


def test_product_pairs_against_counting_by_hand(spark):
    found = baskets.product_pairs(basket_lines(spark), "sku", 0.5)
    assert rows(found) == {("S1", "S2", 2, 2, 3, 0.5, 1.0, 0.666667, 1.333333)}


def test_pairs_with_one_basket_holding_most_lines(spark):
    wide = [("big", i, "C", f"S{i % 500}", "x", 1, 1, 0) for i in range(2000)]
    small = [(f"o{i}", j, "C", f"S{j}", "x", 1, 1, 0) for i in range(9) for j in (1, 2)]
    found = baskets.product_pairs(lines(spark, *wide, *small), "sku", 0.3)
    assert rows(found, "item_a", "item_b", "baskets_both", "support") == {("S1", "S2", 10, 1.0)}


def test_pairs_exactly_at_the_support(spark):
    together = [(f"o{i}", j, "C", f"S{j}", "x", 1, 1, 0) for i in range(7) for j in (1, 2)]
    others = [(f"p{i}", 1, "C", "S3", "x", 1, 1, 0) for i in range(93)]
    found = baskets.product_pairs(lines(spark, *together, *others), "sku", 0.07)
    assert rows(found, "item_a", "item_b", "baskets_both") == {("S1", "S2", 7)}
    assert baskets.product_pairs(lines(spark, *together, *others), "sku", "0.0701").count() == 0


def test_pairs_of_a_basket_of_every_product_of_a_large_catalogue(spark):
    many = 2300
    wide = [(f"big{n}", i, "C", f"S{i}", "x", 1, 1, 0) for n in range(2) for i in range(many)]
    few = [("small", i, "C", f"S{i}", "x", 1, 1, 0) for i in (7, 9)]
    staged = lines(spark, *wide, *few)
    assert baskets.product_pairs(staged, "sku", "0.5").count() == many * (many - 1) // 2
    assert rows(baskets.product_pairs(staged, "sku", 1), "item_a", "item_b", "baskets_both") == {("S7", "S9", 3)}
