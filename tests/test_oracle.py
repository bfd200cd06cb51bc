"""Every catalog query against its SQL, and the recorded figures."""

from __future__ import annotations

import pytest
from helpers import rows
from oracle_compare import connect, difference

import __spark_entry__ as entry_module
from oracle.sql import ORACLE
from tallyline import fixtures as fx
from tallyline.catalog import QUERIES

SMALL = "/root/testdata/sf0.001"
MIDDLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_module.queries())
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    assert difference(QUERIES[name](spark, SMALL), duck, ORACLE[name]) is None


def test_entry_reports_six_causes_and_a_total(spark):
    assert entry_module.entry(spark).count() == 7


def test_recorded_reconciliation_figures(spark):
    report = QUERIES["reconciliation_report"](spark, MIDDLE)
    assert rows(report, "cause", "payments", "difference_paise") == {
        ("timing_captured_after_cutoff", 900, 22743559630),
        ("missing_never_settled", 60, 1276715980),
        ("timing_prior_day_capture", 750, -18502914433),
        ("settled_twice", 60, -1478795566),
        ("refund_after_cutoff", 120, -2279121869),
        ("rounding", 120, 0),
        ("TOTAL (should equal the setup-ticket gap)", 2010, 1759443742),
    }
    matched = QUERIES["category_summary"](spark, MIDDLE).where("category = 'matched'")
    assert rows(matched, "payments", "difference_paise") == {(12990, 0)}


def test_recorded_order_figures(spark):
    daily = QUERIES["daily_orders"](spark, MIDDLE)
    assert daily.selectExpr("sum(order_rows)", "count(*)", "sum(delivered_revenue_paise)").first()[:] == (10000, 30, 39635044)
    staged = QUERIES["stg_daily_orders"](spark, MIDDLE)
    assert staged.where("batch_day <> order_date").count() == 108


def test_recorded_seller_and_basket_figures(spark):
    now = QUERIES["fct_orders_current"](spark, MIDDLE).alias("now")
    then = QUERIES["fct_orders_asof"](spark, MIDDLE).alias("then")
    early = f"now.order_date < date '{fx.CURR_SNAPSHOT}'"
    moved = now.join(then, "order_id").where(f"{early} and now.seller_category <> then.seller_category")
    assert moved.selectExpr("count(*)", "sum(now.amount_paise)").first()[:] == (791, 20005860906)
    assert now.where(early).count() == 7719
    fact = QUERIES["fct_baskets"](spark, MIDDLE)
    assert fact.selectExpr("count(*)", "max(basket_lines)", "sum(delivery_fee_paise)").first()[:] == (14743, 13, 21714000)
    per_line = QUERIES["stg_order_lines"](spark, MIDDLE).selectExpr("count(*)", "sum(delivery_fee_paise)")
    assert per_line.first()[:] == (60000, 49850500)
