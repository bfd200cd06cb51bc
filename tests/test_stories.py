"""Files in, checked tables and views out, for each story."""

from __future__ import annotations

import glob

import pytest
from helpers import rows

import jobs
from tallyline import fixtures as fx
from tallyline.catalog import QUERIES
from tallyline.sources.csv_files import write_csv

SMALL = "/root/testdata/sf0.001"


def same(spark, table, query):
    expected = QUERIES[query](spark, SMALL)
    assert rows(spark.table(table), *expected.columns) == rows(expected)


def run(spark, *arguments):
    jobs.run(spark, jobs.parsed([str(a) for a in arguments]))


def test_reconciliation(spark, tmp_path):
    write_csv(fx.raw_ledger(spark, SMALL), f"{tmp_path}/ledger.csv")
    write_csv(fx.raw_settlement(spark, SMALL), f"{tmp_path}/settlement.csv")
    query = "select category, payments from category_summary where category = 'matched'"
    run(
        spark, "reconcile", f"{tmp_path}/ledger.csv", f"{tmp_path}/settlement.csv", f"{tmp_path}/out",
        "--day", fx.DAY, "--cutoff", fx.CUTOFF, "--query", query, "--out", f"{tmp_path}/csv",
    )
    for table in ("ledger_by_payment", "settlement_by_payment", "matched", "differences", "reconciliation_report"):
        same(spark, table, table)
    (part,) = glob.glob(f"{tmp_path}/csv/part-*.csv")
    assert open(part).read() == "category,payments\nmatched,1299\n"

    for view in ("matched", "totals", "difference_report"):
        spark.catalog.dropTempView(view)
    query = "select count(*) as n from matched join totals where category = 'matched'"
    run(spark, "query", f"{tmp_path}/out", "--query", query, "--out", f"{tmp_path}/later")
    (part,) = glob.glob(f"{tmp_path}/later/part-*.csv")
    assert open(part).read() == "n\n1299\n"
    assert spark.table("difference_report").count() == spark.table("differences").count()
    run(spark, "check", f"{tmp_path}/out")


def test_sellers(spark, tmp_path):
    for name in ("PREV", "CURR"):
        write_csv(fx.raw_sellers(spark, SMALL, getattr(fx, f"{name}_SNAPSHOT")), f"{tmp_path}/{name}.csv")
    write_csv(fx.raw_seller_orders(spark, SMALL), f"{tmp_path}/orders.csv")
    run(spark, "sellers", *(f"{tmp_path}/{n}" for n in ("PREV.csv", "CURR.csv", "orders.csv", "out")))
    for table in ("dim_sellers_current", "dim_sellers_history", "fct_orders_current", "fct_orders_asof", "seller_changes"):
        same(spark, table, table)


def test_baskets(spark, tmp_path):
    write_csv(fx.raw_order_lines(spark, SMALL), f"{tmp_path}/lines.csv")
    run(spark, "baskets", f"{tmp_path}/lines.csv", f"{tmp_path}/out")
    for table in ("fct_order_lines", "fct_baskets", "dim_product", "dim_customer", "dim_date"):
        same(spark, table, table)


def test_orders_and_backfill(spark, tmp_path, capsys):
    raw = fx.raw_daily_orders(spark, SMALL)
    days = [r[0] for r in raw.select("batch_day").distinct().collect()][:3]
    for day in days:
        write_csv(raw.where(raw.batch_day == day).drop("batch_day"), f"{tmp_path}/files/orders_{day}.csv")
    run(spark, "orders", f"{tmp_path}/files", f"{tmp_path}/out")
    before = rows(spark.table("daily_orders"))
    spark.catalog.dropTempView("daily_orders")
    run(
        spark, "backfill", f"{tmp_path}/files/orders_{days[0]}.csv", f"{tmp_path}/out", "--day", days[0],
        "--query", "select sum(order_rows) as n from daily_orders", "--out", f"{tmp_path}/csv",
    )
    held = raw.where(raw.batch_day == days[0]).count()
    assert f"{held} rows read, {held} rows held" in capsys.readouterr().out
    spark.catalog.refreshTable("daily_orders")
    assert rows(spark.table("daily_orders")) == before


def test_arguments_are_checked():
    for wrong in (["backfill", "file", "folder"], ["query", "folder"], ["baskets", "lines", "folder", "--query", "select 1"]):
        with pytest.raises(SystemExit):
            jobs.parsed(wrong)
