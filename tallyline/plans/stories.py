"""The four stories end to end: delivered files to checked tables and named views.

Each function loads its files, stores its tables below ``folder``, stops on a failed check and
registers every table as a view of the session, so that SQL can be run over the results.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from tallyline import schemas
from tallyline.operators import baskets, reports, sellers, staging
from tallyline.plans.checks import assert_checks
from tallyline.plans.reconcile import reconcile_day
from tallyline.plans.sellers import seller_history
from tallyline.session import written
from tallyline.sources import tables as load


def register_views(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return tables


# The tables that the stories store, and the views of analyses over them.
STORED = [
    "ledger_by_payment", "settlement_by_payment", "matched", "differences", "category_summary", "reconciliation_report", "open_items",
    "orders", "daily_orders", "dim_sellers_current", "dim_sellers_history", "fct_orders_current", "fct_orders_asof", "seller_changes",
    "fct_order_lines", "fct_baskets", "dim_product", "dim_customer", "dim_date",
]
RAW = {
    "ledger": ("stg_ledger", schemas.LEDGER, staging.stage_ledger),
    "settlement": ("stg_settlement", schemas.SETTLEMENT, staging.stage_settlement),
    "order_lines": ("stg_order_lines", schemas.ORDER_LINES, staging.stage_order_lines),
    "sellers_prev": ("stg_sellers_prev", schemas.SELLERS, staging.stage_sellers),
    "sellers_curr": ("stg_sellers_curr", schemas.SELLERS, staging.stage_sellers),
    "seller_orders": ("stg_seller_orders", schemas.SELLER_ORDERS, staging.stage_seller_orders),
}


def register_stored(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The tables that earlier builds left in ``folder``, as views; those of the reconciliation hold
    all business days. Where both sides' staged rows or the match are there, so are the analyses."""

    def table(path: str) -> DataFrame | None:
        try:
            return spark.read.parquet(path)
        except AnalysisException:  # not stored here
            return None

    tables = {name: found for name in STORED if (found := table(f"{folder}/{name}")) is not None}
    if "orders" in tables:
        tables["stg_daily_orders"] = staging.stage_daily_orders(load.orders_table(spark, f"{folder}/orders"))
        del tables["orders"]
    if "daily_orders" in tables:
        tables["daily_orders"] = load.daily_fact(spark, f"{folder}/daily_orders")
    for name, (staged, schema, stage) in RAW.items():
        if (table(f"{folder}/raw/{name}")) is not None:
            tables[staged] = stage(spark.read.schema(schema).parquet(f"{folder}/raw/{name}"))
        elif (table(f"{folder}/*/raw/{name}")) is not None:  # one folder per business day
            tables[staged] = stage(spark.read.schema(schema).parquet(f"{folder}/*/raw/{name}"))
    if "stg_ledger" in tables and "stg_settlement" in tables:
        sides = tables["stg_ledger"], tables["stg_settlement"]
        tables |= {"totals": reports.totals(*sides), "key_uniqueness": reports.key_uniqueness(*sides), "key_duplicates": reports.key_duplicates(*sides)}
    if "matched" in tables:
        tables["unmatched_sample"] = reports.unmatched_sample(tables["matched"])
    if "differences" in tables:
        tables["difference_report"] = reports.difference_report(tables["differences"])
    return register_views(tables)


def _loaded(spark: SparkSession, files: dict, folder: str) -> dict[str, DataFrame]:
    load.load_whole(spark, files, f"{folder}/raw")
    return {n: spark.read.schema(s).parquet(f"{folder}/raw/{n}") for n, (_, s) in files.items()}


def _stored(marts: dict[str, DataFrame], folder: str) -> dict[str, DataFrame]:
    return {name: written(df, f"{folder}/{name}") for name, df in marts.items()}


def build_reconciliation(
    spark: SparkSession, ledger_csv: str, settlement_csv: str, cutoff: datetime | str, day: date | str, folder: str
) -> dict[str, DataFrame]:
    files = {
        "ledger": (ledger_csv, schemas.LEDGER),
        "settlement": (settlement_csv, schemas.SETTLEMENT),
    }
    raw = _loaded(spark, files, f"{folder}/{day}")
    ledger, settlement = staging.stage_ledger(raw["ledger"]), staging.stage_settlement(raw["settlement"])
    return register_views(reconcile_day(ledger, settlement, cutoff, day, folder))


def build_daily_orders(spark: SparkSession, paths: str, folder: str) -> dict[str, DataFrame]:
    table, fact = f"{folder}/orders", f"{folder}/daily_orders"
    load.load_all_days(spark, paths, table)
    staged = staging.stage_daily_orders(load.orders_table(spark, table))
    assert_checks({"stg_daily_orders": staged})
    load.rebuild_daily_fact(spark, table, fact)
    tables = {"stg_daily_orders": staged, "daily_orders": load.daily_fact(spark, fact)}
    assert_checks({"daily_orders": tables["daily_orders"]})
    return register_views(tables)


def build_sellers(
    spark: SparkSession, earlier_csv: str, later_csv: str, orders_csv: str, folder: str
) -> dict[str, DataFrame]:
    files = {
        "sellers_prev": (earlier_csv, schemas.SELLERS),
        "sellers_curr": (later_csv, schemas.SELLERS),
        "seller_orders": (orders_csv, schemas.SELLER_ORDERS),
    }
    raw = _loaded(spark, files, folder)
    earlier, later = staging.stage_sellers(raw["sellers_prev"]), staging.stage_sellers(raw["sellers_curr"])
    orders = staging.stage_seller_orders(raw["seller_orders"])
    tables = {"stg_sellers_prev": earlier, "stg_sellers_curr": later, "stg_seller_orders": orders}
    assert_checks(tables)
    dimensions = _stored(
        {
            "dim_sellers_current": sellers.current_sellers(later),
            "dim_sellers_history": seller_history([earlier, later]),
        },
        folder,
    )
    facts = _stored(
        {
            "fct_orders_current": sellers.orders_with_current_seller(orders, dimensions["dim_sellers_current"]),
            "fct_orders_asof": sellers.orders_as_of(orders, dimensions["dim_sellers_history"]),
            "seller_changes": sellers.seller_changes(earlier, later),
        },
        folder,
    )
    assert_checks(dimensions | facts)
    return register_views(tables | dimensions | facts)


def build_baskets(spark: SparkSession, lines_csv: str, folder: str) -> dict[str, DataFrame]:
    raw = _loaded(spark, {"order_lines": (lines_csv, schemas.ORDER_LINES)}, folder)
    lines = staging.stage_order_lines(raw["order_lines"])
    assert_checks({"stg_order_lines": lines})
    star = {
        "fct_order_lines": baskets.fct_order_lines(lines),
        "fct_baskets": baskets.fct_baskets(lines),
        "dim_product": baskets.dim_product(lines),
        "dim_customer": baskets.dim_customer(lines),
        "dim_date": baskets.dim_date(lines),
    }
    return register_views({"stg_order_lines": lines} | _stored(star, folder))
