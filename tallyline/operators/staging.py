"""Staging: one projection per raw input, types and renames only."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyline.functions.money import rupees_to_paise
from tallyline.schemas import DAILY_ORDERS, SELLERS


def stage_order_lines(raw: DataFrame) -> DataFrame:
    qty = F.col("qty").cast("int")
    price = F.col("unit_price_paise").cast("bigint")
    return raw.select(
        "order_id",
        F.col("line_no").cast("int").alias("line_no"),
        F.col("order_ts").cast("timestamp_ntz").alias("order_ts"),
        F.col("order_ts").cast("date").alias("order_date"),
        F.nullif(F.col("customer_id"), F.lit("")).alias("customer_id"),
        "customer_name",
        "city",
        "sku",
        "product_name",
        "category",
        qty.alias("qty"),
        price.alias("unit_price_paise"),
        (qty * price).alias("line_total_paise"),
        F.col("delivery_fee_paise").cast("bigint").alias("delivery_fee_paise"),
    )


def stage_daily_orders(raw: DataFrame) -> DataFrame:
    """Rows as loaded; a repeated order id stays repeated."""
    return raw.select(*DAILY_ORDERS.names, "batch_day")


def stage_seller_orders(raw: DataFrame) -> DataFrame:
    return raw.select(
        "order_id",
        F.col("order_date").cast("date").alias("order_date"),
        "seller_id",
        "customer_id",
        "sku",
        F.col("amount_paise").cast("bigint").alias("amount_paise"),
        "status",
    )


def stage_sellers(raw: DataFrame) -> DataFrame:
    """One seller snapshot; the same projection serves every snapshot date."""
    text = [name for name in SELLERS.names if name != "snapshot_date"]
    return raw.select(*text, F.col("snapshot_date").cast("date").alias("snapshot_date"))


def stage_ledger(raw: DataFrame) -> DataFrame:
    return raw.select(
        "entry_id",
        "payment_id",
        "merchant_id",
        "entry_type",
        F.col("amount_paise").cast("bigint").alias("amount_paise"),
        "currency",
        F.col("entry_ts").cast("timestamp_ntz").alias("entry_ts"),
        "method",
    )


def stage_settlement(raw: DataFrame) -> DataFrame:
    return raw.select(
        "utr",
        "payment_id",
        "merchant_id",
        rupees_to_paise(F.col("gross_amount")).alias("gross_paise"),
        rupees_to_paise(F.col("fee")).alias("fee_paise"),
        rupees_to_paise(F.col("tax")).alias("tax_paise"),
        rupees_to_paise(F.col("net_amount")).alias("net_paise"),
        F.col("captured_on").cast("date").alias("captured_on"),
        F.col("settled_on").cast("date").alias("settled_on"),
        "remarks",
    )
