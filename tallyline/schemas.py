"""Declared column types of the delivered files. Nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T

TEXT = T.StringType()
INT = T.IntegerType()
LONG = T.LongType()
TIME = T.TimestampNTZType()
DATE = T.DateType()
# Rupees with two decimals, as the bank writes them; exact, never a double.
RUPEES = T.DecimalType(18, 2)


def _columns(**types: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in types.items()])


ORDER_LINES = _columns(
    order_id=TEXT,
    line_no=INT,
    order_ts=TIME,
    customer_id=TEXT,
    customer_name=TEXT,
    city=TEXT,
    sku=TEXT,
    product_name=TEXT,
    category=TEXT,
    qty=INT,
    unit_price_paise=LONG,
    delivery_fee_paise=LONG,
)

DAILY_ORDERS = _columns(
    order_id=TEXT,
    customer_id=TEXT,
    restaurant_id=TEXT,
    city=TEXT,
    order_ts=TIME,
    order_date=DATE,
    status=TEXT,
    amount_paise=LONG,
    delivery_fee_paise=LONG,
)

SELLERS = _columns(
    seller_id=TEXT,
    seller_name=TEXT,
    category=TEXT,
    city=TEXT,
    state=TEXT,
    gstin=TEXT,
    contact_email=TEXT,
    snapshot_date=DATE,
)

SELLER_ORDERS = _columns(
    order_id=TEXT,
    order_date=DATE,
    seller_id=TEXT,
    customer_id=TEXT,
    sku=TEXT,
    amount_paise=LONG,
    status=TEXT,
)

LEDGER = _columns(
    entry_id=TEXT,
    payment_id=TEXT,
    merchant_id=TEXT,
    entry_type=TEXT,
    amount_paise=LONG,
    currency=TEXT,
    entry_ts=TIME,
    method=TEXT,
)

SETTLEMENT = _columns(
    utr=TEXT,
    payment_id=TEXT,
    merchant_id=TEXT,
    gross_amount=RUPEES,
    fee=RUPEES,
    tax=RUPEES,
    net_amount=RUPEES,
    captured_on=DATE,
    settled_on=DATE,
    remarks=TEXT,
)
