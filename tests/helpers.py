"""Schemas and small helpers that the tests share."""

from __future__ import annotations

LEDGER = (
    "entry_id string, payment_id string, merchant_id string, entry_type string, "
    "amount_paise bigint, currency string, entry_ts timestamp_ntz, method string"
)
SETTLEMENT = (
    "utr string, payment_id string, merchant_id string, gross_paise bigint, fee_paise bigint, "
    "tax_paise bigint, net_paise bigint, captured_on date, settled_on date, remarks string"
)


def rows(df, *columns):
    """Rows as a set of tuples."""
    return {tuple(r) for r in (df.select(*columns) if columns else df).collect()}
