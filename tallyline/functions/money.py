"""Money is integer paise everywhere after staging."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def rupees_to_paise(rupees: Column) -> Column:
    """Rupees to whole paise.

    Exact on decimals. The rounding matters only if the amount arrives as a double, where
    19.99 * 100 is just below 1999 and a bare cast would lose a paisa.
    """
    return F.round(rupees * 100).cast("bigint")


def amount_or_zero(amount: Column) -> Column:
    return F.coalesce(amount, F.lit(0).cast("bigint"))
