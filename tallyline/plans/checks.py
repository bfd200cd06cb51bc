"""The generic column checks as data, and their run over a set of tables."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tallyline.functions.values import CATEGORIES, CAUSES
from tallyline.operators.quality import assert_empty


@dataclass(frozen=True)
class TableChecks:
    unique: list[str] = field(default_factory=list)
    not_null: list[str] = field(default_factory=list)
    accepted: dict[str, list[str]] = field(default_factory=dict)


# Which column of which table must be unique, filled, or from a closed set.
CHECKS = {
    "stg_order_lines": TableChecks(not_null=["order_id", "sku", "qty"]),
    "stg_daily_orders": TableChecks(not_null=["order_id", "order_date", "amount_paise"]),
    "daily_orders": TableChecks(["order_date"], ["order_date"]),
    "stg_sellers_prev": TableChecks(["seller_id"], ["seller_id"]),
    "stg_sellers_curr": TableChecks(["seller_id"], ["seller_id"]),
    "stg_seller_orders": TableChecks(["order_id"], ["order_id", "seller_id"]),
    "dim_sellers_current": TableChecks(["seller_id"], ["seller_id"]),
    "fct_orders_current": TableChecks(["order_id"], ["order_id", "seller_category"]),
    "stg_ledger": TableChecks(["entry_id"], ["entry_id", "payment_id"]),
    "stg_settlement": TableChecks(["utr"], ["utr", "payment_id"]),
    "ledger_by_payment": TableChecks(["payment_id"], ["payment_id"]),
    "settlement_by_payment": TableChecks(["payment_id"], ["payment_id"]),
    "matched": TableChecks(["payment_id"], ["payment_id", "category"], {"category": CATEGORIES}),
    "differences": TableChecks(["payment_id"], ["payment_id", "cause"], {"cause": CAUSES}),
}


def table_results(df: DataFrame, table: str, checks: TableChecks) -> DataFrame:
    """One row per check of a table with the number of failures, 0 for a pass, from one scan of the table.

    The values of all unique columns are stacked as text under their column's number and counted by one
    combining aggregate; the NULL and closed-set checks ride along with the first of them.
    """
    flags = [(c, "not_null", F.col(c).isNull()) for c in checks.not_null]
    flags += [(c, "accepted_values", F.coalesce(~F.col(c).isin(allowed), F.lit(False))) for c, allowed in checks.accepted.items()]
    sums = [f"f{i}" for i in range(len(flags))]
    values = [F.col(c).cast("string").alias(f"u{i}") for i, c in enumerate(checks.unique)]
    rows = df.select(*values, *[f.cast("bigint").alias(name) for name, (*_, f) in zip(sums, flags, strict=True)])
    results = [(c, kind, F.sum(name)) for name, (c, kind, _) in zip(sums, flags, strict=True)]
    if checks.unique:
        number, first = F.col("number"), F.col("number") == 0
        stacked = rows.select(F.posexplode(F.array(*[f"u{i}" for i in range(len(checks.unique))])).alias("number", "value"), *sums)
        rows = stacked.groupBy("number", "value").agg(
            F.count(F.lit(1)).alias("rows_"), *[F.sum(F.when(first, F.col(name))).alias(name) for name in sums]
        )
        repeated = F.col("value").isNotNull() & (F.col("rows_") > 1)
        results += [(c, "unique", F.count_if(repeated & (number == i))) for i, c in enumerate(checks.unique)]
    row = rows.agg(*[F.coalesce(found, F.lit(0)).cast("bigint").alias(f"c{i}") for i, (*_, found) in enumerate(results)])
    per_check = [
        F.struct(F.lit(c).alias("column_name"), F.lit(kind).alias("check_name"), F.col(f"c{i}").alias("failures"))
        for i, (c, kind, _) in enumerate(results)
    ]
    return row.select(F.lit(table).alias("table_name"), F.inline(F.array(*per_check)))


def run_checks(tables: dict[str, DataFrame]) -> DataFrame:
    """Results of every check that concerns one of the tables.

    Give it stored tables where they are costly to compute: each is read once.
    """
    return reduce(
        DataFrame.unionByName,
        [table_results(df, name, CHECKS[name]) for name, df in tables.items() if name in CHECKS],
    )


def assert_checks(tables: dict[str, DataFrame]) -> None:
    assert_empty(run_checks(tables).where(F.col("failures") > 0), "column check failed")
