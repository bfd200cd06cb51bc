"""Before/after comparison of two results."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import NumericType


def _once(side: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """One row per key, or an error that names the repeated key."""
    key = F.concat_ws(", ", *[F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in keys])
    failure = F.raise_error(F.concat(F.lit("repeated key: "), key)).cast("bigint")
    rows = F.count(F.lit(1))
    # The error takes the place of a count, so that the plan cannot drop it unevaluated.
    grouped = side.groupBy(*keys).agg(rows.alias("__rows"), *[F.any_value(v).alias(v) for v in values])
    return grouped.where(F.when(F.col("__rows") > 1, failure).otherwise(F.col("__rows")) == 1).drop("__rows")


def compare_results(
    before: DataFrame, after: DataFrame, keys: list[str], values: list[str]
) -> DataFrame:
    """Rows that were added, removed or changed, with a delta per numeric column.

    NULL keys meet each other. A key that either side repeats stops the query when it runs: its
    rows would meet each other in every combination.
    """
    before, after = (_once(side, keys, values) for side in (before, after))
    old = before.select(*keys, *values, F.lit(True).alias("present")).alias("old")
    new = after.select(*keys, *values, F.lit(True).alias("present")).alias("new")
    same_key = reduce(
        lambda a, b: a & b, [F.col(f"old.{k}").eqNullSafe(F.col(f"new.{k}")) for k in keys]
    )
    same_values = reduce(
        lambda a, b: a & b, [F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}")) for c in values]
    )
    status = (
        F.when(F.col("old.present").isNull(), "added")
        .when(F.col("new.present").isNull(), "removed")
        .when(~same_values, "changed")
    )
    columns = []
    for name in values:
        columns += [F.col(f"old.{name}").alias(f"{name}_before"), F.col(f"new.{name}").alias(f"{name}_after")]
        if isinstance(before.schema[name].dataType, NumericType):
            delta = F.coalesce(f"new.{name}", F.lit(0)) - F.coalesce(f"old.{name}", F.lit(0))
            columns.append(delta.alias(f"{name}_delta"))
    return (
        old.join(new, same_key, "full")
        .select(
            *(F.coalesce(f"old.{k}", f"new.{k}").alias(k) for k in keys),
            status.alias("status"),
            *columns,
        )
        .where(F.col("status").isNotNull())
    )
