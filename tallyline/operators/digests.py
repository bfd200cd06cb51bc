"""Digests of sets of rows that don't depend on their order or partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyline.operators.compare import compare_results

SEEDS = (0, 1)  # two independent 64-bit hashes


def row_hash(columns: list[str], seed: int) -> Column:
    """A hash of a row that tells nulls from values and from nulls elsewhere."""
    parts = [part for name in columns for part in (F.col(name), F.col(name).isNull())]
    return F.xxhash64(F.lit(seed), *parts)


def digest_columns(columns: list[str]) -> list[Column]:
    """Aggregates that agree on two groups of rows if these hold the same rows equally often.

    Sums of hashes as decimals: exact, combined before the shuffle, and unlike an exclusive or
    they see that a row is there twice. Rows that differ go unseen with a probability of about 2^-128.
    """
    sums = [F.sum(row_hash(columns, seed).cast("decimal(20,0)")).alias(f"digest_{seed}") for seed in SEEDS]
    return [F.count(F.lit(1)).alias("rows_"), *sums]


def digest_of(df: DataFrame, columns: list[str] | None = None) -> tuple:
    """The digest of all rows, on the driver: one row."""
    columns = sorted(columns or df.columns)
    return tuple(df.agg(*digest_columns(columns)).first())


def bucket_of(keys: list[str], buckets: int) -> Column:
    return F.pmod(row_hash(keys, 2), F.lit(buckets)).cast("int")


def bucket_digests(df: DataFrame, keys: list[str], columns: list[str], buckets: int) -> DataFrame:
    """One row per bucket of keys that occurs: its digest over keys and columns."""
    return df.groupBy(bucket_of(keys, buckets).alias("bucket")).agg(*digest_columns(sorted([*keys, *columns])))


def unequal_buckets(before: DataFrame, after: DataFrame, keys: list[str], columns: list[str], buckets: int) -> DataFrame:
    """The buckets whose rows differ between two results, or that only one of them has."""
    sides = [bucket_digests(df, keys, columns, buckets).withColumn("side", F.lit(i)) for i, df in enumerate((before, after))]
    same = [F.count_distinct(name) == 1 for name in ("rows_", *(f"digest_{seed}" for seed in SEEDS))]
    equal = (F.count(F.lit(1)) == 2) & same[0] & same[1] & same[2]
    return sides[0].unionByName(sides[1]).groupBy("bucket").agg(equal.alias("equal")).where(~F.col("equal")).select("bucket")


def compare_by_digests(before: DataFrame, after: DataFrame, keys: list[str], figures: list[str], buckets: int = 4096) -> DataFrame:
    """What ``compare_results`` returns, at the cost of a join of the unequal buckets only.

    Both results are read once for their digests, of which ``buckets`` rows per task are shuffled,
    and once more for the rows of unequal buckets; equal results shuffle nothing else. A key
    that repeats within a result is an error where its bucket differs. Ids of buckets are at most
    ``buckets`` integers, which is what bounds the list that goes to the tasks.
    """
    differing = [row["bucket"] for row in unequal_buckets(before, after, keys, figures, buckets).collect()]
    wanted = bucket_of(keys, buckets).isin(differing)
    columns = [*keys, *figures]
    return compare_results(*(df.select(*columns).where(wanted) for df in (before, after)), keys, figures)
