"""Basket star schema: dimensions, the line fact, the order fact and product affinity."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, functions as F

from tallyline.session import scratch_folder, written

# The member that stands for guest checkouts, which have no customer id.
GUEST = "GUEST"

# Products of a basket that one task pairs with as many others.
TILE = 512


def _customer_key():
    return F.coalesce("customer_id", F.lit(GUEST))


def dim_customer(lines: DataFrame) -> DataFrame:
    """One row per customer with the attributes of the latest order; one row for all guests."""
    known = F.col("customer_id").isNotNull()
    latest = F.max(F.when(known, F.struct("order_ts", "customer_name", "city")))
    return (
        lines.groupBy(_customer_key().alias("customer_key"))
        .agg(latest.alias("latest"))
        .select("customer_key", "latest.customer_name", "latest.city")
    )


def dim_product(lines: DataFrame) -> DataFrame:
    """One row per product under its most frequent spelling.

    Spellings are counted first, so a product on a third of all lines reaches the second step
    as a few counted rows. Equal counts go to the alphabetically last spelling.
    """
    spellings = lines.groupBy("sku", "product_name", "category").agg(
        F.count(F.lit(1)).alias("lines")
    )
    return (
        spellings.groupBy("sku")
        .agg(
            F.max(F.struct("lines", "product_name", "category")).alias("best"),
            F.count(F.lit(1)).alias("spellings"),
            F.sum("lines").alias("lines"),
        )
        .select("sku", "best.product_name", "best.category", "spellings", "lines")
    )


def dim_date(lines: DataFrame) -> DataFrame:
    """Every calendar day from the first to the last order."""
    span = lines.agg(F.min("order_date").alias("first"), F.max("order_date").alias("last"))
    day = F.col("order_date")
    return (
        span.where(F.col("first").isNotNull())
        .select(F.explode(F.sequence("first", "last")).alias("order_date"))
        .select(
            "order_date",
            F.year(day).alias("year"),
            F.quarter(day).alias("quarter"),
            F.month(day).alias("month"),
            F.dayofmonth(day).alias("day_of_month"),
            (F.weekday(day) + 1).alias("iso_weekday"),
            (F.weekday(day) >= 5).alias("is_weekend"),
        )
    )


def fct_order_lines(lines: DataFrame) -> DataFrame:
    """Line grain. The delivery fee belongs to the order and is left to the order fact."""
    return lines.select(
        "order_id",
        "line_no",
        "order_date",
        _customer_key().alias("customer_key"),
        "sku",
        "qty",
        "unit_price_paise",
        "line_total_paise",
    )


def fct_baskets(lines: DataFrame) -> DataFrame:
    """Order grain: goods summed over the lines, the fee that each line repeats taken once."""
    return (
        lines.groupBy("order_id")
        .agg(
            F.min("order_date").alias("order_date"),
            F.min(_customer_key()).alias("customer_key"),
            F.count(F.lit(1)).alias("basket_lines"),
            F.sum("qty").alias("units"),
            F.sum("line_total_paise").alias("goods_paise"),
            F.max("delivery_fee_paise").alias("delivery_fee_paise"),
        )
        .withColumn("total_paise", F.col("goods_paise") + F.col("delivery_fee_paise"))
    )


def basket_size_profile(lines: DataFrame) -> DataFrame:
    """How many baskets have how many lines, and the fee they carry."""
    return (
        fct_baskets(lines)
        .groupBy("basket_lines")
        .agg(
            F.count(F.lit(1)).alias("baskets"),
            F.sum("delivery_fee_paise").alias("delivery_fee_paise"),
        )
    )


def product_pairs(lines: DataFrame, item: str = "sku", min_support: Decimal | float | str = "0.01") -> DataFrame:
    """Products bought together: baskets, support, confidence both ways and lift, exactly.

    Lists every pair held by at least ``min_support`` of the baskets, taken as an exact decimal.
    Only products that reach that support alone can be in one. The distinct (order, product) rows
    that remain are stored once and joined with themselves per basket; a basket of more than
    ``TILE`` of them is cut into tiles of that many by as many, so that one huge basket is shared
    out over tasks. Pairs are counted before they are shuffled.
    """
    bought = lines.select("order_id", F.col(item).alias("item")).distinct()
    baskets = lines.agg(F.count_distinct("order_id")).scalar()
    least = F.lit(Decimal(str(min_support))) * baskets.cast("decimal(20,0)")
    counted = bought.where(F.col("item").isNotNull()).groupBy("item").agg(F.count(F.lit(1)).alias("n"))
    folder = scratch_folder(lines.sparkSession, "pairs")
    items = written(counted.where(F.col("n") >= least), f"{folder}/items")
    kept = written(bought.join(items.select("item"), "item"), f"{folder}/bought")
    sizes = kept.groupBy("order_id").agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("tiles"))
    placed = kept.join(sizes, "order_id").withColumn("own", F.pmod(F.xxhash64("item"), F.col("tiles")).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    first = placed.select("order_id", F.col("item").alias("item_a"), F.col("own").alias("row"), every.alias("column"))
    second = placed.select("order_id", F.col("item").alias("item_b"), F.col("own").alias("column"), every.alias("row"))
    together = (
        first.join(second, ["order_id", "row", "column"])
        .where(F.col("item_a") < F.col("item_b"))
        .groupBy("item_a", "item_b")
        .agg(F.count(F.lit(1)).alias("baskets_both"))
        .where(F.col("baskets_both") >= least)
    )
    total, both = baskets.cast("double"), F.col("baskets_both").cast("double")
    return (
        together.join(items.select(F.col("item").alias("item_a"), F.col("n").alias("baskets_a")), "item_a")
        .join(items.select(F.col("item").alias("item_b"), F.col("n").alias("baskets_b")), "item_b")
        .select(
            "item_a",
            "item_b",
            "baskets_both",
            "baskets_a",
            "baskets_b",
            F.round(both / total, 6).alias("support"),
            F.round(both / F.col("baskets_a"), 6).alias("confidence_a_to_b"),
            F.round(both / F.col("baskets_b"), 6).alias("confidence_b_to_a"),
            F.round(both * total / (F.col("baskets_a") * F.col("baskets_b")), 6).alias("lift"),
        )
    )
