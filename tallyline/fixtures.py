"""Inputs of the five delivered-file schemas, projected from the general test tables.

Row-wise projections and key joins only; every category and cause occurs at every scale.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


DAY = "2025-09-15"
PRIOR_DAY = "2025-09-14"
NEXT_DAY = "2025-09-16"
CUTOFF = "2025-09-15 18:00:00"
NEXT_CUTOFF = "2025-09-16 18:00:00"
PREV_SNAPSHOT = "1998-01-01"
CURR_SNAPSHOT = "1998-06-01"
LATE_SNAPSHOT = "1998-07-15"
NEXT_SNAPSHOT = "1998-09-01"
RERUN_DAY = "2024-01-10"


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table. Its schema is read from the footer once per path, not once per query."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def _paise(amount: str) -> Column:
    return F.expr(f"cast(round({amount} * 100) as bigint)")


def _payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey as k",
        "o_orderkey % 500 as b",
        "cast(round(o_totalprice * 100) as bigint) as amt",
        "concat('pay_', lpad(cast(o_orderkey as string), 12, '0')) as payment_id",
        "concat('M', cast(o_custkey as string)) as merchant_id",
        "cast(round(o_totalprice * 100) as bigint) div if(o_orderkey % 2 = 0, 1, 2) as ref",
    )


def raw_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Capture entries, and a refund entry for the refunded payments."""
    day = f"timestamp_ntz'{DAY} 00:00:00'"
    captured_at = "if(b between 25 and 54, 64800 + k * 7919 % 21600, k * 7919 % 64800)"
    refunded_at = "if(b < 63, 43200, 64800) + k * 104729 % 21600"
    entry = "named_struct('tag', '{}', 'entry_type', '{}', 'amount_paise', {}, 'second', {})"
    capture = entry.format("c", "capture", "amt", captured_at)
    refund = entry.format("r", "refund", "ref", refunded_at)
    entries = f"inline(if(b between 59 and 66, array({capture}, {refund}), array({capture})))"
    return (
        _payments(spark, sf_dir)
        .where("b >= 25")
        .selectExpr("k", "payment_id", "merchant_id", entries)
        .selectExpr(
            "concat('led_', cast(k as string), tag) as entry_id",
            "payment_id",
            "merchant_id",
            "entry_type",
            "amount_paise",
            "'INR' as currency",
            f"timestampadd(SECOND, second, {day}) as entry_ts",
            "case k % 4 when 0 then 'card' when 1 then 'wallet' else 'upi' end as method",
        )
    )


def _bank_rows(rows: DataFrame, settled_on: str) -> DataFrame:
    """Paise to the bank's rupees with two decimals, plus its fee and tax."""
    def rupees(paise: str, name: str) -> str:
        return f"cast(cast({paise} as decimal(18,0)) / 100 as decimal(18,2)) as {name}"

    return (
        rows.selectExpr("*", "floor(gross / 50) as fee_paise")
        .selectExpr("*", "floor(fee_paise * 18 / 100) as tax_paise")
        .selectExpr(
            "utr",
            "payment_id",
            "merchant_id",
            rupees("gross", "gross_amount"),
            rupees("fee_paise", "fee"),
            rupees("tax_paise", "tax"),
            rupees("gross - fee_paise - tax_paise", "net_amount"),
            "captured_on",
            f"date'{settled_on}' as settled_on",
            "remarks",
        )
    )


def raw_settlement(spark: SparkSession, sf_dir: str) -> DataFrame:
    gross = """case when b between 59 and 62 then amt - ref
                    when b in (67, 69) then amt + 1
                    when b in (68, 70) then amt - 1
                    else amt end as gross"""
    rows = (
        _payments(spark, sf_dir)
        .where("not b between 25 and 56")
        .selectExpr("*", "explode(if(b in (57, 58), array(0, 1), array(0))) as copy")
        .selectExpr(
            "concat('UTR', lpad(cast(k * 2 + copy as string), 14, '0')) as utr",
            "payment_id",
            "merchant_id",
            gross,
            f"if(b < 25, date'{PRIOR_DAY}', date'{DAY}') as captured_on",
            "if(copy = 1, 'RESUBMIT', null) as remarks",
        )
    )
    return _bank_rows(rows, DAY)


def raw_next_settlement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The next day's file: late captures arrive except every seventh, late refunds are netted."""
    rows = (
        _payments(spark, sf_dir)
        .where("b between 25 and 54 and k % 7 <> 0 or b between 63 and 66")
        .selectExpr(
            "concat('UTN', lpad(cast(k as string), 14, '0')) as utr",
            "payment_id",
            "merchant_id",
            "if(b < 63, amt, -ref) as gross",
            f"date'{DAY}' as captured_on",
            "cast(null as string) as remarks",
        )
    )
    return _bank_rows(rows, NEXT_DAY)


def raw_next_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The next day's ledger: a few captures after the cut-off, so new items open."""
    return (
        _payments(spark, sf_dir)
        .where("b = 499")
        .selectExpr(
            "concat('nxt_', cast(k as string)) as entry_id",
            "concat('pay_n', lpad(cast(k as string), 12, '0')) as payment_id",
            "merchant_id",
            "'capture' as entry_type",
            "amt as amount_paise",
            "'INR' as currency",
            f"timestampadd(SECOND, 64800 + k * 7919 % 21600, timestamp_ntz'{NEXT_DAY} 00:00:00') as entry_ts",
            "'upi' as method",
        )
    )


def raw_daily_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders placed from 23:45 arrive with the next day's batch."""
    ts = F.col("ts").cast("timestamp_ntz")
    order_date = ts.cast("date")
    late = (F.hour(ts) == 23) & (F.minute(ts) >= 45)
    user = F.col("user_id")
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("DO"), F.col("event_id").cast("string")).alias("order_id"),
        F.concat(F.lit("U"), user.cast("string")).alias("customer_id"),
        F.concat(F.lit("R"), (user % 600).cast("string")).alias("restaurant_id"),
        F.concat(F.lit("CITY_"), (user % 20).cast("string")).alias("city"),
        ts.alias("order_ts"),
        order_date.alias("order_date"),
        F.when(F.col("event_type") == "error", "cancelled").otherwise("delivered").alias("status"),
        _paise("value").alias("amount_paise"),
        (F.col("event_id") % 4 * 1300).cast("bigint").alias("delivery_fee_paise"),
        F.when(late, F.date_add(order_date, 1)).otherwise(order_date).alias("batch_day"),
    )


def raw_sellers(spark: SparkSession, sf_dir: str, snapshot: str) -> DataFrame:
    """The earlier or the later seller export; ``m`` says what changed in between."""
    earlier = snapshot == PREV_SNAPSHOT
    k = F.col("s_suppkey")
    m = k % 10
    text = k.cast("string")
    name, city = F.col("s_name"), F.col("n_name")
    kind = F.col("s_nationkey") % 9
    gstin = F.concat(F.lit("GST"), text)
    email = F.concat(F.lit("c"), text, F.lit("@example.com"))
    if earlier:
        name = F.when(m == 1, F.concat(name, F.lit("x"))).otherwise(name)
        gstin = F.when(m == 4, F.concat(gstin, F.lit("9"))).otherwise(gstin)
    else:
        kind = F.when(m == 0, (F.col("s_nationkey") + 1) % 9).otherwise(kind)
        city = F.when(m == 2, F.concat(city, F.lit("_NEW"))).otherwise(city)
        email = F.when(m == 3, F.concat(F.lit("ops."), text)).otherwise(email)
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    rows = (
        table(spark, sf_dir, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    if earlier:
        rows = rows.where(m != 9)
    return rows.select(
        F.concat(F.lit("S"), text).alias("seller_id"),
        name.alias("seller_name"),
        F.concat(F.lit("CAT_"), kind.cast("string")).alias("category"),
        city.alias("city"),
        F.col("r_name").alias("state"),
        gstin.alias("gstin"),
        email.alias("contact_email"),
        F.lit(snapshot).cast("date").alias("snapshot_date"),
    )


def raw_seller_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders spread over the sellers; none before a new seller's first export."""
    sellers = table(spark, sf_dir, "supplier").agg(F.count(F.lit(1))).scalar()
    seller = F.col("o_orderkey") * 31 % sellers
    order_date = F.col("o_orderdate").cast("date")
    too_early = (F.col("seller") % 10 == 9) & (F.col("order_date") < F.lit(CURR_SNAPSHOT).cast("date"))
    return (
        table(spark, sf_dir, "orders")
        .withColumn("seller", seller)
        .withColumn("order_date", order_date)
        .select(
            F.concat(F.lit("SO"), F.col("o_orderkey").cast("string")).alias("order_id"),
            "order_date",
            F.concat(
                F.lit("S"),
                F.when(too_early, F.col("seller") - 1).otherwise(F.col("seller")).cast("string"),
            ).alias("seller_id"),
            F.concat(F.lit("U"), F.col("o_custkey").cast("string")).alias("customer_id"),
            F.concat(F.lit("SKU"), (F.col("o_custkey") % 1000).cast("string")).alias("sku"),
            _paise("o_totalprice").alias("amount_paise"),
            F.when(F.col("o_orderstatus") == "P", "returned").otherwise("delivered").alias("status"),
        )
    )


def raw_order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Basket lines; the order-level fee depends on the number of lines and sits on each.

    Lines per order are counted with a combining aggregate and joined, not with a window, so
    one huge order is never sorted in a single task. The order's own attributes are joined
    before its lines, so that the long table is shuffled least.
    """
    lineitem = table(spark, sf_dir, "lineitem")
    lines = lineitem.groupBy(F.col("l_orderkey").alias("basket")).agg(
        F.count(F.lit(1)).alias("n_lines")
    )
    number = F.col("l_linenumber")
    guest = F.col("o_custkey") % 33 == 0
    return (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(lines, F.col("o_orderkey") == F.col("basket"))
        .join(lineitem, F.col("o_orderkey") == F.col("l_orderkey"))
        .join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.col("l_orderkey").cast("string").alias("order_id"),
            number.alias("line_no"),
            F.col("o_orderdate").cast("timestamp_ntz").alias("order_ts"),
            F.when(~guest, F.concat(F.lit("C"), F.col("o_custkey").cast("string"))).alias("customer_id"),
            F.col("c_name").alias("customer_name"),
            F.col("n_name").alias("city"),
            F.concat(F.lit("SKU"), F.col("l_partkey").cast("string")).alias("sku"),
            F.when(number == 1, F.upper("p_name")).otherwise(F.col("p_name")).alias("product_name"),
            F.col("p_type").alias("category"),
            F.col("l_quantity").cast("int").alias("qty"),
            _paise("p_retailprice").alias("unit_price_paise"),
            F.when(F.col("n_lines") >= 4, 0).otherwise(3500).cast("bigint").alias("delivery_fee_paise"),
        )
    )
