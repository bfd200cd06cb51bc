"""Every operator as a named query over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyline import fixtures as fx
from tallyline.functions import values as v
from tallyline.operators import baskets, carry, compare, digests, orders, quality, reports, rollups, sellers
from tallyline.operators import staging as stage
from tallyline.operators.matching import classify_differences, match_figures, match_payments
from tallyline.plans import checks, open_items, reconcile
from tallyline.plans.sellers import add_snapshots, rebuild_history, seller_history
from tallyline.schemas import SETTLEMENT
from tallyline.session import scratch_folder, written
from tallyline.sources import bucketed, daily_state, tables
from tallyline.sources.csv_files import read_csv, write_csv
from tallyline.streaming import deliveries
from tallyline.streaming.orders import stream_orders as stream_orders_of
from tallyline.streaming.orders import streamed_orders

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

PAIR_SUPPORT = "0.0001"


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# Staging


@query
def stg_order_lines(spark, sf):
    return stage.stage_order_lines(fx.raw_order_lines(spark, sf))


@query
def stg_daily_orders(spark, sf):
    return stage.stage_daily_orders(fx.raw_daily_orders(spark, sf))


@query
def stg_seller_orders(spark, sf):
    return stage.stage_seller_orders(fx.raw_seller_orders(spark, sf))


@query
def stg_sellers_prev(spark, sf):
    return stage.stage_sellers(fx.raw_sellers(spark, sf, fx.PREV_SNAPSHOT))


@query
def stg_sellers_curr(spark, sf):
    return stage.stage_sellers(fx.raw_sellers(spark, sf, fx.CURR_SNAPSHOT))


@query
def stg_ledger(spark, sf):
    return stage.stage_ledger(fx.raw_ledger(spark, sf))


@query
def stg_settlement(spark, sf):
    return stage.stage_settlement(fx.raw_settlement(spark, sf))


# Loading: files are written from the tables first, then loaded the way a delivery is.

FILE_DAY = r"file_day=(\d{4}-\d{2}-\d{2})"


def _daily_files(spark, sf, folder):
    raw = fx.raw_daily_orders(spark, sf).withColumnRenamed("batch_day", "file_day")
    write_csv(raw, folder, partition_by="file_day")


@query
def load_whole(spark, sf):
    folder = scratch_folder(spark, "whole")
    delivered = f"{folder}/settlement.csv"
    write_csv(fx.raw_settlement(spark, sf), delivered)
    tables.load_whole(spark, {"settlement": (delivered, SETTLEMENT)}, f"{folder}/raw")
    return spark.read.schema(SETTLEMENT).parquet(f"{folder}/raw/settlement")


@query
def load_all_days(spark, sf):
    folder = scratch_folder(spark, "days")
    _daily_files(spark, sf, f"{folder}/files")
    tables.load_all_days(spark, f"{folder}/files", f"{folder}/orders", FILE_DAY)
    return stage.stage_daily_orders(tables.orders_table(spark, f"{folder}/orders"))


def _orders_with_rerun(spark, sf):
    """The daily orders table after one day was appended a second time."""
    folder = scratch_folder(spark, "rerun")
    _daily_files(spark, sf, f"{folder}/files")
    table, day_file = f"{folder}/orders", f"{folder}/files/file_day={fx.RERUN_DAY}"
    tables.load_all_days(spark, f"{folder}/files", table, FILE_DAY)
    tables.append_day(spark, day_file, fx.RERUN_DAY, table)
    return table, day_file, f"{folder}/fact"


@query
def load_day_append(spark, sf):
    table, _, _ = _orders_with_rerun(spark, sf)
    return stage.stage_daily_orders(tables.orders_table(spark, table))


@query
def backfill_day(spark, sf):
    """The doubled day is replaced; the fact is right again."""
    table, day_file, fact = _orders_with_rerun(spark, sf)
    tables.rebuild_daily_fact(spark, table, fact)
    tables.backfill_day(spark, day_file, fx.RERUN_DAY, table, fact)
    return tables.daily_fact(spark, fact)


@query
def stream_orders(spark, sf):
    """The daily files as a stream of rows, stopped and started again; one file comes twice, the second time to no effect."""
    folder = scratch_folder(spark, "stream")
    raw = fx.raw_daily_orders(spark, sf).withColumnRenamed("batch_day", "file_day")
    early = F.col("file_day") <= F.lit(fx.RERUN_DAY).cast("date")
    run = partial(
        stream_orders_of, spark, f"{folder}/files", f"{folder}/orders", f"{folder}/checkpoint", f"{folder}/rejects",
        day_in_path=FILE_DAY, files_at_once=1000,
    )
    write_csv(raw.where(early), f"{folder}/files", partition_by="file_day")
    run().awaitTermination()
    again = raw.where(~early).unionByName(raw.where(F.col("file_day") == F.lit(fx.RERUN_DAY).cast("date")))
    write_csv(again, f"{folder}/files", mode="append", partition_by="file_day")
    run().awaitTermination()
    return stage.stage_daily_orders(streamed_orders(spark, f"{folder}/orders"))


@query
def take_deliveries(spark, sf):
    """All daily files, of which one is cut short first and delivered again whole: the fact in the end."""
    folder = scratch_folder(spark, "deliveries")
    table, fact = f"{folder}/orders", f"{folder}/fact"
    raw = fx.raw_daily_orders(spark, sf)
    day = F.lit(fx.RERUN_DAY).cast("date")
    others = raw.where(F.col("batch_day") != day)
    others.write.partitionBy("batch_day").parquet(table)
    others.select("order_date", "batch_day").distinct().write.partitionBy("batch_day").parquet(f"{table}_dates")
    tables.rebuild_daily_fact(spark, table, fact)
    rows = raw.where(F.col("batch_day") == day).withColumnRenamed("batch_day", "file_day").coalesce(1)
    for part in (rows.where(F.substring("order_id", 3, 18).cast("bigint") % 2 == 0), rows):
        write_csv(part, f"{folder}/files", mode="overwrite", partition_by="file_day")
        deliveries.take_deliveries(spark, f"{folder}/files", table, fact, f"{folder}/manifest", day_in_path=FILE_DAY)
    return tables.daily_fact(spark, fact)


@query
def backfill_from_state(spark, sf):
    """The doubled day again, repaired from the state of the batches instead of their rows."""
    table, day_file, fact = _orders_with_rerun(spark, sf)
    daily_state.build_state(spark, table, fact)
    daily_state.backfill_from_state(spark, day_file, fx.RERUN_DAY, table, fact)
    return tables.daily_fact(spark, fact)


@query
def daily_orders_from_state(spark, sf):
    """The fact merged from state per batch, with one day present twice."""
    return daily_state.fact_of(daily_state.batch_state(_rerun_rows(spark, sf)))


@query
def export_csv(spark, sf):
    """The seller snapshot written as a CSV result and read back."""
    path = scratch_folder(spark, "export")
    snapshot = stg_sellers_curr(spark, sf)
    write_csv(snapshot, path)
    return read_csv(spark, path, snapshot.schema)


# Daily orders


def _rerun_rows(spark, sf):
    """The staged rows with one day present twice, without going through files."""
    rows = stg_daily_orders(spark, sf)
    again = F.when(F.col("batch_day") == F.lit(fx.RERUN_DAY).cast("date"), 2).otherwise(1)
    return rows.select("*", F.explode(F.sequence(F.lit(1), again)).alias("copy")).drop("copy")


@query
def daily_orders(spark, sf):
    return orders.daily_orders(stg_daily_orders(spark, sf))


@query
def duplicate_orders(spark, sf):
    return orders.duplicate_orders(_rerun_rows(spark, sf))


@query
def dedup_orders(spark, sf):
    return orders.dedup_orders(_rerun_rows(spark, sf))


@query
def compare_results(spark, sf):
    figures = ["order_rows", "orders", "delivered_revenue_paise"]
    before = orders.daily_orders(_rerun_rows(spark, sf))
    return compare.compare_results(before, daily_orders(spark, sf), ["order_date"], figures)


@query
def compare_by_digests(spark, sf):
    figures = ["order_rows", "orders", "delivered_revenue_paise"]
    before = orders.daily_orders(_rerun_rows(spark, sf))
    return digests.compare_by_digests(before, daily_orders(spark, sf), ["order_date"], figures)


# Sellers


@query
def dim_sellers_current(spark, sf):
    return sellers.current_sellers(stg_sellers_curr(spark, sf))


@query
def fct_orders_current(spark, sf):
    return sellers.orders_with_current_seller(stg_seller_orders(spark, sf), dim_sellers_current(spark, sf))


@query
def dim_sellers_history(spark, sf):
    return seller_history([stg_sellers_prev(spark, sf), stg_sellers_curr(spark, sf)])


def _sellers_next(spark, sf):
    """A third export: every fifth seller moves to one city, every sixth corrects its name."""
    number = F.substring("seller_id", 2, 18).cast("bigint") % 10
    return (
        stg_sellers_curr(spark, sf)
        .withColumn("snapshot_date", F.lit(fx.NEXT_SNAPSHOT).cast("date"))
        .withColumn("city", F.when(number == 5, "MOVED").otherwise(F.col("city")))
        .withColumn("seller_name", F.when(number == 6, F.concat("seller_name", F.lit("z"))).otherwise(F.col("seller_name")))
    )


@query
def dim_sellers_history_replayed(spark, sf):
    """Three exports, then the first one again: it must change nothing."""
    first = stg_sellers_prev(spark, sf)
    return seller_history([first, stg_sellers_curr(spark, sf), _sellers_next(spark, sf), first])


def _sellers_between(spark, sf):
    """An export between the second and the third: every seventh seller is elsewhere for its time, others are missing."""
    number = F.substring("seller_id", 2, 18).cast("bigint") % 10
    rows = stg_sellers_curr(spark, sf).where(number != 4)
    state = F.when(number == 7, "ELSEWHERE").otherwise(F.col("state"))
    return rows.withColumn("snapshot_date", F.lit(fx.LATE_SNAPSHOT).cast("date")).withColumn("state", state)


@query
def dim_sellers_history_late(spark, sf):
    """Four exports, of which the earlier ones come late and one comes twice: the history is that of their dates."""
    folder = scratch_folder(spark, "sellers")
    exports = {
        fx.NEXT_SNAPSHOT: _sellers_next(spark, sf),
        fx.PREV_SNAPSHOT: stg_sellers_prev(spark, sf),
        fx.CURR_SNAPSHOT: stg_sellers_curr(spark, sf),
    }
    add_snapshots(spark, folder, exports)
    rebuild_history(spark, folder)
    add_snapshots(spark, folder, {fx.LATE_SNAPSHOT: _sellers_between(spark, sf), fx.PREV_SNAPSHOT: stg_sellers_prev(spark, sf)})
    return rebuild_history(spark, folder)


@query
def fct_orders_asof(spark, sf):
    return sellers.orders_as_of(stg_seller_orders(spark, sf), dim_sellers_history(spark, sf))


@query
def seller_changes(spark, sf):
    return sellers.seller_changes(stg_sellers_prev(spark, sf), stg_sellers_curr(spark, sf))


# Reconciliation


@query
def ledger_by_payment(spark, sf):
    return rollups.ledger_by_payment(stg_ledger(spark, sf))


@query
def settlement_by_payment(spark, sf):
    return rollups.settlement_by_payment(stg_settlement(spark, sf))


@query
def long_payment_utrs(spark, sf):
    """Transfers of payments with more than one of them, as rows."""
    return rollups.long_payment_utrs(stg_settlement(spark, sf), more_than=1)


@query
def matched(spark, sf):
    return reconcile.match_day(stg_ledger(spark, sf), stg_settlement(spark, sf))


ROLLUP_BUCKETS = 16


@query
def matched_stored(spark, sf):
    """The match over stored rollups whose buckets meet without a shuffle."""
    folder = scratch_folder(spark, "rollups")
    ours = bucketed.store_buckets(ledger_by_payment(spark, sf), f"{folder}/ledger", "payment_id", ROLLUP_BUCKETS)
    bank = bucketed.store_buckets(settlement_by_payment(spark, sf), f"{folder}/settlement", "payment_id", ROLLUP_BUCKETS)
    return match_payments(ours, bank)


def _match_figures(spark, sf):
    return match_figures(stg_ledger(spark, sf), stg_settlement(spark, sf))


def _difference_figures(spark, sf):
    return classify_differences(_match_figures(spark, sf), fx.CUTOFF, fx.DAY)


@query
def differences(spark, sf):
    return classify_differences(matched(spark, sf), fx.CUTOFF, fx.DAY)


@query
def category_summary(spark, sf):
    return reports.category_summary(_match_figures(spark, sf))


@query
def reconciliation_report(spark, sf):
    return reconcile.report_day(stg_ledger(spark, sf), stg_settlement(spark, sf), fx.CUTOFF, fx.DAY)


@query
def recon_totals(spark, sf):
    return reports.totals(stg_ledger(spark, sf), stg_settlement(spark, sf))


@query
def key_uniqueness(spark, sf):
    return reports.key_uniqueness(stg_ledger(spark, sf), stg_settlement(spark, sf))


@query
def profile_key(spark, sf):
    return reports.profile_key(stg_daily_orders(spark, sf), "restaurant_id", "daily_orders")


@query
def key_duplicates(spark, sf):
    return reports.key_duplicates(stg_ledger(spark, sf), stg_settlement(spark, sf))


@query
def unmatched_sample(spark, sf):
    return reconcile.sample_day(stg_ledger(spark, sf), stg_settlement(spark, sf))


@query
def difference_report(spark, sf):
    return reports.difference_report(differences(spark, sf))


@query
def carry_forward(spark, sf):
    opened = carry.open_items(_difference_figures(spark, sf), fx.DAY)
    ledger = stage.stage_ledger(fx.raw_next_ledger(spark, sf))
    settlement = stage.stage_settlement(fx.raw_next_settlement(spark, sf))
    next_match = match_figures(ledger, settlement)
    today = classify_differences(next_match, fx.NEXT_CUTOFF, fx.NEXT_DAY)
    return carry.carry_forward(opened, today, fx.NEXT_DAY)


CHAIN = ["2025-09-15", "2025-09-16", "2025-09-17", "2025-09-18", "2025-09-19"]


def _chain_days(spark, sf, folder):
    """Differences of five days: late captures arrive on the second, third and fifth, nothing happens on the fourth."""
    first = written(_difference_figures(spark, sf), f"{folder}/first")
    columns = ["payment_id", "merchant_id", "cause", "difference_paise"]
    number = F.substring("payment_id", 5, 12).cast("bigint")
    late = first.where(F.col("cause") == v.AFTER_CUTOFF)
    arrived = late.select("payment_id", "merchant_id", F.lit(v.PRIOR_DAY_CAPTURE).alias("cause"), (-F.col("difference_paise")).alias("difference_paise"))
    days = [arrived.where(number % 7 >= 2), arrived.where(number % 7 == 1), first.limit(0), arrived.where((number % 7 == 0) & (number % 2 == 0))]
    return [df.select(*columns) for df in (first, *days)], number


@query
def carry_replayed(spark, sf):
    """Five days, of which the second one is delivered in part first and then rerun: later days follow."""
    folder = scratch_folder(spark, "chain")
    days, number = _chain_days(spark, sf, folder)
    for day, differences in zip(CHAIN, days, strict=True):
        open_items.close_day(spark, folder, day, differences.where(number % 7 < 5) if day == CHAIN[1] else differences)
    open_items.close_day(spark, folder, CHAIN[1], days[1])
    return reduce(
        DataFrame.unionByName,
        [open_items.open_items_of(spark, folder, day).withColumn("business_day", F.lit(day).cast("date")) for day in CHAIN],
    )


@query
def carry_summary(spark, sf):
    return carry.carry_summary(carry_forward(spark, sf))


# Checks: on the data as it is, and on data with planted faults


@query
def check_unique(spark, sf):
    return quality.repeated_keys(stg_ledger(spark, sf), "payment_id")


@query
def check_not_null(spark, sf):
    return quality.null_counts(stg_order_lines(spark, sf), ["order_id", "sku", "qty", "customer_id"])


@query
def check_accepted_values(spark, sf):
    return quality.unaccepted_values(stg_ledger(spark, sf), "entry_type", [v.CAPTURE])


def _coverage(spark, sf, found):
    payments = [side.select("payment_id").distinct() for side in (stg_ledger(spark, sf), stg_settlement(spark, sf))]
    return quality.coverage_gaps(*payments, found)


@query
def check_coverage(spark, sf):
    return _coverage(spark, sf, _match_figures(spark, sf))


@query
def check_coverage_broken(spark, sf):
    return _coverage(spark, sf, _match_figures(spark, sf).where(F.col("category") != v.DIFFERING))


@query
def check_category_gap(spark, sf):
    return quality.category_gap(category_summary(spark, sf), stg_ledger(spark, sf), stg_settlement(spark, sf))


@query
def check_category_gap_broken(spark, sf):
    part = category_summary(spark, sf).where(F.col("category") != v.LEDGER_ONLY)
    return quality.category_gap(part, stg_ledger(spark, sf), stg_settlement(spark, sf))


@query
def check_cause_gap(spark, sf):
    return quality.cause_gap(_difference_figures(spark, sf), stg_ledger(spark, sf), stg_settlement(spark, sf))


@query
def check_cause_gap_broken(spark, sf):
    """With the day set one earlier, yesterday's captures have no cause any more."""
    found = classify_differences(_match_figures(spark, sf), fx.CUTOFF, fx.PRIOR_DAY)
    return quality.cause_gap(found, stg_ledger(spark, sf), stg_settlement(spark, sf))


def _damaged_settlement(spark, sf):
    """A paisa off the net of every 500th transfer, another merchant on second transfers."""
    number = F.substring("utr", 4, 14).cast("bigint")
    return (
        stg_settlement(spark, sf)
        .withColumn("net_paise", F.col("net_paise") + F.when(number % 500 == 0, 1).otherwise(0))
        .withColumn(
            "merchant_id",
            F.when(F.col("remarks") == "RESUBMIT", F.concat("merchant_id", F.lit("-B"))).otherwise(F.col("merchant_id")),
        )
    )


@query
def check_settlement_math(spark, sf):
    return quality.settlement_math(_damaged_settlement(spark, sf))


@query
def check_merchant_conflicts(spark, sf):
    return quality.merchant_conflicts(_damaged_settlement(spark, sf))


@query
def check_all(spark, sf):
    """All column checks, one row per check: staging as views, everything else as stored tables."""
    folder = scratch_folder(spark, "checks")
    tables_ = {name: QUERIES[name](spark, sf) for name in checks.CHECKS if name.startswith("stg_")}

    def store(name: str, df: DataFrame) -> DataFrame:
        tables_[name] = written(df, f"{folder}/{name}")
        return tables_[name]

    store("daily_orders", orders.daily_orders(tables_["stg_daily_orders"]))
    current = store("dim_sellers_current", sellers.current_sellers(tables_["stg_sellers_curr"]))
    store("fct_orders_current", sellers.orders_with_current_seller(tables_["stg_seller_orders"], current))
    ours = store("ledger_by_payment", rollups.ledger_by_payment(tables_["stg_ledger"]))
    bank = store("settlement_by_payment", rollups.settlement_by_payment(tables_["stg_settlement"]))
    met = store("matched", match_payments(ours, bank))
    store("differences", classify_differences(met, fx.CUTOFF, fx.DAY))
    return checks.run_checks(tables_)


# Baskets


@query
def fct_order_lines(spark, sf):
    return baskets.fct_order_lines(stg_order_lines(spark, sf))


@query
def fct_baskets(spark, sf):
    return baskets.fct_baskets(stg_order_lines(spark, sf))


@query
def basket_size_profile(spark, sf):
    return baskets.basket_size_profile(stg_order_lines(spark, sf))


@query
def dim_product(spark, sf):
    return baskets.dim_product(stg_order_lines(spark, sf))


@query
def dim_customer(spark, sf):
    return baskets.dim_customer(stg_order_lines(spark, sf))


@query
def dim_date(spark, sf):
    return baskets.dim_date(stg_order_lines(spark, sf))


@query
def product_pairs(spark, sf):
    return baskets.product_pairs(stg_order_lines(spark, sf), "sku", PAIR_SUPPORT)
