"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; one JSON line on stdout.

Each query is planned and run to the last row into a sink that drops it. The figure is the
best of $BENCH_RUNS runs after one warm-up run at the same scale; the total is their sum.
"""

from __future__ import annotations

import json
import os
import time

from tallyline.catalog import QUERIES
from tallyline.session import local_session

HEADLINES = [
    "reconciliation_report",
    "category_summary",
    "matched",
    "differences",
    "difference_report",
    "unmatched_sample",
    "ledger_by_payment",
    "settlement_by_payment",
    "recon_totals",
    "key_uniqueness",
    "key_duplicates",
    "check_coverage",
    "check_category_gap",
    "check_cause_gap",
    "check_unique",
    "check_all",
    "carry_forward",
    "daily_orders",
    "dedup_orders",
    "load_all_days",
    "backfill_day",
    "fct_orders_current",
    "dim_sellers_history",
    "fct_orders_asof",
    "seller_changes",
    "stg_order_lines",
    "fct_order_lines",
    "fct_baskets",
    "dim_product",
    "product_pairs",
]


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = local_session(cpus, partitions=cpus, memory="8g")
    seconds = {}
    for name in HEADLINES:
        run(spark, name, sf_dir)
        seconds[name] = round(min(run(spark, name, sf_dir) for _ in range(runs)), 3)
    result = {
        "metric": "headline queries, sum of best runs",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
