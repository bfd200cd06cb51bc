"""Command line for spark-submit: build a story, rerun a day, export a query.

spark-submit jobs.py reconcile LEDGER.csv SETTLEMENT.csv FOLDER --day 2025-09-15 --cutoff "2025-09-15 18:00:00"
spark-submit jobs.py orders "FILES/orders_*.csv" FOLDER
spark-submit jobs.py backfill FILES/orders_2025-08-14.csv FOLDER --day 2025-08-14
spark-submit jobs.py sellers EARLIER.csv LATER.csv ORDERS.csv FOLDER
spark-submit jobs.py baskets LINES.csv FOLDER

spark-submit jobs.py query FOLDER --query "select ..." --out RESULT
spark-submit jobs.py check FOLDER

``--query`` (SQL text or a .sql file) with ``--out`` exports a result as CSV, after a build or, as a job of its
own, from the tables that earlier builds stored in a folder. ``check`` runs the column checks on those.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from tallyline.plans import stories
from tallyline.plans.checks import assert_checks, run_checks
from tallyline.session import SETTINGS
from tallyline.sources.csv_files import query_to_csv
from tallyline.sources.tables import backfill_day


def parser() -> argparse.ArgumentParser:
    common = argparse.ArgumentParser(add_help=False)
    common.add_argument("--query")
    common.add_argument("--out")
    jobs = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    kinds = jobs.add_subparsers(dest="job", required=True)
    arguments = {
        "reconcile": ["ledger", "settlement", "folder"],
        "orders": ["files", "folder"],
        "backfill": ["file", "folder"],
        "sellers": ["earlier", "later", "orders", "folder"],
        "baskets": ["lines", "folder"],
        "query": ["folder"],
        "check": ["folder"],
    }
    for job, names in arguments.items():
        kind = kinds.add_parser(job, parents=[common])
        for name in names:
            kind.add_argument(name)
        if job in ("reconcile", "backfill"):
            kind.add_argument("--day", required=True)
        if job == "reconcile":
            kind.add_argument("--cutoff", required=True)
        if job == "backfill":
            kind.add_argument("--allow-empty", action="store_true")
    return jobs


def parsed(arguments: list[str] | None = None) -> argparse.Namespace:
    jobs = parser()
    args = jobs.parse_args(arguments)
    if bool(args.query) != bool(args.out) or (args.job == "query" and not args.query):
        jobs.error("--query and --out go together")
    return args


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.job == "reconcile":
        stories.build_reconciliation(spark, args.ledger, args.settlement, args.cutoff, args.day, args.folder)
    elif args.job == "orders":
        stories.build_daily_orders(spark, args.files, args.folder)
    elif args.job == "backfill":
        table, fact = f"{args.folder}/orders", f"{args.folder}/daily_orders"
        loaded = backfill_day(spark, args.file, args.day, table, fact, allow_empty=args.allow_empty)
        print(f"{args.day}: {loaded.rows_read} rows read, {loaded.rows_held} rows held")
    elif args.job == "sellers":
        stories.build_sellers(spark, args.earlier, args.later, args.orders, args.folder)
    elif args.job == "baskets":
        stories.build_baskets(spark, args.lines, args.folder)
    elif args.job == "check":
        tables = stories.register_stored(spark, args.folder)
        run_checks(tables).show(1000, truncate=False)
        assert_checks(tables)
    if args.query:
        if args.job in ("query", "backfill"):
            stories.register_stored(spark, args.folder)
        query_to_csv(spark, args.query, args.out)


if __name__ == "__main__":
    builder = SparkSession.builder.appName("tallyline")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    run(builder.getOrCreate(), parsed())
