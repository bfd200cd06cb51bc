"""Run catalog queries next to their SQL on the same tables.

python tests/oracle_compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import decimal
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    return float(value) if isinstance(value, decimal.Decimal) else value


def difference(spark_df, con, text: str) -> str | None:
    """None if both results hold the same rows under the same columns, else what differs."""
    cursor = con.execute(text)
    names = [c[0] for c in cursor.description]
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} vs {sorted(names)}"
    order = sorted(names)
    picks = [names.index(n) for n in order]
    expected = sorted((tuple(_plain(r[i]) for i in picks) for r in cursor.fetchall()), key=repr)
    actual = sorted((tuple(_plain(v) for v in r) for r in spark_df.select(*order).collect()), key=repr)
    if expected == actual:
        return None
    only = [r for r in actual if r not in set(expected)][:2], [r for r in expected if r not in set(actual)][:2]
    return f"{len(actual)} vs {len(expected)} rows; only ours {only[0]}; only SQL {only[1]}"


if __name__ == "__main__":
    from oracle.sql import ORACLE
    from tallyline.catalog import QUERIES
    from tallyline.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, con = local_session(8), connect(sf)
    bad = 0
    for name in sys.argv[2:] or QUERIES:
        start = time.time()
        try:
            found = difference(QUERIES[name](spark, sf), con, ORACLE[name])
        except Exception as error:  # report and go on with the next query
            found = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += found is not None
        print(f"{'ok ' if found is None else 'BAD'} {name} {time.time() - start:.1f}s {found or ''}", flush=True)
    print("bad:", bad)
