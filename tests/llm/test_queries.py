"""The registered queries against their SQL."""

from __future__ import annotations

import os
import subprocess
import sys

import duckdb
import pytest
from oracle_compare import difference

import __spark_entry__ as entry_module
from tallyline.llm.queries import LLM_ORACLE, LLM_QUERIES

SMALL = "/root/testdata/sf0.001"


def test_every_dealt_operator_and_the_pipeline_are_registered():
    assert {int(n[2:].split("_")[0]) for n in LLM_QUERIES if n.startswith("op")} == set(range(1, 14))
    assert "pipeline" in LLM_QUERIES and set(LLM_QUERIES) <= set(entry_module.queries())
    assert set(LLM_ORACLE) <= set(LLM_QUERIES)


@pytest.mark.parametrize("name", sorted(LLM_ORACLE))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for name_ in ("documents", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {name_} AS SELECT * FROM '{SMALL}/{name_}.parquet'")
    assert difference(LLM_QUERIES[name](spark, SMALL), con, LLM_ORACLE[name]) is None


def test_the_rest_imports_without_the_subpackage(tmp_path):
    """With the subpackage away the entry still has its other queries."""
    root = os.path.dirname(os.path.abspath(entry_module.__file__))
    code = (
        "import sys\n"
        "class Away:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name.split('.')[:2] == ['tallyline', 'llm'] or name == 'corpus_pipeline':\n"
        "            raise ModuleNotFoundError(f'No module named {name!r}', name=name)\n"
        "sys.meta_path.insert(0, Away())\n"
        f"sys.path.insert(0, {root!r})\n"
        "import __spark_entry__ as e\n"
        "names = e.queries()\n"
        "assert 'matched' in names and not any(n.startswith('op') or n == 'pipeline' for n in names)\n"
    )
    subprocess.run([sys.executable, "-c", code], check=True, cwd=tmp_path, timeout=120)
