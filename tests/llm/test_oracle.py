"""Queries with SQL against DuckDB on sf0.01."""

import os
import sys

import pytest

from clickwin.llm.queries import LLM_QUERIES, LLM_SQL

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.join(ROOT, "tools"))
from check_oracle import digest, duck  # noqa: E402

SF01 = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(LLM_SQL))
def test_matches_duckdb(spark, name):
    df = LLM_QUERIES[name](spark, SF01)
    res = duck(SF01).execute(LLM_SQL[name])
    rows = res.fetchall()
    assert digest(df.columns, [tuple(r) for r in df.collect()]) == digest(
        [d[0] for d in res.description], rows)


def test_all_operators_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in LLM_QUERIES) == list(range(1, 14))
