"""Every registered query equals its DuckDB oracle on sf0.01 (order-insensitive)."""

import os
import sys

import pytest

import __spark_entry__ as E
from clickwin.plans.queries import QUERIES

from conftest import ROOT, SF01

sys.path.insert(0, os.path.join(ROOT, "tools"))
from check_oracle import digest, duck  # noqa: E402

SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_duckdb(spark, con, name):
    assert name in SQL, f"{name} has no oracle SQL"
    df = QUERIES[name](spark, SF01)
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(SQL[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert len(srows) == len(drows)
    assert digest(df.columns, srows) == digest(dcols, drows)
