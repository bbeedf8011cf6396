"""Driver contract, and every registered query against its SQL oracle (sf0.001)."""
from __future__ import annotations

import math
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from brickyard.catalog import QUERIES

from .conftest import SF_SMALL

TABLES = "region nation customer supplier part orders lineitem".split()


def test_entry_returns_rows(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert set(df.columns) == {"district", "year", "median_price", "transactions", "mean_price"}


def test_every_query_of_the_catalog_has_an_oracle():
    assert set(QUERIES) <= set(entry.queries()) and set(QUERIES) <= set(entry.oracle_sql())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float):
        return round(v, 6) if not math.isnan(v) else "nan"
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(repr(_norm(r[i])) for i in order) for r in rows)


@pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="test data absent")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    sdf = entry.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in sdf.collect()]
    res = con.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert _bag(sdf.columns, srows) == _bag(dcols, drows)
