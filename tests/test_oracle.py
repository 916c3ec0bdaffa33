"""Every registered query against its DuckDB oracle at sf0.001: same column
names, same row count, same multiset of rows."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from dqspark.plans.catalog import all_queries

from .conftest import SMALL

SOURCES = ["customer", "supplier", "orders", "lineitem", "events"]
NAMES = sorted(all_queries())


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else repr(v)
    return str(v)


def _rows(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in records),
                  key=lambda t: tuple("" if x is None else x for x in t))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in SOURCES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SMALL, t + '.parquet')}')")
    return c


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 0
    assert "discrepancy_amount" in df.columns


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    sdf = entry.queries()[name](spark, SMALL)
    s_rows = [tuple(r) for r in sdf.collect()]
    cur = con.execute(entry.oracle_sql()[name])
    d_cols = [d[0] for d in cur.description]
    d_rows = cur.fetchall()
    assert sorted(sdf.columns) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert _rows(sdf.columns, s_rows) == _rows(d_cols, d_rows)


def test_oracle_sql_reads_only_the_registered_views():
    for name, sql in entry.oracle_sql().items():
        low = sql.lower()
        assert "read_parquet" not in low and "/root/" not in low, name
        assert " limit " not in low, name
