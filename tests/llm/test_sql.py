"""Queries that SQL can express, against DuckDB."""

from __future__ import annotations

import duckdb
import pytest

from dqspark.llm.queries import llm_oracle_sql, llm_queries

from ..conftest import SMALL


@pytest.mark.parametrize("name", sorted(llm_oracle_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    cursor = con.execute(llm_oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    got = llm_queries()[name](spark, SMALL)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(str, (tuple(r) for r in got.select(*columns).collect()))) == sorted(map(str, cursor.fetchall()))
