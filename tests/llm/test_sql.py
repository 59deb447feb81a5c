"""Registered SQL against Spark on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as E
from candlewick.llm import queries
from tests.conftest import SF001


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql_gives_the_same_rows(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    want = con.sql(E.oracle_sql()[name])
    got = E.queries()[name](spark, SF001)
    assert sorted(got.columns) == sorted(want.columns)
    rows = sorted(tuple(r[c] for c in want.columns) for r in got.collect())
    assert rows == sorted(want.fetchall())
