"""The driver contract: entry runs, every query has oracle SQL, and a sample
of queries agrees with DuckDB on the smallest tables."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF001
from tools.compare import digest


def test_entry_runs(spark):
    df = E.entry(spark)
    assert len(df.columns) == 27
    assert df.count() == 868


def test_every_query_has_oracle_sql():
    assert set(E.oracle_sql()) <= set(E.queries())
    own = {n for n, f in E.queries().items() if f.__module__ == E.__name__}
    assert own <= set(E.oracle_sql())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("events",):
        con.execute(f"create view {t} as select * from read_parquet('{os.path.join(SF001, t + '.parquet')}')")
    return con


@pytest.mark.parametrize(
    "name",
    ["fact_price_features", "dashboard_daily_summary", "dashboard_data_status", "check_no_hourly_gaps",
     "merge_fact_prices", "validate_rows", "usage_last_7_days", "dim_calendar"],
)
def test_matches_duckdb_at_smallest_scale(spark, duck, name):
    df = E.queries()[name](spark, SF001)
    s_rows = [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[name])
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    assert sorted(df.columns) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert digest(df.columns, s_rows)[0] == digest(d_cols, d_rows)[0]


def test_incremental_marks_with_ticks_without_a_price(spark, duck, tmp_root):
    """Bars whose low is 0 are filed as rejects; they stop neither run."""
    at = "timestamp '2024-01-01' + interval (i * 37) minute"
    events = f"""select i as event_id, i % 7 as user_id, {at} as ts, 'view' as event_type,
        case when i % 50 = 1 then 0.0 else 1.5 + i % 3 end as value from range(1100) t(i)"""
    path = os.path.join(tmp_root, "events.parquet")
    duck.execute(f"copy ({events}) to '{path}' (format parquet)")
    con = duckdb.connect()
    con.execute(f"create view events as select * from read_parquet('{path}')")
    want = con.execute(E.oracle_sql()["run_incremental_marks"])
    columns = [c[0] for c in want.description]
    rows = E.queries()["run_incremental_marks"](spark, tmp_root).select(columns).collect()
    assert sorted(map(tuple, rows)) == sorted(want.fetchall()) and len(rows) == 1
