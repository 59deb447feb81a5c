"""Materialized build: tables + views, suite over stored tables, incremental
feature refresh equals a full rebuild."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from candlewick.plans import build
from tests.helpers import bars


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_build_and_test_over_tables(spark, g01, tmp_root):
    b = build.build_marts(spark, g01.raw, tmp_root, as_of=dt.datetime(2024, 2, 3), view_prefix="t_")
    assert b.tables["fact_prices"].count() == 3385
    assert _same(b.tables["fact_price_features"], g01.features)
    assert spark.table("t_marts_dashboard_data_status").count() == 5
    assert spark.table("t_staging_stg_klines").count() == 5027
    symbols = ["BTCUSDT", "ETHUSDT", "SOLUSDT", "BNBUSDT", "XRPUSDT"]
    with pytest.raises(build.DataTestFailure, match="no_hourly_gaps"):
        build.test_build(b, strict=True, symbols=symbols)
    summary = build.test_build(b, symbols=symbols)
    fails = {(r["model"], r["check_name"]) for r in summary.collect() if r["status"] == "fail"}
    assert fails == {
        ("stg_klines", "unique"),
        ("stg_klines", "unique_natural_key"),
        ("fact_prices", "no_hourly_gaps"),
    }


def test_incremental_features_equal_full_rebuild(spark, tmp_root):
    d = dt.date(2024, 1, 1)
    first = bars(spark, d, 24 * 3)
    more = first.unionByName(bars(spark, d + dt.timedelta(days=3), 24 * 2, batch_id="t-2", price=150.0))
    inc_root, full_root = os.path.join(tmp_root, "inc"), os.path.join(tmp_root, "full")
    build.build_marts(spark, first, inc_root)
    inc = build.build_marts(spark, more, inc_root, incremental_features=True)
    full = build.build_marts(spark, more, full_root)
    a, b = inc.tables["fact_price_features"], full.tables["fact_price_features"]
    assert a.count() == 120
    assert _same(a, b)
    # days before the newest target day were not rewritten
    assert a.filter(F.col("open_date") < F.lit(d + dt.timedelta(days=2))).count() == 48


def test_incremental_features_with_new_symbol_history(spark, tmp_root):
    """per_symbol merge: a new symbol arrives with history older than the
    newest bar; the incremental refresh starts at its first day."""
    d = dt.date(2024, 1, 1)
    first = bars(spark, d, 24 * 4)
    more = first.unionByName(bars(spark, d, 24 * 2, symbol="ETHUSDT", batch_id="t-2", price=50.0))
    inc_root, full_root = os.path.join(tmp_root, "inc"), os.path.join(tmp_root, "full")
    build.build_marts(spark, first, inc_root)
    inc = build.build_marts(spark, more, inc_root, incremental_features=True, per_symbol=True)
    assert inc.merge_info["first_day"] == d
    full = build.build_marts(spark, more, full_root)
    assert _same(inc.tables["fact_price_features"], full.tables["fact_price_features"])
    # rebuilding with nothing new keeps the stored features
    again = build.build_marts(spark, more, inc_root, incremental_features=True, per_symbol=True)
    assert again.tables["fact_price_features"].count() == 24 * 6


def test_two_builds_on_a_uri_lose_nothing(spark, tmp_root):
    d = dt.date(2024, 1, 1)
    root = f"file://{tmp_root}"
    build.build_marts(spark, bars(spark, d, 24 * 3), root)
    b = build.build_marts(spark, bars(spark, d + dt.timedelta(days=3), 24 * 2), root, incremental_features=True)
    assert b.merge_info["mode"] == "merge"
    assert b.tables["fact_prices"].count() == b.tables["fact_price_features"].count() == 120


def test_features_catch_up_after_a_cut_off_run(spark, tmp_root):
    """The fact was merged, then the run died before it wrote features."""
    from candlewick.operators import marts, staging
    from candlewick.plans import merge

    d = dt.date(2024, 1, 1)
    more = bars(spark, d, 24 * 4)
    build.build_marts(spark, bars(spark, d, 24 * 2), tmp_root)
    norm = staging.int_klines_normalized(staging.stg_klines(more))
    merge.merge_into(spark, os.path.join(tmp_root, "fact_prices"), marts.fact_prices(norm))
    last = more.unionByName(bars(spark, d + dt.timedelta(days=4), 24, batch_id="t-5"))
    b = build.build_marts(spark, last, tmp_root, incremental_features=True)
    assert b.tables["fact_price_features"].count() == 24 * 5
    assert _same(b.tables["fact_price_features"], marts.price_features(b.tables["fact_prices"]))


def _stored(spark, root, name):
    from candlewick.sources.versioned import VersionedTable

    return VersionedTable(spark, os.path.join(root, name), build.PARTITIONS.get(name))


def test_features_follow_changed_values(spark, tmp_root):
    """The fact changed values, not numbers of rows, and the run that changed it was
    cut off before the features: the next build finds the stale day by its digest."""
    from candlewick.operators import marts, staging
    from candlewick.plans import merge

    d = dt.date(2024, 1, 1)
    build.build_marts(spark, bars(spark, d, 24 * 6), tmp_root)
    changed = bars(spark, d, 24 * 6).withColumn(
        "close", F.when(F.col("open") == 100 + 24 * 3 + 7, F.col("close") + 0.5).otherwise(F.col("close")))
    norm = staging.int_klines_normalized(staging.stg_klines(changed))
    merge.merge_into(spark, os.path.join(tmp_root, "fact_prices"), marts.fact_prices(norm), full_refresh=True)
    b = build.build_marts(spark, changed, tmp_root, incremental_features=True)
    assert b.refreshed_from == d + dt.timedelta(days=3)
    assert _same(b.tables["fact_price_features"], marts.price_features(b.tables["fact_prices"]))
    again = build.build_marts(spark, changed, tmp_root, incremental_features=True)
    assert again.refreshed_from is None


def test_appends_read_the_new_days_and_the_tail(spark, tmp_root, monkeypatch):
    """Series that ended long ago, gaps and a new series: features from the tail equal
    the full rebuild, and no older day is read."""
    from candlewick.operators import marts

    d = dt.date(2024, 1, 1)
    history = (
        bars(spark, d, 24 * 30).unionByName(bars(spark, d, 7, symbol="OLD"))
        .unionByName(bars(spark, d, 24 * 20, symbol="GAP", skip_days=tuple(d + dt.timedelta(days=i) for i in range(3, 19))))
    )
    build.build_marts(spark, history, tmp_root)
    tail = _stored(spark, tmp_root, "fact_price_tail")
    assert {r["symbol"]: r["count"] for r in tail.read().groupBy("symbol").count().collect()} == {
        "BTCUSDT": 24, "OLD": 7, "GAP": 24}
    monkeypatch.setattr(marts, "features_for_range", None)  # the way for changed history
    raw, day = history, d + dt.timedelta(days=30)
    for hours, symbols in ((24, ("BTCUSDT",)), (30, ("BTCUSDT", "NEW")), (24, ("GAP", "BTCUSDT"))):
        for s in symbols:
            raw = raw.unionByName(bars(spark, day, hours, symbol=s, price=70.0, batch_id=f"t-{day}"))
        b = build.build_marts(spark, raw, tmp_root, incremental_features=True)
        assert b.refreshed_from >= day - dt.timedelta(days=2)
        day += dt.timedelta(days=hours // 24)
        assert _same(b.tables["fact_price_features"], marts.price_features(b.tables["fact_prices"]))
    assert tail.commit().notes["before"] == "2024-02-02"


def test_an_append_plans_no_scan_of_old_days(spark, tmp_root):
    from candlewick.operators import marts
    from candlewick.plans import merge
    from tests.test_plans import plan

    d = dt.date(2024, 1, 1)
    build.build_marts(spark, bars(spark, d, 24 * 10), tmp_root)
    prices = merge.read_fact_prices(spark, os.path.join(tmp_root, "fact_prices"))
    start = d + dt.timedelta(days=9)
    halo = marts.series_tail(_stored(spark, tmp_root, "fact_price_tail").read())
    text = plan(marts.features_after(prices.filter(F.col("open_date") >= F.lit(start)), halo, start, block_rows=100))
    filters = [line for line in text.splitlines() if "PartitionFilters" in line and "open_date" in line]
    assert filters and all("2024-01-10" in line for line in filters)
    assert "WindowGroupLimit" in text


def test_reports_from_partials_equal_those_from_the_bars(spark, g01, tmp_root):
    from candlewick.operators import serving

    as_of = dt.datetime(2024, 2, 3)
    half = g01.raw.filter(F.col("open_time_utc") < F.lit("2024-01-17 09:00:00").cast("timestamp"))
    build.build_marts(spark, half, tmp_root, as_of=as_of)
    old = _stored(spark, tmp_root, "daily_partials").commit()
    b = build.build_marts(spark, g01.raw, tmp_root, as_of=as_of, incremental_features=True)
    features = b.tables["fact_price_features"]
    rounded = lambda df: df.select(*[F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])
    partials = _stored(spark, tmp_root, "daily_partials").read()
    assert _same(rounded(serving.daily_summary_of(partials, None, None)), rounded(serving.daily_summary(features, None, None)))
    assert _same(b.tables["dashboard_data_status"], serving.data_status(features, as_of))
    assert _same(b.tables["data_coverage_by_day"], serving.coverage_by_day(b.tables["fact_prices"]))
    assert old.notes != _stored(spark, tmp_root, "daily_partials").commit().notes


def test_no_staged_folder_is_left_after_builds(spark, tmp_root):
    from candlewick import session

    before = session.list_names(spark, f"{session.ensure_checkpoint_dir(spark)}/staged")
    for n in (2, 3):
        build.build_marts(spark, bars(spark, dt.date(2024, 1, 1), 24 * n), tmp_root, incremental_features=True)
    assert session.list_names(spark, f"{session.ensure_checkpoint_dir(spark)}/staged") == before
