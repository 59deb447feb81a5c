"""Model graph: FIXTURES counts, A6 identities, blocked == plain windows."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from candlewick.operators import checks, marts, serving
from candlewick.operators.series import with_positions
from candlewick.plans.models import FixtureGraph
from tests.conftest import SF001


def plain_features(prices):
    """The feature columns over whole series, one window for each."""
    w = Window.partitionBy("symbol", "bar_interval").orderBy("open_time_utc")
    return marts._feature_columns(prices, w, 24).select(*marts.FACT_PRICE_FEATURES_COLUMNS)


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize(
    "which,raw,dedup,b1,b2,btc,gaps,full,days,complete",
    [
        ("g01", 5027, 3385, 1573, 1812, 673, 198, 3270, 150, 36),
        ("g1", 5520, 3600, 1680, 1920, 720, 0, 3485, 150, 150),
    ],
)
def test_fixture_counts(request, which, raw, dedup, b1, b2, btc, gaps, full, days, complete):
    g = request.getfixturevalue(which)
    assert g.raw.count() == raw
    # every tick of the tape is in a bar
    assert g.norm.agg(F.sum("number_of_trades")).first()[0] == g.events.count()
    assert g.norm.count() == dedup
    split = {r["batch_id"]: r["count"] for r in g.norm.groupBy("batch_id").count().collect()}
    assert split == {"batch-001": b1, "batch-002": b2}
    assert g.prices.filter(F.col("symbol") == "BTCUSDT").count() == btc
    assert checks.check_no_gaps(g.prices).count() == gaps
    assert g.features.filter(F.col("rolling_window_observations_24h") == 24).count() == full
    cov = serving.coverage_by_day(g.prices)
    assert cov.count() == days
    assert cov.filter(F.col("coverage_status") == "complete").count() == complete
    assert checks.check_ohlc_consistency(g.stg).count() == 0
    assert checks.check_no_negative_volume(g.stg).count() == 0


def test_smallest_scale_counts(spark):
    g = FixtureGraph(spark, SF001, materialize=False)
    assert (g.raw.count(), g.norm.count()) == (1181, 868)


def test_gapless_identities(g1):
    """n gapless bars -> n-1 returns and n-23 full windows per series."""
    for r in serving.validate_marts(g1.features).collect():
        n = r["rows_count"]
        assert r["non_null_return_1h"] == n - 1
        assert r["non_null_log_return_1h"] == n - 1
        assert r["full_24h_windows"] == n - 23


def test_first_row_has_no_return_and_window_bounds(g01):
    assert checks.check_first_return_null(g01.features).count() == 0
    assert checks.check_valid_ranges(g01.features).count() == 0
    assert checks.check_log_return_consistency(g01.features).count() == 0


@pytest.mark.parametrize("block_rows", [24, 100, 257])
def test_blocked_features_equal_plain(g01, block_rows):
    assert _same(plain_features(g01.prices), marts.price_features(g01.prices, block_rows=block_rows))


def test_blocked_hourly_and_gaps_equal_plain(g01):
    assert _same(marts.price_hourly(g01.stg, block_rows=100_000), marts.price_hourly(g01.stg, block_rows=50))
    assert _same(checks.check_no_gaps(g01.prices, block_rows=100_000), checks.check_no_gaps(g01.prices, block_rows=7))


@pytest.mark.parametrize("block_rows", [24, 90, 100_000])
def test_rows_with_a_null_series_are_kept(g01, block_rows):
    """Bars without a symbol form a series; any block size gives the same."""
    hole = F.when(F.hour("open_time_utc") != 3, F.col("symbol"))
    prices = g01.prices.filter(F.col("symbol") == "BTCUSDT").withColumn("symbol", hole)
    blocked = marts.price_features(prices, block_rows=block_rows)
    assert blocked.count() == prices.count() and blocked.filter("symbol IS NULL").count() > 20
    assert _same(plain_features(prices), blocked)


def test_block_smaller_than_halo_rejected(g01):
    with pytest.raises(ValueError):
        marts.price_features(g01.prices, block_rows=10)


def test_positions_are_dense_per_series(g01):
    pos = with_positions(g01.prices)
    stats = pos.groupBy("symbol").agg(F.count("*").alias("n"), F.min("_pos").alias("lo"), F.max("_pos").alias("hi"),
                                      F.count_distinct("_pos").alias("d"))
    for r in stats.collect():
        assert (r["lo"], r["hi"], r["d"]) == (1, r["n"], r["n"])


def test_features_for_range_equals_trimmed_full(g01):
    start, end = dt.date(2024, 1, 12), dt.date(2024, 1, 18)
    part = marts.features_for_range(g01.prices, start, end)
    full = marts.price_features(g01.prices).filter(F.col("open_date").between(F.lit(start), F.lit(end)))
    assert part.count() > 0
    assert _same(part, full)


def test_calendar(g01):
    cal = {r["calendar_date"]: r for r in marts.dim_calendar(g01.norm, dt.date(2024, 1, 15)).collect()}
    assert len(cal) == 30
    sunday = cal[dt.date(2024, 1, 7)]
    assert (sunday["day_of_week"], sunday["day_name"]) == (1, "Sunday")
    assert cal[dt.date(2024, 1, 15)]["is_current_date"] and not cal[dt.date(2024, 1, 14)]["is_current_date"]
    assert cal[dt.date(2024, 1, 1)]["calendar_quarter"] == 1


def test_calendar_of_empty_input(spark, g01):
    assert marts.dim_calendar(g01.norm.limit(0)).count() == 0


def test_daily_summary_and_status(g1):
    daily = serving.daily_summary(g1.features).collect()
    assert len(daily) == 30 and all(r["bars_count"] == 24 for r in daily)
    status = {r["symbol"]: r for r in serving.data_status(g1.features, dt.datetime(2024, 2, 3)).collect()}
    btc = status["BTCUSDT"]
    assert btc["total_bars"] == 720 and btc["total_market_days"] == 30
    assert btc["bars_with_full_24h_window"] == 697
    # last bar 2024-01-30 23:00 -> 73 whole hours to 2024-02-03 00:00; last load 2024-02-02
    assert btc["hours_since_latest_market_bar"] == 73
    assert btc["hours_since_latest_load"] == 24


def test_dedup_prefers_latest_load(g01):
    both = g01.stg.groupBy("symbol", "bar_interval", "open_time_utc").count().filter("count > 1")
    kept = g01.norm.join(both, ["symbol", "bar_interval", "open_time_utc"], "left_semi")
    assert kept.filter(F.col("batch_id") != "batch-002").count() == 0
    assert kept.count() == both.count() == 1642


def test_halo_start_widens_until_every_series_has_its_rows(spark):
    from tests.helpers import bars

    d = dt.date(2024, 1, 1)
    many = bars(spark, d + dt.timedelta(days=50), 24 * 10).unionByName(bars(spark, d, 48, symbol="ETHUSDT"))
    prices = marts.fact_prices(staging_chain(many))
    # BTCUSDT needs one day back, ETHUSDT its last day of long before
    assert marts.halo_start(prices, d + dt.timedelta(days=58)) == d + dt.timedelta(days=1)


def test_halo_start_is_exact_under_gaps(spark):
    from tests.helpers import bars

    d = dt.date(2024, 1, 1)
    sparse = bars(spark, d, 10).unionByName(bars(spark, d + dt.timedelta(days=40), 10, batch_id="t-2"))
    prices = marts.fact_prices(staging_chain(sparse))
    start = d + dt.timedelta(days=60)
    # 20 bars before start, fewer than 24: the halo reaches the first day
    assert marts.halo_start(prices, start) == d
    dense = marts.fact_prices(staging_chain(bars(spark, d, 24 * 5)))
    assert marts.halo_start(dense, d + dt.timedelta(days=4)) == d + dt.timedelta(days=3)


def staging_chain(raw):
    from candlewick.operators import staging

    return staging.int_klines_normalized(staging.stg_klines(raw))


def test_hourly_with_hot_copies_equals_plain_lag(spark):
    """A bar loaded many times over: the pre-aggregated form gives the same
    rows as a plain lag over the fully ordered staging rows."""
    from pyspark.sql import Window

    from candlewick.functions import safe_divide
    from candlewick.operators import staging
    from tests.helpers import bars

    d = dt.date(2024, 1, 1)
    base = bars(spark, d, 48)
    hot = bars(spark, d + dt.timedelta(days=1), 1).withColumn(
        "_r", F.explode(F.sequence(F.lit(1), F.lit(2500)))
    ).drop("_r")
    relo = bars(spark, d, 48, batch_id="t-2", loaded_at=dt.datetime(2024, 2, 2), price=90.0)
    stg = staging.stg_klines(base.unionByName(hot).unionByName(relo))
    assert stg.count() == 48 + 2500 + 48
    order = ["open_time_utc", "loaded_at", "batch_id", "close", "open", "high", "low", "volume",
             "quote_asset_volume", "number_of_trades"]
    w = Window.partitionBy("symbol", "bar_interval").orderBy(*order)
    prev = F.lag("close").over(w)
    expected = stg.withColumn("return_1h", safe_divide(F.col("close") - prev, prev)).select(
        *marts.FACT_PRICE_HOURLY_COLUMNS
    )
    for block_rows in (100_000, 20):
        got = marts.price_hourly(stg, block_rows=block_rows)
        assert got.count() == 2596
        assert _same(got, expected)
