"""Serving views and reports over the marts.

Every aggregate here is a hash aggregate with a partial (map-side) phase, so
a hot series is combined before the shuffle on its key.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.functions import hours_between, lit_ts, safe_divide
from candlewick.schema import (
    COVERAGE_COMPLETE,
    COVERAGE_INCOMPLETE,
    DASHBOARD_INTERVAL,
    DASHBOARD_SYMBOL,
    EXPECTED_BARS_PER_DAY,
    MIB_BYTES,
    MIB_DECIMALS,
    ROLLING_ROWS,
    TIB_BYTES,
    TIB_DECIMALS,
    TIMESERIES_COLUMNS,
    USAGE_DAYS,
    USAGE_JOB_TYPE,
)


def _as_of(as_of) -> Column:
    return lit_ts(as_of) if as_of is not None else F.current_timestamp()


def price_timeseries(
    features: DataFrame, symbol: str = DASHBOARD_SYMBOL, bar_interval: str = DASHBOARD_INTERVAL
) -> DataFrame:
    """dashboard_price_timeseries: one series, 24 columns. The filter is on
    the window partition key, so Catalyst pushes it below the feature window
    to the scan."""
    return features.filter((F.col("symbol") == symbol) & (F.col("bar_interval") == bar_interval)).select(
        *TIMESERIES_COLUMNS
    )


def feature_extract(
    timeseries: DataFrame, symbol: str = DASHBOARD_SYMBOL, bar_interval: str = DASHBOARD_INTERVAL
) -> DataFrame:
    """Feature extract for downstream research: same columns, time order."""
    return price_timeseries(timeseries, symbol, bar_interval).orderBy("open_time_utc")


def daily_summary(
    features: DataFrame, symbol: str | None = DASHBOARD_SYMBOL, bar_interval: str | None = DASHBOARD_INTERVAL
) -> DataFrame:
    """dashboard_daily_summary: daily OHLCV, bar count, returns, volatility.

    First open / last close are ``min_by`` / ``max_by`` on open time
    (partial-aggregable top-1). ``symbol`` / ``bar_interval`` None = all.
    """
    df = features
    if symbol is not None:
        df = df.filter(F.col("symbol") == symbol)
    if bar_interval is not None:
        df = df.filter(F.col("bar_interval") == bar_interval)
    daily = df.groupBy("symbol", "bar_interval", "open_date").agg(
        F.min_by("open", "open_time_utc").alias("daily_open"),
        F.max("high").alias("daily_high"),
        F.min("low").alias("daily_low"),
        F.max_by("close", "open_time_utc").alias("daily_close"),
        F.sum("volume").alias("daily_volume"),
        F.count(F.lit(1)).alias("bars_count"),
        F.avg("return_1h").alias("average_hourly_return"),
        F.avg("rolling_volatility_24h").alias("average_rolling_volatility_24h"),
        F.min("open_time_utc").alias("first_bar_utc"),
        F.max("open_time_utc").alias("last_bar_utc"),
        F.max("loaded_at").alias("latest_loaded_at"),
    )
    return daily.select(
        "symbol",
        "bar_interval",
        "open_date",
        "daily_open",
        "daily_high",
        "daily_low",
        "daily_close",
        "daily_volume",
        "bars_count",
        safe_divide(F.col("daily_close") - F.col("daily_open"), "daily_open").alias("daily_return"),
        "average_hourly_return",
        "average_rolling_volatility_24h",
        "first_bar_utc",
        "last_bar_utc",
        "latest_loaded_at",
    )


def data_status(features: DataFrame, as_of: dt.datetime | None = None, rows: int = ROLLING_ROWS) -> DataFrame:
    """dashboard_data_status: coverage, freshness and full-window share per
    series. ``as_of`` replaces the wall clock so results are reproducible."""
    now = _as_of(as_of)
    full = F.count_if(F.col("rolling_window_observations_24h") == rows)
    agg = features.groupBy("symbol", "bar_interval").agg(
        F.count(F.lit(1)).alias("total_bars"),
        F.count_distinct("open_date").alias("total_market_days"),
        F.min("open_time_utc").alias("first_market_bar_utc"),
        F.max("open_time_utc").alias("latest_market_bar_utc"),
        F.max("loaded_at").alias("latest_loaded_at"),
        full.alias("bars_with_full_24h_window"),
    )
    return agg.select(
        "symbol",
        "bar_interval",
        "total_bars",
        "total_market_days",
        "first_market_bar_utc",
        "latest_market_bar_utc",
        "latest_loaded_at",
        hours_between(now, "latest_market_bar_utc").alias("hours_since_latest_market_bar"),
        hours_between(now, "latest_loaded_at").alias("hours_since_latest_load"),
        "bars_with_full_24h_window",
        safe_divide(F.col("bars_with_full_24h_window"), F.col("total_bars")).alias("full_24h_window_ratio"),
    )


def latest_status(status: DataFrame) -> DataFrame:
    """Latest market-data status report, ordered by series."""
    return status.select(
        "symbol",
        "bar_interval",
        "total_bars",
        "total_market_days",
        "first_market_bar_utc",
        "latest_market_bar_utc",
        "latest_loaded_at",
        "hours_since_latest_market_bar",
        "hours_since_latest_load",
        "full_24h_window_ratio",
    ).orderBy("symbol", "bar_interval")


def coverage_by_day(prices: DataFrame, expected_bars: int = EXPECTED_BARS_PER_DAY) -> DataFrame:
    """Bars per series and day; 'complete' iff exactly ``expected_bars``."""
    n = F.count(F.lit(1))
    return (
        prices.groupBy("symbol", "bar_interval", "open_date")
        .agg(
            n.alias("bars_count"),
            F.min("open_time_utc").alias("first_bar_utc"),
            F.max("open_time_utc").alias("last_bar_utc"),
        )
        .withColumn(
            "coverage_status",
            F.when(F.col("bars_count") == expected_bars, COVERAGE_COMPLETE).otherwise(COVERAGE_INCOMPLETE),
        )
        .orderBy(F.col("open_date").desc(), "symbol", "bar_interval")
    )


# --- daily partial aggregates ---------------------------------------------------

def daily_partials(features: DataFrame, rows: int = ROLLING_ROWS) -> DataFrame:
    """One row per series and day from which the daily summary, the data status and
    the coverage report follow without the bars: counts, sums and extremes. A
    day's partials depend on that day's features only, so a changed day replaces its own."""
    return features.groupBy("symbol", "bar_interval", "open_date").agg(
        F.min_by("open", "open_time_utc").alias("daily_open"),
        F.max("high").alias("daily_high"),
        F.min("low").alias("daily_low"),
        F.max_by("close", "open_time_utc").alias("daily_close"),
        F.sum("volume").alias("daily_volume"),
        F.count(F.lit(1)).alias("bars_count"),
        F.sum("return_1h").alias("return_sum"),
        F.count("return_1h").alias("return_count"),
        F.sum("rolling_volatility_24h").alias("volatility_sum"),
        F.count("rolling_volatility_24h").alias("volatility_count"),
        F.count_if(F.col("rolling_window_observations_24h") == rows).alias("full_windows"),
        F.min("open_time_utc").alias("first_bar_utc"),
        F.max("open_time_utc").alias("last_bar_utc"),
        F.max("loaded_at").alias("latest_loaded_at"),
    )


def daily_summary_of(
    partials: DataFrame, symbol: str | None = DASHBOARD_SYMBOL, bar_interval: str | None = DASHBOARD_INTERVAL
) -> DataFrame:
    """``daily_summary`` from partials: a projection."""
    df = partials
    if symbol is not None:
        df = df.filter(F.col("symbol") == symbol)
    if bar_interval is not None:
        df = df.filter(F.col("bar_interval") == bar_interval)
    return df.select(
        "symbol", "bar_interval", "open_date", "daily_open", "daily_high", "daily_low", "daily_close", "daily_volume",
        "bars_count",
        safe_divide(F.col("daily_close") - F.col("daily_open"), "daily_open").alias("daily_return"),
        safe_divide(F.col("return_sum"), F.col("return_count")).alias("average_hourly_return"),
        safe_divide(F.col("volatility_sum"), F.col("volatility_count")).alias("average_rolling_volatility_24h"),
        "first_bar_utc", "last_bar_utc", "latest_loaded_at",
    )


def data_status_of(partials: DataFrame, as_of: dt.datetime | None = None) -> DataFrame:
    """``data_status`` from partials: one row a series and day is added up."""
    now = _as_of(as_of)
    agg = partials.groupBy("symbol", "bar_interval").agg(
        F.sum("bars_count").alias("total_bars"),
        # one partial a day
        F.count("open_date").alias("total_market_days"),
        F.min("first_bar_utc").alias("first_market_bar_utc"),
        F.max("last_bar_utc").alias("latest_market_bar_utc"),
        F.max("latest_loaded_at").alias("latest_loaded_at"),
        F.sum("full_windows").alias("bars_with_full_24h_window"),
    )
    return agg.select(
        "symbol", "bar_interval", "total_bars", "total_market_days", "first_market_bar_utc", "latest_market_bar_utc",
        "latest_loaded_at",
        hours_between(now, "latest_market_bar_utc").alias("hours_since_latest_market_bar"),
        hours_between(now, "latest_loaded_at").alias("hours_since_latest_load"),
        "bars_with_full_24h_window",
        safe_divide(F.col("bars_with_full_24h_window"), F.col("total_bars")).alias("full_24h_window_ratio"),
    )


def coverage_by_day_of(partials: DataFrame, expected_bars: int = EXPECTED_BARS_PER_DAY) -> DataFrame:
    """``coverage_by_day`` from partials."""
    status = F.when(F.col("bars_count") == expected_bars, COVERAGE_COMPLETE).otherwise(COVERAGE_INCOMPLETE)
    return partials.select(
        "symbol", "bar_interval", "open_date", "bars_count", "first_bar_utc", "last_bar_utc",
        status.alias("coverage_status"),
    ).orderBy(F.col("open_date").desc(), "symbol", "bar_interval")


def contract_check(timeseries: DataFrame, rows: int = ROLLING_ROWS) -> DataFrame:
    """Data contract for downstream consumers, per series."""
    full = F.count_if(F.col("rolling_window_observations_24h") == rows)
    return (
        timeseries.groupBy("symbol", "bar_interval")
        .agg(
            F.count(F.lit(1)).alias("rows_count"),
            F.min("open_time_utc").alias("first_open_time_utc"),
            F.max("open_time_utc").alias("latest_open_time_utc"),
            F.count_if(F.col("close").isNull()).alias("null_close_count"),
            F.count_if(F.col("volume").isNull()).alias("null_volume_count"),
            F.count_if(F.col("return_1h").isNull()).alias("null_return_1h_count"),
            full.alias("full_rolling_window_rows"),
        )
        .withColumn(
            "full_rolling_window_ratio", safe_divide(F.col("full_rolling_window_rows"), F.col("rows_count"))
        )
    )


def validate_raw(raw: DataFrame) -> DataFrame:
    """Raw table validation: rows and time bounds per symbol and interval."""
    return raw.groupBy("symbol", "interval").agg(
        F.count(F.lit(1)).alias("rows_count"),
        F.min("open_time_utc").alias("min_open_time"),
        F.max("open_time_utc").alias("max_open_time"),
    )


def validate_marts(features: DataFrame, rows: int = ROLLING_ROWS) -> DataFrame:
    """Mart validation: n rows -> n-1 returns and max(0, n-rows+1) full
    windows per gap-free series."""
    return features.groupBy("symbol", "bar_interval").agg(
        F.count(F.lit(1)).alias("rows_count"),
        F.count_if(F.col("return_1h").isNotNull()).alias("non_null_return_1h"),
        F.count_if(F.col("log_return_1h").isNotNull()).alias("non_null_log_return_1h"),
        F.count_if(F.col("rolling_window_observations_24h") == rows).alias("full_24h_windows"),
        F.min("open_time_utc").alias("min_open_time"),
        F.max("open_time_utc").alias("max_open_time"),
    )


def usage(
    jobs: DataFrame, as_of: dt.datetime | None = None, days: int = USAGE_DAYS, by_user: bool = True
) -> DataFrame:
    """Warehouse query usage over the last ``days`` days, by day (and user):
    jobs, processed / billed MiB (2 decimals) and billed TiB (6 decimals)."""
    now = _as_of(as_of)
    recent = jobs.filter(
        (F.col("creation_time") >= now - F.make_dt_interval(F.lit(days))) & (F.col("job_type") == USAGE_JOB_TYPE)
    )
    keys = [F.to_date("creation_time").alias("usage_date")] + ([F.col("user_email")] if by_user else [])
    mib, tib = float(MIB_BYTES), float(TIB_BYTES)
    out = recent.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("query_jobs"),
        F.round(F.sum("total_bytes_processed") / mib, MIB_DECIMALS).alias("processed_mib"),
        F.round(F.sum("total_bytes_billed") / mib, MIB_DECIMALS).alias("billed_mib"),
        F.round(F.sum("total_bytes_billed") / tib, TIB_DECIMALS).alias("billed_tib"),
    )
    order = [F.col("usage_date").desc()] + ([F.col("billed_mib").desc()] if by_user else [])
    return out.orderBy(*order)
