"""Declared schemas and key constants. Nothing is ever inferred."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# These must equal the reference's for equal results.
#   landed bars: source "binance_spot", dataset "klines", interval "1h"
#     (the only supported interval)
#   symbol dimension: asset class "crypto", exchange "Binance Spot",
#     quote currency "USDT"
#   dashboards serve symbol "BTCUSDT", interval "1h"
#   rolling window 24 rows; a day is "complete" with 24 bars, else "incomplete"
#   log-return consistency tolerance 1e-9
#   source freshness: warn after 7 days, error after 30 days
#   usage report: last 7 days, job type "QUERY", MiB = 1024^2 bytes rounded
#     to 2 decimals, TiB = 1024^4 bytes rounded to 6 decimals
#   an empty merge target counts as newest bar 1900-01-01 00:00:00
SOURCE_NAME, DATASET_NAME, BAR_INTERVAL = "binance_spot", "klines", "1h"
SUPPORTED_INTERVALS = ("1h",)
ASSET_CLASS, EXCHANGE, QUOTE_CURRENCY = "crypto", "Binance Spot", "USDT"
DASHBOARD_SYMBOL, DASHBOARD_INTERVAL = "BTCUSDT", "1h"
ROLLING_ROWS = 24
EXPECTED_BARS_PER_DAY = 24
COVERAGE_COMPLETE, COVERAGE_INCOMPLETE = "complete", "incomplete"
LOG_RETURN_TOLERANCE = 1e-9
FRESHNESS_WARN_DAYS, FRESHNESS_ERROR_DAYS = 7, 30
USAGE_DAYS, USAGE_JOB_TYPE = 7, "QUERY"
MIB_BYTES, TIB_BYTES = 1024**2, 1024**4
MIB_DECIMALS, TIB_DECIMALS = 2, 6
EMPTY_TARGET_FLOOR = _dt.datetime(1900, 1, 1)
# ---------------------------------------------------------------------------

# Natural key of a bar and the key of one time series.
SERIES_KEY = ("symbol", "bar_interval")
NATURAL_KEY = ("symbol", "bar_interval", "open_time_utc")

# Raw-zone partition columns (directory order) and the column the raw table is
# day-partitioned by.
RAW_PARTITION_COLUMNS = ("source", "dataset", "symbol", "interval", "date")

_S, _L, _D, _TS = T.StringType(), T.LongType(), T.DoubleType(), T.TimestampType()


def _struct(fields, nullable=False) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t in fields])


# 19 REQUIRED columns of the raw table, in table order.
RAW_KLINES_FIELDS = [
    ("source", _S),
    ("dataset", _S),
    ("symbol", _S),
    ("interval", _S),
    ("open_time_ms", _L),
    ("open_time_utc", _TS),
    ("open", _D),
    ("high", _D),
    ("low", _D),
    ("close", _D),
    ("volume", _D),
    ("close_time_ms", _L),
    ("close_time_utc", _TS),
    ("quote_asset_volume", _D),
    ("number_of_trades", _L),
    ("taker_buy_base_asset_volume", _D),
    ("taker_buy_quote_asset_volume", _D),
    ("loaded_at", _TS),
    ("batch_id", _S),
]
RAW_KLINES = _struct(RAW_KLINES_FIELDS)
RAW_COLUMNS = [n for n, _ in RAW_KLINES_FIELDS]

# Positional layout of one exchange kline row (element 11, if present, is ignored).
KLINE_ARRAY_FIELDS = [
    ("open_time_ms", _L),
    ("open", _D),
    ("high", _D),
    ("low", _D),
    ("close", _D),
    ("volume", _D),
    ("close_time_ms", _L),
    ("quote_asset_volume", _D),
    ("number_of_trades", _L),
    ("taker_buy_base_asset_volume", _D),
    ("taker_buy_quote_asset_volume", _D),
]
KLINE_MIN_FIELDS = len(KLINE_ARRAY_FIELDS)

# Staging / normalized bars: raw columns renamed, open_date added (20 columns).
STG_COLUMNS = [
    "source",
    "source_dataset",
    "symbol",
    "bar_interval",
    "open_time_ms",
    "open_time_utc",
    "open_date",
    "open",
    "high",
    "low",
    "close",
    "volume",
    "close_time_ms",
    "close_time_utc",
    "quote_asset_volume",
    "number_of_trades",
    "taker_buy_base_asset_volume",
    "taker_buy_quote_asset_volume",
    "loaded_at",
    "batch_id",
]

FACT_PRICES_COLUMNS = [
    "symbol",
    "bar_interval",
    "open_time_utc",
    "open_date",
    "open",
    "high",
    "low",
    "close",
    "volume",
    "quote_asset_volume",
    "number_of_trades",
    "taker_buy_base_asset_volume",
    "taker_buy_quote_asset_volume",
    "loaded_at",
    "batch_id",
]

FEATURE_COLUMNS = [
    "previous_close",
    "previous_volume",
    "return_1h",
    "log_return_1h",
    "price_range",
    "price_range_pct",
    "body_size_pct",
    "volume_change_1h",
    "rolling_mean_close_24h",
    "rolling_volatility_24h",
    "rolling_volume_mean_24h",
    "rolling_window_observations_24h",
]
FACT_PRICE_FEATURES_COLUMNS = (
    FACT_PRICES_COLUMNS[:13] + FEATURE_COLUMNS + ["loaded_at", "batch_id"]
)

TIMESERIES_COLUMNS = [
    c
    for c in FACT_PRICE_FEATURES_COLUMNS
    if c not in ("previous_close", "previous_volume", "batch_id")
]

FACT_PRICE_HOURLY_COLUMNS = [
    "symbol",
    "bar_interval",
    "open_time_utc",
    "open_date",
    "open",
    "high",
    "low",
    "close",
    "volume",
    "quote_asset_volume",
    "number_of_trades",
    "return_1h",
    "loaded_at",
    "batch_id",
]

# High-water mark state rows, one per (source, dataset, symbol, interval).
WATERMARK = _struct(
    [
        ("source", _S),
        ("dataset", _S),
        ("symbol", _S),
        ("interval", _S),
        ("last_open_time_ms", _L),
        ("updated_at", _TS),
    ]
)
WATERMARK_KEY = ("source", "dataset", "symbol", "interval")

# Warehouse job log consumed by the usage reports.
JOB_LOG = _struct(
    [
        ("creation_time", _TS),
        ("user_email", _S),
        ("job_type", _S),
        ("total_bytes_processed", _L),
        ("total_bytes_billed", _L),
    ],
    nullable=True,
)
