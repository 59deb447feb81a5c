"""The data-test suite of the marts as data: 64 not_null, 5 unique,
5 accepted_values, 4 relationships and 9 model-level checks.

Reference defaults that only hold for one series are parameters here: single
column uniqueness of open times is judged within a series (the natural key),
and the accepted symbols / intervals are arguments.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from candlewick.operators import checks as C
from candlewick.operators.series import DEFAULT_BLOCK_ROWS
from candlewick.schema import (
    ASSET_CLASS,
    DASHBOARD_SYMBOL,
    DATASET_NAME,
    NATURAL_KEY,
    SERIES_KEY,
    SOURCE_NAME,
    SUPPORTED_INTERVALS,
)

# not_null columns per model.
NOT_NULL = {
    "stg_klines": [
        "source", "source_dataset", "symbol", "bar_interval", "open_time_ms", "open_time_utc",
        "open_date", "open", "high", "low", "close", "volume", "loaded_at", "batch_id",
    ],
    "int_klines_normalized": ["symbol", "bar_interval", "open_time_utc", "open_date", "close", "volume"],
    "dim_symbol": ["symbol", "asset_class", "exchange", "quote_currency"],
    "dim_calendar": ["calendar_date", "calendar_year", "calendar_month", "calendar_day"],
    "fact_prices": ["symbol", "bar_interval", "open_time_utc", "open_date", "close", "volume"],
    "fact_price_features": [
        "symbol", "bar_interval", "open_time_utc", "open_date", "close", "volume",
        "price_range", "price_range_pct", "body_size_pct", "rolling_window_observations_24h",
    ],
    "fact_price_hourly": ["symbol", "bar_interval", "open_time_utc", "close", "volume"],
    "dashboard_price_timeseries": ["symbol", "bar_interval", "open_time_utc", "close", "volume"],
    "dashboard_daily_summary": ["symbol", "bar_interval", "open_date", "daily_close", "daily_volume"],
    "dashboard_data_status": ["symbol", "bar_interval", "total_bars", "latest_market_bar_utc", "latest_loaded_at"],
}


def default_suite(
    symbols: Sequence[str] = (DASHBOARD_SYMBOL,),
    intervals: Sequence[str] = SUPPORTED_INTERVALS,
    sources: Sequence[str] = (SOURCE_NAME,),
    datasets: Sequence[str] = (DATASET_NAME,),
    asset_classes: Sequence[str] = (ASSET_CLASS,),
    block_rows: int = DEFAULT_BLOCK_ROWS,
) -> list[C.Check]:
    suite: list[C.Check] = []
    for model, cols in NOT_NULL.items():
        suite += [C.Check(model, "not_null", c, violation=C.is_null(c)) for c in cols]

    def unique(model: str, column: str, keys: Sequence[str]) -> C.Check:
        return C.Check(model, "unique", column, unique_keys=tuple(keys))

    within_series = lambda col: [*SERIES_KEY, col]
    suite += [
        unique("stg_klines", "open_time_ms", within_series("open_time_ms")),
        unique("stg_klines", "open_time_utc", within_series("open_time_utc")),
        unique("int_klines_normalized", "open_time_utc", within_series("open_time_utc")),
        unique("dim_symbol", "symbol", ["symbol"]),
        unique("dim_calendar", "calendar_date", ["calendar_date"]),
    ]

    def accepted(model: str, column: str, values: Sequence[str]) -> C.Check:
        # violations = distinct values outside the list (NULL is not judged)
        return C.Check(
            model, "accepted_values", column, violation=C.not_in(column, values), distinct_of=column
        )

    suite += [
        accepted("stg_klines", "source", sources),
        accepted("stg_klines", "source_dataset", datasets),
        accepted("stg_klines", "symbol", symbols),
        accepted("stg_klines", "bar_interval", intervals),
        accepted("dim_symbol", "asset_class", asset_classes),
    ]

    def rel(model: str, column: str, parent: str, field: str) -> C.Check:
        return C.Check(model, "relationships", column, references=(parent, field))

    suite += [
        rel("fact_prices", "symbol", "dim_symbol", "symbol"),
        rel("fact_prices", "open_date", "dim_calendar", "calendar_date"),
        rel("fact_price_features", "symbol", "dim_symbol", "symbol"),
        rel("fact_price_features", "open_date", "dim_calendar", "calendar_date"),
    ]
    key = ",".join(NATURAL_KEY)

    def no_gaps(models: dict[str, DataFrame]) -> DataFrame:
        """From the stored islands of the build, else from the bars."""
        if "day_islands" in models:
            return C.check_no_gaps_of(models["day_islands"], block_rows=block_rows)
        return C.check_no_gaps(models["fact_prices"], block_rows=block_rows)

    suite += [
        C.Check("stg_klines", "unique_natural_key", key, unique_keys=NATURAL_KEY),
        C.Check("stg_klines", "no_negative_volume", "volume", violation=C.NEGATIVE_VOLUME),
        C.Check("stg_klines", "ohlc_consistency", "high,low", violation=C.OHLC_INCONSISTENT),
        C.Check("fact_prices", "unique_natural_key", key, unique_keys=NATURAL_KEY),
        C.Check("fact_prices", "no_hourly_gaps", "open_time_utc", run=no_gaps),
        C.Check("fact_price_features", "unique_natural_key", key, unique_keys=NATURAL_KEY),
        C.Check(
            "fact_price_features", "first_return_null", "return_1h",
            run=lambda m: C.check_first_return_null(m["fact_price_features"]),
        ),
        C.Check(
            "fact_price_features", "log_return_consistency", "log_return_1h", violation=C.log_return_inconsistent()
        ),
        C.Check(
            "fact_price_features", "valid_ranges", "price_range,rolling_window_observations_24h",
            violation=C.out_of_range(),
        ),
    ]
    return suite


def models_of(graph, calendar_as_of=None) -> dict[str, DataFrame]:
    """Model name -> DataFrame for a ``ModelGraph``."""
    return {
        "stg_klines": graph.stg,
        "int_klines_normalized": graph.norm,
        "dim_symbol": graph.dim_symbol,
        "dim_calendar": graph.dim_calendar(calendar_as_of),
        "fact_prices": graph.prices,
        "fact_price_features": graph.features,
        "fact_price_hourly": graph.hourly,
        "dashboard_price_timeseries": graph.timeseries,
        "dashboard_daily_summary": graph.daily_summary,
        "dashboard_data_status": graph.data_status,
    }
