"""Star-schema marts: fact_prices, fact_price_features, fact_price_hourly,
dim_symbol, dim_calendar."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlewick.functions import guarded_log_ratio, safe_divide
from candlewick.operators.series import DEFAULT_BLOCK_ROWS, expand_copies, series_window
from candlewick.schema import (
    ASSET_CLASS,
    EXCHANGE,
    FACT_PRICE_FEATURES_COLUMNS,
    FACT_PRICE_HOURLY_COLUMNS,
    FACT_PRICES_COLUMNS,
    QUOTE_CURRENCY,
    ROLLING_ROWS,
    SERIES_KEY,
)


def fact_prices(norm: DataFrame) -> DataFrame:
    """Canonical 15-column fact at the natural-key grain (full-refresh form;
    the incremental form is ``plans.merge``)."""
    return norm.select(*FACT_PRICES_COLUMNS)


def _feature_columns(df: DataFrame, w: Window, rows: int) -> DataFrame:
    frame = w.rowsBetween(-(rows - 1), Window.currentRow)
    lagged = df.withColumns(
        {
            "previous_close": F.lag("close").over(w),
            "previous_volume": F.lag("volume").over(w),
        }
    )
    derived = lagged.withColumns(
        {
            "return_1h": safe_divide(F.col("close") - F.col("previous_close"), "previous_close"),
            "log_return_1h": guarded_log_ratio("close", "previous_close"),
            "price_range": F.col("high") - F.col("low"),
            "price_range_pct": safe_divide(F.col("high") - F.col("low"), "open"),
            "body_size_pct": safe_divide(F.abs(F.col("close") - F.col("open")), "open"),
            "volume_change_1h": safe_divide(F.col("volume") - F.col("previous_volume"), "previous_volume"),
        }
    )
    # All four share one frame over one spec: one sort serves them all.
    return derived.withColumns(
        {
            "rolling_mean_close_24h": F.avg("close").over(frame),
            "rolling_volatility_24h": F.stddev_samp("return_1h").over(frame),
            "rolling_volume_mean_24h": F.avg("volume").over(frame),
            "rolling_window_observations_24h": F.count(F.lit(1)).over(frame),
        }
    )


def price_features(prices: DataFrame, rows: int = ROLLING_ROWS, block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """fact_prices -> fact_price_features (27 columns).

    Previous close/volume by ``lag``; returns with NULL on zero divisors; log
    return only where both closes are positive; rolling mean/volatility/volume
    and window size over the last ``rows`` ROWS (not hours). The oldest return
    in a frame needs its own previous row, so a block needs ``rows`` halo rows.
    """
    out = series_window(
        prices.select(*FACT_PRICES_COLUMNS),
        lambda df, w: _feature_columns(df, w, rows),
        halo=rows,
        block_rows=block_rows,
    )
    return out.select(*FACT_PRICE_FEATURES_COLUMNS)


def halo_start(
    prices: DataFrame, start: dt.date, rows: int = ROLLING_ROWS, look_back_days: int = 8
) -> dt.date | None:
    """Earliest day holding one of the last ``rows`` bars before ``start`` in
    any series (exact under gaps of any length). None when nothing precedes.

    Rows per (series, day) are a partial aggregate over key columns; the running
    count from the newest day backwards runs over that small table. Days are
    looked at ``look_back_days`` back, then four times as far, until every
    series has its rows or the days before that hold none.
    """
    before = prices.filter(F.col("open_date") < F.lit(start))
    oldest = before.agg(F.min("open_date")).first()[0]  # partition column of a stored table
    if oldest is None:
        return None
    newer = Window.partitionBy(*SERIES_KEY).orderBy(F.col("open_date").desc()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    while True:
        low = max(oldest, start - dt.timedelta(days=look_back_days))
        counts = (
            before.filter(F.col("open_date") >= F.lit(low)).groupBy(*SERIES_KEY, "open_date")
            .agg(F.count(F.lit(1)).alias("_n"))
        )
        if low > oldest:
            # series that exist before, with what they have in these days
            total = counts.groupBy(*SERIES_KEY).agg(F.sum("_n").alias("_total"))
            earlier = before.filter(F.col("open_date") < F.lit(low)).select(*SERIES_KEY).distinct()
            same = [F.col(f"e.{c}").eqNullSafe(F.col(f"t.{c}")) for c in SERIES_KEY]
            short = earlier.alias("e").join(total.alias("t"), same, "left").filter(
                F.coalesce("_total", F.lit(0)) < rows
            )
            if not short.isEmpty():
                look_back_days *= 4
                continue
        later = counts.withColumn("_later", F.coalesce(F.sum("_n").over(newer), F.lit(0)))
        return later.filter(F.col("_later") < rows).agg(F.min("open_date")).first()[0]


def features_for_range(
    prices: DataFrame,
    start: dt.date,
    end: dt.date,
    rows: int = ROLLING_ROWS,
    lookback_days: int | None = None,
    block_rows: int = DEFAULT_BLOCK_ROWS,
) -> DataFrame:
    """Features for bars with ``start <= open_date <= end`` only.

    A date filter cannot be pushed below a window (earlier rows feed the
    frame), so the scan is bounded explicitly -- from ``halo_start`` (exact),
    or ``start - lookback_days`` when the caller knows the data is dense
    enough -- which prunes day partitions; the result is trimmed afterwards.
    """
    if lookback_days is None:
        lo = halo_start(prices, start, rows) or start
    else:
        lo = start - dt.timedelta(days=lookback_days)
    scoped = prices.filter(F.col("open_date").between(F.lit(lo), F.lit(end)))
    feats = price_features(scoped, rows=rows, block_rows=block_rows)
    return feats.filter(F.col("open_date") >= F.lit(start))


def series_tail(bars: DataFrame, rows: int = ROLLING_ROWS) -> DataFrame:
    """The last ``rows`` bars of each series. Planned as a partial limit before the
    shuffle: a map task forwards at most ``rows`` bars of a series."""
    w = Window.partitionBy(*SERIES_KEY).orderBy(F.col("open_time_utc").desc())
    return bars.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= rows).drop("_rn")


def features_after(
    bars: DataFrame, halo: DataFrame, start: dt.date, rows: int = ROLLING_ROWS, block_rows: int = DEFAULT_BLOCK_ROWS
) -> DataFrame:
    """Features of ``bars``, all from ``start`` on, given ``halo``: the last ``rows``
    bars of each series before that day. Nothing older is needed, so nothing older
    is read."""
    scoped = halo.select(*FACT_PRICES_COLUMNS).unionByName(bars.select(*FACT_PRICES_COLUMNS))
    return price_features(scoped, rows=rows, block_rows=block_rows).filter(F.col("open_date") >= F.lit(start))


# Columns fact_price_hourly carries from staging (all but the return), and
# its total order: open time, then load, then the values themselves, so
# identical copies of a row are adjacent.
_HOURLY_INPUT = [c for c in FACT_PRICE_HOURLY_COLUMNS if c != "return_1h"]
_HOURLY_ORDER = (
    "open_time_utc", "loaded_at", "batch_id", "close", "open", "high", "low",
    "volume", "quote_asset_volume", "number_of_trades",
)


def price_hourly(stg: DataFrame, block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """staging -> fact_price_hourly: previous close and 1h return per series,
    one output row per staging row.

    Reads staging (duplicate loads included, as the reference does). Exact
    copies of a row are first counted (a partial aggregate, so a bar with a
    huge number of copies is combined map-side); the lag runs over the
    distinct rows in the order open time, load time, batch, values. Each
    extra copy follows an identical copy, so its return is
    safe_divide(close - close, close); the copies are regenerated in chunks
    spread over tasks.
    """
    versions = stg.groupBy(*_HOURLY_INPUT).agg(F.count(F.lit(1)).alias("_copies"))

    def compute(df: DataFrame, w: Window) -> DataFrame:
        prev = F.lag("close").over(w)
        return df.withColumn("return_1h", safe_divide(F.col("close") - prev, prev))

    first = series_window(versions, compute, halo=1, order=_HOURLY_ORDER, block_rows=block_rows)
    extra = first.filter(F.col("_copies") > 1).drop("return_1h").withColumn("_copies", F.col("_copies") - 1)
    repeats = expand_copies(extra, "_copies").withColumn(
        "return_1h", safe_divide(F.col("close") - F.col("close"), "close")
    )
    return first.drop("_copies").select(*FACT_PRICE_HOURLY_COLUMNS).unionByName(
        repeats.select(*FACT_PRICE_HOURLY_COLUMNS)
    )


def dim_symbol(
    norm: DataFrame,
    asset_class: str = ASSET_CLASS,
    exchange: str = EXCHANGE,
    quote_currency: str = QUOTE_CURRENCY,
) -> DataFrame:
    """One row per symbol: constant attributes, first/last bar, bar count."""
    return norm.groupBy("symbol").agg(
        F.lit(asset_class).alias("asset_class"),
        F.lit(exchange).alias("exchange"),
        F.lit(quote_currency).alias("quote_currency"),
        F.min("open_time_utc").alias("first_seen_at"),
        F.max("open_time_utc").alias("last_seen_at"),
        F.count(F.lit(1)).alias("observed_bars"),
    )


def dim_calendar(norm: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """Every date from the first to the last bar date, with calendar parts.

    The bounds are one global aggregate (reads only ``open_date``); the dates
    are generated from that single row (``explode(sequence)``), so no join.
    Empty input or NULL bounds give no rows; start > end cannot occur.
    """
    today = F.lit(as_of) if as_of is not None else F.current_date()
    bounds = norm.agg(F.min("open_date").alias("lo"), F.max("open_date").alias("hi"))
    days = bounds.select(
        F.explode(
            F.when(F.col("lo") <= F.col("hi"), F.sequence("lo", "hi", F.expr("interval 1 day")))
        ).alias("calendar_date")
    )
    d = F.col("calendar_date")
    return days.select(
        d,
        F.year(d).cast("long").alias("calendar_year"),
        F.quarter(d).cast("long").alias("calendar_quarter"),
        F.month(d).cast("long").alias("calendar_month"),
        F.dayofmonth(d).cast("long").alias("calendar_day"),
        F.dayofweek(d).cast("long").alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        (d == today).alias("is_current_date"),
    )


__all__ = [
    "FACT_PRICE_HOURLY_COLUMNS",
    "SERIES_KEY",
    "dim_calendar",
    "dim_symbol",
    "fact_prices",
    "features_after",
    "features_for_range",
    "price_features",
    "price_hourly",
    "series_tail",
]
