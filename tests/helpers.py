"""Small synthetic bar sets for unit tests of writers and state (the
registered queries use the driver's tables instead)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.functions import day_start_ms
from candlewick.sources.payload import enrich_raw

HOUR = 3_600_000


def bars(
    spark: SparkSession,
    start: dt.date,
    hours: int,
    symbol: str = "BTCUSDT",
    skip_days: tuple[dt.date, ...] = (),
    loaded_at: dt.datetime = dt.datetime(2024, 2, 1),
    batch_id: str = "t-001",
    price: float = 100.0,
) -> DataFrame:
    """``hours`` consecutive 1h bars from ``start`` 00:00 UTC (minus skipped
    days), as 19-column raw records."""
    t0 = day_start_ms(start)
    df = spark.range(hours).select(
        (F.lit(t0) + F.col("id") * HOUR).alias("open_time_ms"),
        (F.lit(price) + F.col("id")).cast("double").alias("open"),
        (F.lit(price) + F.col("id") + 2).cast("double").alias("high"),
        (F.lit(price) + F.col("id") - 1).cast("double").alias("low"),
        (F.lit(price) + F.col("id") + 1).cast("double").alias("close"),
        (F.col("id") % 7 + 1).cast("double").alias("volume"),
        (F.lit(t0) + F.col("id") * HOUR + HOUR - 1).alias("close_time_ms"),
        F.lit(10.0).alias("quote_asset_volume"),
        F.lit(3).cast("long").alias("number_of_trades"),
        F.lit(1.0).alias("taker_buy_base_asset_volume"),
        F.lit(5.0).alias("taker_buy_quote_asset_volume"),
    )
    if skip_days:
        day = F.to_date(F.timestamp_millis("open_time_ms"))
        df = df.filter(~day.isin(list(skip_days)))
    return enrich_raw(
        df.withColumns({"symbol": F.lit(symbol), "interval": F.lit("1h")}),
        source="binance_spot",
        dataset="klines",
        loaded_at=loaded_at,
        batch_id=batch_id,
    )
