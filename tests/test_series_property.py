"""Property: blocked series windows equal whole-series windows for any mix of
series lengths, gaps and block sizes."""

from __future__ import annotations

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from candlewick.functions import day_start_ms
from candlewick.operators import marts
from tests.test_models import plain_features

HOUR = 3_600_000


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    series=st.lists(
        st.tuples(st.integers(1, 90), st.integers(1, 30)),  # (bars, max gap in hours)
        min_size=1,
        max_size=3,
    ),
    block_rows=st.integers(24, 60),
    seed=st.integers(0, 1000),
)
def test_blocked_equals_plain(spark, series, block_rows, seed):
    t0 = day_start_ms(dt.date(2024, 1, 1))
    parts = []
    for k, (n, gap) in enumerate(series):
        step = F.lit(1) + (F.abs(F.xxhash64(F.col("id"), F.lit(seed + k))) % gap)
        df = spark.range(n).select(
            F.lit(f"S{k}").alias("symbol"),
            F.lit("1h").alias("bar_interval"),
            (F.lit(t0) + F.sum(step).over(_w()) * HOUR).alias("ms"),
            (F.lit(100.0) + F.col("id") % 7).alias("close"),
            (F.lit(1.0) + F.col("id") % 5).alias("volume"),
        )
        parts.append(df)
    bars = parts[0]
    for p in parts[1:]:
        bars = bars.unionByName(p)
    prices = bars.select(
        "symbol",
        "bar_interval",
        F.timestamp_millis("ms").alias("open_time_utc"),
        F.to_date(F.timestamp_millis("ms")).alias("open_date"),
        (F.col("close") - 1).alias("open"),
        (F.col("close") + 2).alias("high"),
        (F.col("close") - 3).alias("low"),
        "close",
        "volume",
        F.lit(1.0).alias("quote_asset_volume"),
        F.lit(1).cast("long").alias("number_of_trades"),
        F.lit(0.5).alias("taker_buy_base_asset_volume"),
        F.lit(0.5).alias("taker_buy_quote_asset_volume"),
        F.lit("2024-02-01").cast("timestamp").alias("loaded_at"),
        F.lit("b").alias("batch_id"),
    )
    plain = plain_features(prices)
    blocked = marts.price_features(prices, block_rows=block_rows)
    assert plain.exceptAll(blocked).count() == 0 and blocked.exceptAll(plain).count() == 0


def _w():
    from pyspark.sql import Window

    return Window.orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
