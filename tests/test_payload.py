"""Payload parsing (S1-S3) and row validation (V1-V3)."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from candlewick.operators.validate import validate_rows
from candlewick.schema import RAW_COLUMNS
from candlewick.sources import fixtures
from candlewick.sources.payload import enrich_raw, parse_klines

# open time 2024-01-01 00:00 UTC, then prices, volumes and counts of our own
SAMPLE = [
    1704067200000,
    "101.25",
    "109.5",
    "98.75",
    "104.0",
    "640.125",
    1704070799999,
    "66573.0",
    417,
    "320.5",
    "33332.0",
    "0",
]


def _payloads(spark, *rows_lists):
    return spark.createDataFrame(
        [("BTCUSDT", "1h", json.dumps(rows)) for rows in rows_lists], "symbol string, interval string, payload string"
    )


def test_parse_sample_row(spark):
    rows, rejects = parse_klines(_payloads(spark, [SAMPLE]))
    r = rows.collect()
    assert rejects.count() == 0
    assert len(r) == 1
    r = r[0]
    assert r.open_time_ms == 1704067200000
    assert r.open == 101.25
    assert r.high == 109.5
    assert r.close_time_ms == 1704070799999
    assert r.number_of_trades == 417
    assert r.taker_buy_quote_asset_volume == 33332.0
    assert r.symbol == "BTCUSDT" and r.row_index == 0


def test_short_row_and_bad_number_rejected_extra_ignored(spark):
    short = SAMPLE[:10]
    bad = list(SAMPLE)
    bad[1] = "abc"
    extra = SAMPLE + ["more", "fields"]
    rows, rejects = parse_klines(_payloads(spark, [short, bad, extra]))
    assert rows.count() == 1
    reasons = sorted(r.reason for r in rejects.collect())
    assert reasons == ["open is not a number", "row has 10 fields, 11 are needed"]


def test_not_an_array_payload(spark):
    df = spark.createDataFrame([("BTCUSDT", "1h", '{"code": -1121}')], "symbol string, interval string, payload string")
    rows, rejects = parse_klines(df)
    assert rows.count() == 0
    assert [r.reason for r in rejects.collect()] == ["payload is not a JSON array of arrays"]


def test_enrich_to_raw_record(spark):
    rows, _ = parse_klines(_payloads(spark, [SAMPLE]))
    loaded = dt.datetime(2024, 1, 2, 3, 4, 5)
    raw = enrich_raw(rows, source="binance_spot", dataset="klines", loaded_at=loaded, batch_id="b1")
    assert raw.columns == RAW_COLUMNS
    r = raw.collect()[0]
    assert r.open_time_utc == dt.datetime(2024, 1, 1, 0, 0)
    assert r.close_time_utc == dt.datetime(2024, 1, 1, 0, 59, 59, 999000)
    assert (r.source, r.dataset, r.symbol, r.interval, r.batch_id) == ("binance_spot", "klines", "BTCUSDT", "1h", "b1")
    assert r.loaded_at == loaded


def test_default_batch_id_is_one_per_write(spark):
    rows, _ = parse_klines(_payloads(spark, [SAMPLE, [SAMPLE[0] + 3600000] + SAMPLE[1:6] + [SAMPLE[6] + 3600000] + SAMPLE[7:]]))
    raw = enrich_raw(rows, source="s", dataset="d")
    assert raw.select("batch_id").distinct().count() == 1


def test_inconsistent_ohlc_rejected(spark):
    bad = list(SAMPLE)
    bad[2] = "100.5"  # below open and close
    rows, _ = parse_klines(_payloads(spark, [SAMPLE, bad]))
    ok, rejects = validate_rows(rows)
    assert ok.count() == 1
    assert [r.reason for r in rejects.collect()] == ["high is below open or close"]
    with pytest.raises(ValueError):
        validate_rows(rows, strict=True)


def test_bounds_and_close_time(spark):
    df = spark.createDataFrame(
        [(1, 0.0, 1.0, 0.5, 1.0, -1.0, 1, 0.0, 0, 0.0, 0.0)],
        "open_time_ms long, open double, high double, low double, close double, volume double, "
        "close_time_ms long, quote_asset_volume double, number_of_trades long, "
        "taker_buy_base_asset_volume double, taker_buy_quote_asset_volume double",
    )
    _, rejects = validate_rows(df)
    reasons = {r.reason for r in rejects.collect()}
    assert "open must be > 0" in reasons
    assert "volume must be >= 0" in reasons
    assert "bar closes before it opens" in reasons
    assert "low is above open or close" in reasons


def test_fixture_payload_round_trip(spark, g01):
    """B6: 151 payload strings, 3,387 exploded rows, 3,385 valid, equal to the
    landed bars of both batches."""
    p = g01.payloads
    assert p.count() == 151
    rows, rejects = parse_klines(p)
    assert rows.count() == 3385
    assert rejects.count() == 2
    src = fixtures.landed_bars(g01.raw).select("symbol", "open_time_ms", "open", "close")
    got = rows.select("symbol", "open_time_ms", "open", "close")
    assert got.exceptAll(src).count() == 0 and src.exceptAll(got).count() == 0


def test_nan_price_rejected(spark):
    bad = list(SAMPLE)
    bad[4] = "NaN"
    rows, rejects = parse_klines(_payloads(spark, [bad]))
    assert rejects.count() == 0  # it is a number to the parser ...
    _, bad_rows = validate_rows(rows)
    assert "close is missing or not a number" in {r.reason for r in bad_rows.collect()}  # ... but not a price
