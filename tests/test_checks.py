"""Data-quality checks find what the tampered fixtures break (B2, B3), pass on
clean data, and the suite summary covers all 87 tests."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from candlewick.operators import checks, validate
from candlewick.plans.suite import default_suite, models_of
from candlewick.schema import RAW_KLINES, STG_COLUMNS

SYMBOLS = ["BTCUSDT", "ETHUSDT", "SOLUSDT", "BNBUSDT", "XRPUSDT"]


def test_dirty_bars(g01):
    d = g01.dirty
    assert checks.check_relationships(d, "symbol", g01.dim_symbol, "symbol").count() == 40
    assert checks.check_ohlc_consistency(d).count() == 37
    assert checks.check_no_negative_volume(d).count() == 38
    nn = {r["column_name"]: r["violations"] for r in checks.check_not_null(d, STG_COLUMNS).collect()}
    assert nn == {"close": 39}
    assert checks.check_unique_natural_key(d).count() == 9
    acc = checks.check_accepted_values(d, "symbol", SYMBOLS).collect()
    assert [(r["value_field"], r["n_records"]) for r in acc] == [("UNKNOWN", 40)]


def test_clean_bars_pass(g01):
    assert checks.check_relationships(g01.prices, "symbol", g01.dim_symbol, "symbol").count() == 0
    assert checks.check_relationships(g01.prices, "open_date", g01.dim_calendar(), "calendar_date").count() == 0
    assert checks.check_not_null(g01.norm, STG_COLUMNS).count() == 0
    assert checks.check_unique_natural_key(g01.norm).count() == 0


def test_staging_duplicates_reported(g01):
    """1,642 natural keys occur twice in raw_klines at sf0.01."""
    dups = checks.check_unique_natural_key(g01.stg)
    assert dups.count() == 1642
    assert dups.agg(F.max("row_count")).first()[0] == 2


def test_tampered_features(g01):
    t = g01.features_tampered
    assert checks.check_first_return_null(t).count() == 5
    assert checks.check_log_return_consistency(t).count() == 1685
    assert checks.check_valid_ranges(t).count() == 706


def test_ohlc_check_skips_null_inputs(spark):
    df = spark.createDataFrame(
        [(1.0, 0.5, 0.4, None), (1.0, 0.5, 0.4, 0.9), (1.0, 2.0, 0.5, 1.5)],
        "open double, high double, low double, close double",
    )
    assert checks.check_ohlc_consistency(df).count() == 1


def test_source_freshness_levels(g01):
    raw = g01.raw  # newest load 2024-02-02 00:00
    status = lambda as_of: checks.source_freshness(raw, as_of).first()["status"]
    assert status(dt.datetime(2024, 2, 3)) == "pass"
    assert status(dt.datetime(2024, 2, 9, 0, 0, 1)) == "warn"
    assert status(dt.datetime(2024, 3, 4)) == "error"


def test_required_columns(g01, spark):
    req = {r["column_name"]: (r["type_ok"], r["null_count"]) for r in validate.check_required(g01.raw).collect()}
    assert len(req) == 19 and all(v == (True, 0) for v in req.values())
    broken = g01.raw.drop("batch_id").withColumn("volume", F.col("volume").cast("string"))
    req = {r["column_name"]: (r["type_ok"], r["null_count"]) for r in validate.check_required(broken, RAW_KLINES).collect()}
    assert req["batch_id"] == (False, None) and req["volume"][0] is False


def test_suite_summary(g01):
    suite = default_suite(symbols=SYMBOLS)
    assert len(suite) == 87
    summary = checks.run_checks(models_of(g01, dt.date(2024, 1, 15)), suite)
    rows = summary.collect()
    assert len(rows) == 87
    failed = {(r["model"], r["check_name"], r["column_name"]): r["violations"] for r in rows if r["status"] == "fail"}
    key = "symbol,bar_interval,open_time_utc"
    assert failed == {
        ("stg_klines", "unique", "open_time_ms"): 1642,
        ("stg_klines", "unique", "open_time_utc"): 1642,
        ("stg_klines", "unique_natural_key", key): 1642,
        ("fact_prices", "no_hourly_gaps", "open_time_utc"): 198,
    }


def test_duplicate_counts_several_key_sets(spark):
    rows = [("a", 1, "x")] * 500 + [("a", 2, "x"), ("b", 1, None), ("b", 1, None), (None, 3, "y"), (None, 3, "y")]
    df = spark.createDataFrame(rows, "k string, t int, v string")
    out = checks.duplicate_counts(df, [("k", "t"), ("k",), ("v",), ("t", "v")]).first()
    # (k, t): (a,1) and (b,1) repeat; NULL k never judged
    # (k,): a and b; (v,): x and y; (t, v): (1, x) and (3, y) -- (1, NULL) not judged
    assert (out["d0"], out["d1"], out["d2"], out["d3"]) == (2, 2, 2, 2)
    assert checks.check_unique(df, ["k", "t"]).count() == out["d0"]


def test_missing_reference_counts(spark):
    child = spark.createDataFrame(
        [("a", 1)] * 300 + [("b", 2), ("z", 1), (None, 9), ("z", None)], "sym string, day int"
    )
    syms = spark.createDataFrame([("a",), ("a",), ("b",)], "symbol string")  # duplicate parent key
    days = spark.createDataFrame([(1,), (2,)], "d int")
    out = checks.missing_reference_counts(child, [("sym", syms, "symbol"), ("day", days, "d")]).first()
    assert (out["r0"], out["r1"]) == (2, 1)  # two 'z' rows; one day 9; NULLs never judged
    assert checks.check_relationships(child, "sym", syms, "symbol").count() == out["r0"]


def test_gaps_from_islands_equal_the_window_form(spark, g01):
    want = sorted(checks.check_no_gaps(g01.prices, block_rows=200).collect())
    islands = checks.day_islands(g01.prices)
    assert sorted(checks.check_no_gaps_of(islands, block_rows=50).collect()) == want and len(want) == 198
    assert islands.agg({"bars": "sum"}).first()[0] == g01.prices.count()
    assert checks.check_no_gaps_of(checks.day_islands(g01.prices.limit(0))).count() == 0
