"""Incremental merge (K6), full refresh (K7) and the recovery story."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from candlewick.operators import checks, marts, staging
from candlewick.plans import merge
from tests.helpers import bars


def _target(g):
    return marts.fact_prices(
        g.stg.filter((F.col("batch_id") == "batch-001") & (F.col("open_time_utc") < F.lit("2024-01-20").cast("timestamp")))
    )


def test_fixture_merge_counts(g01):
    """B5: 2,073 target rows, 1,255 source rows, 4 updates -> 3,324 rows; the
    61 older bars appear only after a full refresh (3,385)."""
    target = _target(g01)
    source = merge.incremental_filter(g01.prices, target)
    assert target.count() == 2073 and source.count() == 1255
    keys = ["symbol", "bar_interval", "open_time_utc"]
    assert source.join(target, keys, "left_semi").count() == 4
    merged = merge.merge_rows(target, source)
    assert merged.count() == 3324
    skipped = g01.prices.join(merged, keys, "left_anti")
    assert skipped.count() == 61
    assert merge.merge_rows(target, g01.prices, full_refresh=True).count() == 3385
    # updated rows carry the source version
    upd = merged.join(source.select(*keys), keys, "left_semi")
    assert upd.filter(F.col("batch_id") == "batch-002").count() == upd.count()


def test_merge_is_idempotent(g01):
    target = _target(g01)
    once = merge.merge_rows(target, merge.incremental_filter(g01.prices, target))
    twice = merge.merge_rows(once, merge.incremental_filter(g01.prices, once))
    assert once.exceptAll(twice).count() == 0 and twice.exceptAll(once).count() == 0


def test_per_symbol_filter_takes_new_symbol_history(spark):
    old = marts.fact_prices(staging.stg_klines(bars(spark, dt.date(2024, 1, 1), 48)))
    new_sym = marts.fact_prices(staging.stg_klines(bars(spark, dt.date(2024, 1, 1), 24, symbol="ETHUSDT")))
    src = old.unionByName(new_sym)
    assert merge.incremental_filter(src, old).filter(F.col("symbol") == "ETHUSDT").count() == 0
    assert merge.incremental_filter(src, old, per_symbol=True).filter(F.col("symbol") == "ETHUSDT").count() == 24


def _build(spark, raw):
    return marts.fact_prices(staging.int_klines_normalized(staging.stg_klines(raw)))


def test_schema_drift_and_duplicate_keys_fail(spark, tmp_root):
    path = os.path.join(tmp_root, "fact_prices")
    raw = bars(spark, dt.date(2024, 1, 1), 24)
    merge.merge_into(spark, path, _build(spark, raw))
    drifted = _build(spark, raw).withColumn("volume", F.col("volume").cast("float"))
    with pytest.raises(merge.SchemaDriftError):
        merge.assert_same_schema(merge.read_fact_prices(spark, path), drifted)
    with pytest.raises(merge.SchemaDriftError, match="added"):
        merge.merge_into(spark, path, _build(spark, raw).withColumn("extra", F.lit(1)))
    dup = _build(spark, raw)
    dup = dup.unionByName(dup.filter(F.col("open_time_utc") == F.lit("2024-01-01 23:00:00").cast("timestamp")))
    with pytest.raises(ValueError):
        merge.merge_into(spark, path, dup)


def test_recovery_story(spark, tmp_root):
    """Day 7 is loaded before day 6: the gap check fails, the incremental
    merge cannot repair it (day 6 is older than the newest bar), a full
    refresh does: 168 rows, no gaps."""
    path = os.path.join(tmp_root, "fact_prices")
    d = dt.date(2024, 1, 1)
    days_1_5 = bars(spark, d, 24 * 5)
    day_6 = bars(spark, d + dt.timedelta(days=5), 24, batch_id="t-006", price=300.0)
    day_7 = bars(spark, d + dt.timedelta(days=6), 24, batch_id="t-007", price=400.0)

    merge.merge_into(spark, path, _build(spark, days_1_5))
    assert merge.read_fact_prices(spark, path).count() == 120

    merge.merge_into(spark, path, _build(spark, days_1_5.unionByName(day_7)))
    fact = merge.read_fact_prices(spark, path)
    assert fact.count() == 144
    assert checks.check_no_gaps(fact).count() == 1

    all_raw = days_1_5.unionByName(day_7).unionByName(day_6)
    merge.merge_into(spark, path, _build(spark, all_raw))
    fact = merge.read_fact_prices(spark, path)
    assert fact.count() == 144  # day 6 skipped by the inclusive max filter
    assert checks.check_no_gaps(fact).count() == 1

    merge.merge_into(spark, path, _build(spark, all_raw), full_refresh=True)
    fact = merge.read_fact_prices(spark, path)
    assert fact.count() == 168
    assert checks.check_no_gaps(fact).count() == 0
    feats = marts.price_features(fact)
    assert feats.filter(F.col("rolling_window_observations_24h") == 24).count() == 168 - 23


def test_merge_rewrites_only_touched_days(spark, tmp_root):
    path = os.path.join(tmp_root, "fact_prices")
    d = dt.date(2024, 1, 1)
    merge.merge_into(spark, path, _build(spark, bars(spark, d, 48)))
    table, day1 = merge.fact_table(spark, path), "open_date=2024-01-01"
    before = table.commit().parts[day1]
    later = bars(spark, d + dt.timedelta(days=1), 48, batch_id="t-002")  # days 2, 3
    merge.merge_into(spark, path, _build(spark, later))
    assert table.commit().parts[day1] == before  # untouched day keeps its files
    assert table.commit().parts["open_date=2024-01-02"]["commit"] != before["commit"]
    fact = merge.read_fact_prices(spark, path)
    assert fact.count() == 72
    # only bars at/after the target's newest bar (day 2, 23:00) are merged
    by_day = {
        (r["open_date"], r["batch_id"]): r["n"]
        for r in fact.groupBy("open_date", "batch_id").agg(F.count("*").alias("n")).collect()
    }
    d2, d3 = d + dt.timedelta(days=1), d + dt.timedelta(days=2)
    assert by_day == {(d, "t-001"): 24, (d2, "t-001"): 23, (d2, "t-002"): 1, (d3, "t-002"): 24}


def test_two_runs_on_a_uri_lose_nothing(spark, tmp_root):
    """Whether a table is there is asked of the path's own file system."""
    path = f"file://{tmp_root}/fact_prices"
    d = dt.date(2024, 1, 1)
    assert merge.merge_into(spark, path, _build(spark, bars(spark, d, 120)))["mode"] == "full_refresh"
    info = merge.merge_into(spark, path, _build(spark, bars(spark, d + dt.timedelta(days=5), 120)))
    assert (info["mode"], info["first_day"]) == ("merge", d + dt.timedelta(days=5))
    assert merge.read_fact_prices(spark, path).count() == 240


def test_empty_target_takes_everything(spark):
    prices = _build(spark, bars(spark, dt.date(2024, 1, 1), 30))
    assert merge.newest_bar(prices.limit(0)) == dt.datetime(1900, 1, 1)
    assert merge.incremental_filter(prices, prices.limit(0)).count() == 30


def test_a_write_that_was_cut_off_is_no_table(spark, tmp_root):
    from candlewick.session import table_exists

    os.makedirs(os.path.join(tmp_root, "t", "_temporary", "0"))
    assert not table_exists(spark, os.path.join(tmp_root, "t"))
    assert not table_exists(spark, os.path.join(tmp_root, "absent"))


def test_scratch_needs_a_shared_folder_off_local_mode(spark, monkeypatch):
    from candlewick import session

    class Elsewhere:
        def __init__(self):
            self.conf = type("C", (), {"get": staticmethod(lambda k, d=None: None)})
            self.sparkContext = type("S", (), {"master": "spark://m:7077", "getCheckpointDir": staticmethod(lambda: None)})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Elsewhere())
