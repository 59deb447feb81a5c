"""Plan-shape regressions: the properties that matter at scale, read from
the public ``explain()`` output."""

from __future__ import annotations

import contextlib
import datetime as dt
import io
import os

from pyspark.sql import functions as F

from candlewick.operators import serving, staging
from candlewick.plans import merge
from tests.helpers import bars


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def tree(df) -> list[str]:
    """Operator names of the physical plan, root first."""
    text = plan(df).split("\n\n")[0]
    return [line.strip(" +-:*").split(" (")[0] for line in text.splitlines()[1:] if line.strip()]


def test_dedup_limits_before_the_shuffle(g01):
    ops = tree(g01.norm)
    assert "WindowGroupLimit" in ops and "Exchange" in ops
    # a WindowGroupLimit (the partial one) sits below the exchange
    first_exchange = ops.index("Exchange")
    assert "WindowGroupLimit" in ops[first_exchange + 1 :]
    assert "Partial" in plan(g01.norm)


def test_reports_aggregate_map_side(g01):
    text = plan(serving.data_status(g01.features, dt.datetime(2024, 2, 3)))
    assert "partial_count" in text and "partial_min" in text
    text = plan(serving.daily_summary(g01.features))
    assert "partial_min_by" in text and "partial_max_by" in text


def test_series_filter_reaches_the_scan(g01):
    # on a stored feature table, as the build has it
    text = plan(serving.price_timeseries(g01.stored.tables["fact_price_features"]))
    scans = [line for line in text.splitlines() if line.strip().startswith("PushedFilters")]
    assert any("EqualTo(symbol,BTCUSDT)" in line for line in scans)


def test_merge_prunes_target_days(spark, tmp_root):
    path = os.path.join(tmp_root, "fact_prices")
    raw = bars(spark, dt.date(2024, 1, 1), 72)
    prices = staging.int_klines_normalized(staging.stg_klines(raw)).select(
        "symbol", "bar_interval", "open_time_utc", "open_date", "open", "high", "low", "close", "volume",
        "quote_asset_volume", "number_of_trades", "taker_buy_base_asset_volume",
        "taker_buy_quote_asset_volume", "loaded_at", "batch_id",
    )
    merge.merge_into(spark, path, prices)
    target = merge.read_fact_prices(spark, path)
    newest = merge.newest_bar(target)
    scoped = target.filter(F.col("open_date") >= F.lit(newest.date()))
    assert "PartitionFilters: [isnotnull(open_date" in plan(scoped)


def test_merge_source_reads_only_new_days_of_the_raw_table(spark, g01):
    """The day bound passes below the dedup to the raw table's partitions."""
    prices = merge.incremental_filter(g01.prices, g01.prices, newest=dt.datetime(2024, 1, 20, 5))
    filters = [line for line in plan(prices).splitlines() if "PartitionFilters" in line]
    assert filters and all("open_date" in line and "2024-01-20" in line for line in filters)


def test_incremental_run_reads_from_the_lowest_start(spark, tmp_root):
    from candlewick.plans import ingest
    from candlewick.sources import raw as raw_src

    ingest.write_partitions(bars(spark, dt.date(2024, 1, 1), 24 * 20), tmp_root)
    landed = raw_src.scan_raw(spark, tmp_root)
    marks = ingest.high_water_marks(landed.filter(F.col("date") < F.lit(dt.date(2024, 1, 18))))
    rows = ingest.incremental_rows(landed, marks, dt.date(2024, 1, 1), dt.date(2024, 1, 20))
    filters = [line for line in plan(rows).splitlines() if "PartitionFilters" in line]
    assert any("2024-01-18" in line for line in filters) and not any("2024-01-01" in line for line in filters)
    assert rows.count() == 72


def test_no_window_over_rows_is_keyed_by_series_alone(g01):
    from candlewick.operators import marts

    text = plan(marts.price_features(g01.stored.tables["fact_prices"], block_rows=200))
    specs = [line for line in text.splitlines() if "windowspecdefinition(symbol" in line]
    assert specs and all("_block" in line for line in specs)


def test_day_tables_are_rebalanced(g01):
    df = g01.prices.hint("rebalance", "open_date")
    assert "REBALANCE_PARTITIONS_BY_COL" in plan(df)


def test_feature_windows_share_one_sort(g01):
    from candlewick.operators import marts

    ops = tree(marts.price_features(g01.prices))
    top = ops[: ops.index("Exchange") + 1]  # everything above the block shuffle
    assert top.count("Window") == 2 and top.count("Sort") == 1


def test_raw_zone_predicates_prune_directories(spark, tmp_root):
    from candlewick.plans import ingest
    from candlewick.sources import raw as raw_src

    ingest.write_partitions(bars(spark, dt.date(2024, 1, 1), 48), tmp_root)
    scoped = raw_src.scan_raw(spark, tmp_root).filter(
        (F.col("symbol") == "BTCUSDT") & (F.col("date") == F.lit(dt.date(2024, 1, 2)))
    )
    filters = [line for line in plan(scoped).splitlines() if "PartitionFilters" in line]
    assert any("symbol" in line and "date" in line for line in filters)
    assert scoped.count() == 24
