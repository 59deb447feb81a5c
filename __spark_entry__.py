"""

Every query reads the driver's tables (``events`` is the trade tape the bars
are built from, see FIXTURES.md) over their whole extent. Derived doubles are
rounded to 6 decimals here and in the oracle SQL so the two engines' last-bit
differences do not show; the library itself never rounds.
"""

from __future__ import annotations

import datetime as dt
import importlib
import os
import sys
from collections.abc import Callable

_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from pyspark.sql import DataFrame, SparkSession, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from candlewick.operators import checks, marts, serving, validate  # noqa: E402
from candlewick.plans import build, ingest, merge  # noqa: E402
from candlewick.plans.models import FixtureGraph  # noqa: E402
from candlewick.plans.suite import default_suite  # noqa: E402
from candlewick.sources import fixtures, payload, raw as raw_src  # noqa: E402
from candlewick.session import scratch_path, table_exists  # noqa: E402
from candlewick.streaming import incremental  # noqa: E402
import candlewick_oracle_sql as _oracle  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"

# Fixed clocks of the registered queries (the reference reads the wall clock).
AS_OF = dt.datetime(2024, 2, 3, 0, 0, 0)
USAGE_AS_OF = dt.datetime(2024, 1, 31, 0, 0, 0)
CALENDAR_TODAY = dt.date(2024, 1, 15)
MERGE_TARGET_BEFORE = "2024-01-20 00:00:00"
BACKFILL_START, BACKFILL_END = dt.date(2024, 1, 5), dt.date(2024, 1, 10)
INCREMENTAL_BOOTSTRAP, INCREMENTAL_END = dt.date(2024, 1, 1), dt.date(2024, 1, 20)
LOADED_AT = dt.datetime(2024, 2, 1, 0, 0, 0)
SHORT_CALENDAR_END = dt.date(2024, 1, 25)
BLOCK_ROWS = 200


def _round(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column (for cross-engine comparison only)."""
    return df.selectExpr(
        *[
            f"round(`{f.name}`, {digits}) AS `{f.name}`" if isinstance(f.dataType, T.DoubleType) else f"`{f.name}`"
            for f in df.schema.fields
        ]
    )


_GRAPHS: dict[tuple[int, str], FixtureGraph] = {}


def _g(spark: SparkSession, sf_dir: str) -> FixtureGraph:
    """One model graph per (session, scale): the raw table is loaded once and
    the DataFrames of the shared models are reused by every query."""
    key = (id(spark), sf_dir)
    g = _GRAPHS.get(key)
    gone = g is not None and not table_exists(spark, g.raw_path)
    if g is None or gone or g.spark is not spark or spark.sparkContext._jsc is None:
        # small blocks, so that series are split at every scale
        g = _GRAPHS[key] = FixtureGraph(spark, sf_dir, as_of=AS_OF, block_rows=BLOCK_ROWS)
    return g


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: fact_price_features over the sf0.001 tables."""
    return _round(_g(spark, SMOKE_DIR).features)


# --- helpers for the ingest-side queries -----------------------------------

def _parsed(g: FixtureGraph) -> DataFrame:
    rows, _ = payload.parse_klines(g.payloads)
    return rows


def _enriched(g: FixtureGraph) -> DataFrame:
    return payload.enrich_raw(_parsed(g), loaded_at=LOADED_AT, batch_id=fixtures.BATCH_1[0])


def _backfill(g: FixtureGraph) -> DataFrame:
    """Prune landed payloads to the range's days, parse, then apply the exact
    millisecond bounds."""
    days = ingest.landed_range(g.payloads, BACKFILL_START, BACKFILL_END)
    rows, _ = payload.parse_klines(days)
    enriched = payload.enrich_raw(rows, loaded_at=LOADED_AT, batch_id=fixtures.BATCH_1[0])
    return ingest.backfill_rows(enriched, BACKFILL_START, BACKFILL_END)


def _landed_with_dates(g: FixtureGraph) -> DataFrame:
    """raw bars filed by day; batch-002 files each bar under the date of the
    previous hour (hour-0 bars land in the wrong day)."""
    shifted = F.when(
        F.col("batch_id") == fixtures.BATCH_2[0],
        F.to_date(F.col("open_time_utc") - F.expr("interval 1 hour")),
    ).otherwise(F.to_date("open_time_utc"))
    return g.raw.withColumn("date", shifted)


def _marks_before(g: FixtureGraph) -> DataFrame:
    """State as if BTCUSDT and ETHUSDT had been loaded up to 2024-01-10."""
    done = _enriched(g).filter(
        F.col("symbol").isin("BTCUSDT", "ETHUSDT") & (F.col("open_time_utc") < F.lit("2024-01-10 12:00:00").cast("timestamp"))
    )
    return ingest.high_water_marks(done, updated_at=LOADED_AT)


def _scan_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = _g(spark, sf_dir)
    root = scratch_path(spark, "raw-zone")
    ingest.write_partitions(_enriched(g), root)
    return raw_src.scan_raw(spark, root)


def _merge_target(g: FixtureGraph) -> DataFrame:
    """Target = batch-001 bars (one version per key within a batch) before
    2024-01-20, as loaded by an earlier build."""
    return marts.fact_prices(
        g.stg.filter(
            (F.col("batch_id") == fixtures.BATCH_1[0])
            & (F.col("open_time_utc") < F.lit(MERGE_TARGET_BEFORE).cast("timestamp"))
        )
    )


def _merged(spark: SparkSession, sf_dir: str, full_refresh: bool = False) -> DataFrame:
    """On disk: the target is written, merged into, and read back."""
    g = _g(spark, sf_dir)
    path = scratch_path(spark, "fact_prices")
    merge.merge_into(spark, path, _merge_target(g))
    merge.merge_into(spark, path, g.prices, full_refresh=full_refresh)
    return merge.read_fact_prices(spark, path)


def _merged_into_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = _g(spark, sf_dir)
    empty = _merge_target(g).limit(0)
    return merge.merge_rows(empty, merge.incremental_filter(g.prices, empty))


def _incremental_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs, to 10 and to 20 January, over a raw zone that already holds a
    later day; marks as read back after the second. Bars that break a row rule (a
    price of 0) are filed as rejects of their run and move no mark."""
    rows = ingest.with_date(_enriched(_g(spark, sf_dir)))
    root, state, rejects = (scratch_path(spark, n) for n in ("raw-zone", "marks", "rejects"))
    ingest.write_partitions(rows.filter(F.col("date") == F.lit(dt.date(2024, 1, 25))), root)
    ingest.run_incremental(rows, root, state, INCREMENTAL_BOOTSTRAP, BACKFILL_END, rejects_path=rejects, run_id="first")
    result = ingest.run_incremental(
        rows, root, state, INCREMENTAL_BOOTSTRAP, INCREMENTAL_END, rejects_path=rejects, run_id="second"
    )
    return result.marks_after.drop("updated_at")


def _marks_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "marks")
    ingest.write_marks(ingest.high_water_marks(_enriched(_g(spark, sf_dir)), updated_at=LOADED_AT), path)
    return ingest.read_marks(spark, path)


def _stream_two_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each day's bars land in two files of two micro-batches."""
    raw = _g(spark, sf_dir).raw
    root, state = scratch_path(spark, "raw-zone"), scratch_path(spark, "marks")
    morning = F.hour("open_time_utc") < 12
    for n, part in enumerate((raw.filter(morning), raw.filter(~morning))):
        incremental.process_batch(fixtures.payloads(part), root, state, f"stream-{n:06d}", LOADED_AT)
    return raw_src.scan_raw(spark, root).select(
        "symbol", "interval", "open_time_ms", "open", "high", "low", "close", "volume", "number_of_trades", "date"
    )


def _damaged(g: FixtureGraph) -> DataFrame:
    """Landed bars with three independent kinds of damage (hours since the epoch:
    high halved below low every 97th, close lost every 83rd, volume -1 every 89th)."""
    h = F.expr("open_time_ms div 3600000")
    return _enriched(g).withColumns({
        "high": F.when(h % 97 == 0, F.col("low") * 0.5).otherwise(F.col("high")),
        "close": F.when(h % 83 == 0, F.lit(None).cast("double")).otherwise(F.col("close")),
        "volume": F.when(h % 89 == 0, F.lit(-1.0)).otherwise(F.col("volume")),
    })


def _ingested(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Raw zone and rejects after a backfill of the whole range and an incremental run
    over it, both from damaged bars."""
    root, state, rejects = (scratch_path(spark, n) for n in ("raw-zone", "marks", "rejects"))
    damaged = _damaged(_g(spark, sf_dir))
    ingest.run_backfill(damaged, root, INCREMENTAL_BOOTSTRAP, BACKFILL_END, rejects, "backfill")
    ingest.run_incremental(
        ingest.with_date(damaged), root, state, BACKFILL_END + dt.timedelta(days=1), INCREMENTAL_END,
        rejects_path=rejects, run_id="incremental",
    )
    return root, rejects


def _ingest_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.read_rejects(spark, _ingested(spark, sf_dir)[1]).drop("source", "dataset")


def _ingest_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_src.scan_raw(spark, _ingested(spark, sf_dir)[0]).select(
        "symbol", "interval", "open_time_ms", "open", "high", "low", "close", "volume", "date"
    )


def _incremental_build(spark: SparkSession, sf_dir: str) -> build.Build:
    """A build of the bars before 20 January, then one of all bars that refreshes stale
    days only, from the tail, the partials and the islands of the first."""
    g = _g(spark, sf_dir)
    root = scratch_path(spark, "marts-incremental")
    early = g.raw.filter(F.col("open_time_utc") < F.lit(MERGE_TARGET_BEFORE).cast("timestamp"))
    early = early.filter(F.col("batch_id") == fixtures.BATCH_1[0])
    build.build_marts(spark, early, root, as_of=AS_OF, block_rows=BLOCK_ROWS)
    return build.build_marts(spark, g.raw, root, as_of=AS_OF, block_rows=BLOCK_ROWS, incremental_features=True)


def _coverage_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report's own order, as positions (ids of a sorted result ascend)."""
    report = serving.coverage_by_day(_g(spark, sf_dir).prices).withColumn("_id", F.monotonically_increasing_id())
    # one row a series and day
    position = F.row_number().over(Window.orderBy("_id")).cast("long")
    return report.select(position.alias("position"), "symbol", "bar_interval", "open_date", "bars_count")


def _check_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The data tests over the stored tables of the build."""
    g = _g(spark, sf_dir)
    return checks.run_checks(
        {**g.stored.tables, "dim_calendar": g.dim_calendar(CALENDAR_TODAY)},
        default_suite(symbols=_oracle.SYMBOLS, block_rows=g.block_rows),
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    q: dict[str, Callable[[SparkSession, str], DataFrame]] = {
        # sources
        "parse_kline_payload": lambda s, d: _round(_parsed(_g(s, d))),
        "enrich_raw": lambda s, d: _round(_enriched(_g(s, d))),
        "scan_raw": lambda s, d: _round(_scan_raw(s, d)),
        # ingest
        "ingest_summary": lambda s, d: ingest.write_summary(_enriched(_g(s, d))),
        "backfill_range": lambda s, d: _round(_backfill(_g(s, d))),
        "incremental_range": lambda s, d: _round(
            ingest.incremental_rows(
                _enriched(_g(s, d)), _marks_before(_g(s, d)), INCREMENTAL_BOOTSTRAP, INCREMENTAL_END
            )
        ),
        "high_water_mark": lambda s, d: ingest.high_water_marks(_enriched(_g(s, d)), updated_at=LOADED_AT),
        # row / partition validation
        "validate_rows": lambda s, d: validate.validate_rows(_g(s, d).dirty)[1].select(
            "symbol", "bar_interval", "open_time_ms", "reason"
        ),
        "validate_partition_duplicates": lambda s, d: validate.partition_duplicates(_landed_with_dates(_g(s, d))),
        "validate_partition_date": lambda s, d: validate.partition_date_mismatch(_landed_with_dates(_g(s, d))).select(
            "symbol", "interval", "date", "open_time_ms", "batch_id", "row_date"
        ),
        "validate_required": lambda s, d: validate.check_required(_g(s, d).raw),
        # models
        "stg_klines": lambda s, d: _round(_g(s, d).stg),
        "int_klines_normalized": lambda s, d: _round(_g(s, d).norm),
        "fact_prices": lambda s, d: _round(_g(s, d).prices),
        # over the stored fact, as a build computes them
        "fact_price_features": lambda s, d: _round(
            marts.price_features(_g(s, d).stored.tables["fact_prices"], block_rows=BLOCK_ROWS)
        ),
        "fact_price_hourly": lambda s, d: _round(_g(s, d).hourly),
        "dim_symbol": lambda s, d: _g(s, d).dim_symbol,
        "dim_calendar": lambda s, d: _g(s, d).dim_calendar(CALENDAR_TODAY),
        # serving and reports
        "dashboard_price_timeseries": lambda s, d: _round(_g(s, d).stored.tables["dashboard_price_timeseries"]),
        "feature_extract": lambda s, d: _round(serving.feature_extract(_g(s, d).stored.tables["dashboard_price_timeseries"])),
        "dashboard_daily_summary": lambda s, d: _round(_g(s, d).stored.tables["dashboard_daily_summary"]),
        "dashboard_data_status": lambda s, d: _round(_g(s, d).stored.tables["dashboard_data_status"]),
        "latest_status": lambda s, d: _round(serving.latest_status(_g(s, d).stored.tables["dashboard_data_status"])),
        "data_coverage_by_day": lambda s, d: serving.coverage_by_day(_g(s, d).prices),
        "data_contract_check": lambda s, d: _round(serving.contract_check(_g(s, d).stored.tables["dashboard_price_timeseries"])),
        "validate_raw": lambda s, d: serving.validate_raw(_g(s, d).raw),
        "validate_marts": lambda s, d: serving.validate_marts(_g(s, d).stored.tables["fact_price_features"]),
        "usage_last_7_days": lambda s, d: serving.usage(_g(s, d).jobs, USAGE_AS_OF),
        "usage_by_day": lambda s, d: serving.usage(_g(s, d).jobs, USAGE_AS_OF, by_user=False),
        "source_freshness": lambda s, d: _round(checks.source_freshness(_g(s, d).raw, AS_OF)),
        # data-quality checks (on the tampered fixtures where a clean table passes)
        "check_not_null": lambda s, d: checks.check_not_null(_g(s, d).dirty, _oracle.STG_NOT_NULL),
        "check_unique": lambda s, d: checks.check_unique(_g(s, d).stg, ["open_time_utc"]),
        "check_accepted_values": lambda s, d: checks.check_accepted_values(
            _g(s, d).dirty, "symbol", [sym for _, sym in fixtures.EVENT_SYMBOLS] + [fixtures.OTHER_SYMBOL]
        ),
        "check_relationships_symbol": lambda s, d: checks.check_relationships(
            _g(s, d).dirty, "symbol", _g(s, d).dim_symbol, "symbol"
        ),
        "check_relationships_calendar": lambda s, d: checks.check_relationships(
            _g(s, d).features, "open_date",
            marts.dim_calendar(_g(s, d).stg.filter(F.col("open_date") <= F.lit(SHORT_CALENDAR_END)), CALENDAR_TODAY),
            "calendar_date",
        ),
        "check_unique_natural_key": lambda s, d: checks.check_unique_natural_key(_g(s, d).stg),
        "check_no_negative_volume": lambda s, d: _round(checks.check_no_negative_volume(_g(s, d).dirty)),
        "check_ohlc_consistency": lambda s, d: _round(checks.check_ohlc_consistency(_g(s, d).dirty)),
        "check_no_hourly_gaps": lambda s, d: checks.check_no_gaps(_g(s, d).prices, block_rows=_g(s, d).block_rows),
        "check_first_return_null": lambda s, d: _round(checks.check_first_return_null(_g(s, d).features_tampered)),
        "check_log_return_consistency": lambda s, d: _round(
            checks.check_log_return_consistency(_g(s, d).features_tampered)
        ),
        "check_valid_ranges": lambda s, d: _round(checks.check_valid_ranges(_g(s, d).features_tampered)),
        "check_summary": lambda s, d: _check_summary(s, d),
        # incremental merge and full refresh of fact_prices
        "merge_fact_prices": lambda s, d: _round(_merged(s, d)),
        "merge_full_refresh": lambda s, d: _round(_merged(s, d, full_refresh=True)),
        "merge_empty_target": lambda s, d: _round(_merged_into_empty(s, d)),
        # state and raw zone after several runs
        "run_incremental_marks": _incremental_marks,
        "marks_read_back": _marks_read_back,
        "ingest_rejects": _ingest_rejects,
        "ingest_accepted": lambda s, d: _round(_ingest_accepted(s, d)),
        # second, incremental build: features from the tail, gaps and coverage from per-day rows
        "incremental_features": lambda s, d: _round(_incremental_build(s, d).tables["fact_price_features"]),
        "incremental_gaps": lambda s, d: checks.check_no_gaps_of(
            _incremental_build(s, d).tables["day_islands"], block_rows=BLOCK_ROWS
        ),
        "incremental_coverage": lambda s, d: _incremental_build(s, d).tables["data_coverage_by_day"],
        "gaps_from_day_islands": lambda s, d: checks.check_no_gaps_of(
            _g(s, d).stored.tables["day_islands"], block_rows=BLOCK_ROWS
        ),
        "stream_two_batches": lambda s, d: _round(_stream_two_batches(s, d)),
        "coverage_report_order": _coverage_in_order,
    }
    for module in _add_ons():
        q |= module.queries()
    return q


def _add_ons() -> list:
    """Modules that bring queries of their own, as far as they are installed."""
    found = []
    for name in ("candlewick.llm.queries", "corpus_pipeline"):
        try:
            found.append(importlib.import_module(name))
        except ImportError:  # not installed, or lacks something that it needs
            continue
    return found


def oracle_sql() -> dict[str, str]:
    sql = _oracle.oracle_sql()
    for module in _add_ons():
        sql |= module.oracle_sql()
    return sql


__all__ = ["entry", "queries", "oracle_sql"]
