"""Materialized build of the model graph (build all models, then test them).

* staging / intermediate: views (never stored),
* fact_prices: incremental merge on the natural key (``plans.merge``),
* fact_price_features, fact_price_hourly, dim_symbol, dim_calendar: tables,
  day-partitioned where they carry ``open_date``,
* daily_partials: one row per series and day, from which the daily summary, the
  data status and the coverage report are read; day_islands: runs of bars without a
  gap by series and day, from which the gap check reads,
* dashboards: views over the STORED features and partials, so the window work is
  done once per build,
* then the data-test suite runs against the stored tables.

Every table is a ``VersionedTable``: what a build replaces, it replaces in one commit.

Features are rebuilt from the stored fact (``incremental_features=False``, as
the reference does) or from the first stale day on (``incremental_features=True``). A
day is stale when the fact's content digest of the day isn't the one that the stored
features were computed from, whatever changed it and whichever run was cut off. The
24 bars that a window needs before that day come from ``fact_price_tail``, the last bars
of each series before the newest day, kept from run to run: an append reads the
new days and the tail, however long the history is.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.operators import checks, marts, serving, staging
from candlewick.operators.layout import clustered_by_day
from candlewick.operators.series import DEFAULT_BLOCK_ROWS
from candlewick.plans import merge
from candlewick.plans.suite import default_suite
from candlewick.schema import FACT_PRICE_FEATURES_COLUMNS, FACT_PRICE_HOURLY_COLUMNS, FACT_PRICES_COLUMNS, NATURAL_KEY
from candlewick.session import ensure_session_conf
from candlewick.sources.versioned import VersionedTable

#: Tables with a folder for each day; tables of per-day rows have one for each month.
MONTH = "month"
PARTITIONS = {
    "fact_prices": "open_date",
    "fact_price_features": "open_date",
    "fact_price_hourly": "open_date",
    "daily_partials": MONTH,
    "day_islands": MONTH,
}


@dataclass
class Build:
    root: str
    tables: dict[str, DataFrame] = field(default_factory=dict)
    merge_info: dict = field(default_factory=dict)
    block_rows: int = DEFAULT_BLOCK_ROWS
    #: First day whose features were computed (None: they were current; "all").
    refreshed_from: dt.date | str | None = None

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def table(self, spark: SparkSession, name: str) -> VersionedTable:
        return VersionedTable(spark, self.path(name), PARTITIONS.get(name))


def day_digests(table: VersionedTable) -> dict[str, str]:
    """Day folder -> content digest, from the newest commit (no data is read)."""
    at = table.commit()
    return {day: entry["digest"] for day, entry in at.parts.items()} if at else {}


def _date(folder: str) -> dt.date:
    return dt.date.fromisoformat(folder.split("=", 1)[1])


def _dated(days: dict[str, str]) -> dict[str, str]:
    """Without the folder of rows that have no day."""
    return {d: v for d, v in days.items() if "__HIVE" not in d}


def _before(days: dict[str, str], day: dt.date) -> dict[str, str]:
    return {d: v for d, v in _dated(days).items() if _date(d) < day}


def first_stale_day(now: dict[str, str], then: dict[str, str]) -> str | None:
    """The first day folder whose content differs, appeared or went. Folder names of
    days sort like the days (a null day's name after all)."""
    return min((d for d in now.keys() | then.keys() if now.get(d) != then.get(d)), default=None)


def _refresh_features(spark: SparkSession, b: Build, incremental: bool) -> None:
    """Bring the stored features, their partials and the tail up to the stored fact."""
    facts, feats, tail = (b.table(spark, n) for n in ("fact_prices", "fact_price_features", "fact_price_tail"))
    prices = facts.read().select(*FACT_PRICES_COLUMNS)
    now = day_digests(facts)
    built = feats.commit() if incremental else None
    stale = first_stale_day(now, built.notes.get("source", {})) if built else None
    if built and stale is None:
        b.refreshed_from = None
    elif built is None or "__HIVE" in stale:
        b.refreshed_from = "all"
        feats.write(
            clustered_by_day(marts.price_features(prices, block_rows=b.block_rows), prices), notes={"source": now}
        )
    else:
        start = b.refreshed_from = _date(stale)
        older = tail.commit()
        before = dt.date.fromisoformat(older.notes["before"]) if older else None
        new = prices.filter(F.col("open_date") >= F.lit(start))
        if before is not None and before <= start and _before(now, before) == older.notes["source"]:
            between = F.col("open_date").between(F.lit(before), F.lit(start - dt.timedelta(days=1)))
            halo = marts.series_tail(tail.read().unionByName(prices.filter(between)))
            computed = marts.features_after(new, halo, start, block_rows=b.block_rows)
        else:  # history before the tail changed: find the bars before the day
            newest = max(map(_date, _dated(now)), default=start)
            computed = marts.features_for_range(prices, start, newest, block_rows=b.block_rows)
        gone = [d for d in _dated(feats.commit().parts) if d >= stale]
        feats.write(clustered_by_day(computed, new), replace="touched", drop=gone, notes={"source": now})
    _refresh_tail(tail, prices, now)
    _refresh_daily(b.table(spark, "daily_partials"), feats.read(), serving.daily_partials, now, incremental)
    _refresh_daily(b.table(spark, "day_islands"), prices, checks.day_islands, now, incremental)


def _refresh_tail(tail: VersionedTable, prices: DataFrame, now: dict[str, str]) -> None:
    """The last bars of each series before the newest day, from the tail so far and the
    days since, if the days before it are as they were; else from all days before."""
    if not _dated(now):
        return
    newest = max(map(_date, _dated(now)))
    source = _before(now, newest)
    older = tail.commit()
    if older and older.notes == {"before": newest.isoformat(), "source": source}:
        return
    bars = prices.filter(F.col("open_date") < F.lit(newest))
    if older:
        before = dt.date.fromisoformat(older.notes["before"])
        if before <= newest and _before(now, before) == older.notes["source"]:
            bars = tail.read().unionByName(bars.filter(F.col("open_date") >= F.lit(before)))
    tail.write(marts.series_tail(bars), notes={"before": newest.isoformat(), "source": source})


def _refresh_daily(table: VersionedTable, days: DataFrame, derive, now: dict[str, str], incremental: bool) -> None:
    """Bring a table of per-day rows, filed by month, up to ``now``: ``derive`` the rows of
    ``days`` from the first day on that they weren't computed from; of that day's
    month, the earlier days stay."""
    month_of = F.date_format("open_date", "yyyy-MM")
    built = table.commit() if incremental else None
    stale = first_stale_day(now, built.notes.get("source", {})) if built else None
    if built and stale is None:
        return
    if built is None or "__HIVE" in stale:
        table.write(derive(days).withColumn(MONTH, month_of).repartition(MONTH), notes={"source": now})
        return
    start = _date(stale)
    fresh = derive(days.filter(F.col("open_date") >= F.lit(start))).withColumn(MONTH, month_of)
    month = f"{start:%Y-%m}"
    kept = table.read().filter((F.col(MONTH) == month) & (F.col("open_date") < F.lit(start)))
    gone = [m for m in built.parts if m >= table.folder(month) and "__HIVE" not in m]
    table.write(kept.unionByName(fresh).repartition(MONTH), replace="touched", drop=gone, notes={"source": now})


def build_marts(
    spark: SparkSession,
    raw: DataFrame,
    root: str,
    as_of: dt.datetime | None = None,
    full_refresh: bool = False,
    incremental_features: bool = False,
    per_symbol: bool = False,
    block_rows: int = DEFAULT_BLOCK_ROWS,
    view_prefix: str | None = None,
) -> Build:
    """Build every model under ``root``; returns DataFrames over the stored
    tables (and the views). ``view_prefix`` also registers temp views named
    ``<prefix><layer>_<model>``."""
    ensure_session_conf(spark)
    b = Build(root, block_rows=block_rows)
    stg = staging.stg_klines(raw)
    norm = staging.int_klines_normalized(stg)

    b.merge_info = merge.merge_into(
        spark, b.path("fact_prices"), marts.fact_prices(norm), full_refresh=full_refresh, per_symbol=per_symbol,
        layout_keys=stg,
    )
    _refresh_features(spark, b, incremental_features and not full_refresh)
    b.table(spark, "fact_price_hourly").write(clustered_by_day(marts.price_hourly(stg, block_rows=block_rows), stg))
    prices = b.table(spark, "fact_prices").read()
    # one row per symbol, one per day. Counts and bounds of the deduplicated bars are
    # those of the distinct keys: key columns only, no dedup window
    b.table(spark, "dim_symbol").write(marts.dim_symbol(stg.select(*NATURAL_KEY).distinct()).coalesce(1))
    b.table(spark, "dim_calendar").write(marts.dim_calendar(stg, as_of.date() if as_of else None).coalesce(1))

    features = b.table(spark, "fact_price_features").read().select(*FACT_PRICE_FEATURES_COLUMNS)
    partials = b.table(spark, "daily_partials").read()
    b.tables = {
        "stg_klines": stg,
        "int_klines_normalized": norm,
        "fact_prices": prices.select(*FACT_PRICES_COLUMNS),
        "fact_price_features": features,
        "fact_price_hourly": b.table(spark, "fact_price_hourly").read().select(*FACT_PRICE_HOURLY_COLUMNS),
        "dim_symbol": b.table(spark, "dim_symbol").read(),
        "dim_calendar": b.table(spark, "dim_calendar").read(),
        "dashboard_price_timeseries": serving.price_timeseries(features),
        "dashboard_daily_summary": serving.daily_summary_of(partials),
        "dashboard_data_status": serving.data_status_of(partials, as_of),
        "day_islands": b.table(spark, "day_islands").read(),
        "data_coverage_by_day": serving.coverage_by_day_of(partials),
    }
    if view_prefix is not None:
        layers = {"stg_klines": "staging", "int_klines_normalized": "intermediate"}
        for name, df in b.tables.items():
            df.createOrReplaceTempView(f"{view_prefix}{layers.get(name, 'marts')}_{name}")
    return b


class DataTestFailure(RuntimeError):
    pass


def test_build(build: Build, strict: bool = False, **suite_args) -> DataFrame:
    """Run the data-test suite over the built tables. ``strict`` collects the
    (one row per test) summary and raises if any test failed, so a publish
    step ordered after it never sees failing marts."""
    summary = checks.run_checks(build.tables, default_suite(block_rows=build.block_rows, **suite_args))
    if strict:
        failed = [r for r in summary.collect() if r["status"] != "pass"]
        if failed:
            names = ", ".join(f"{r['model']}.{r['check_name']}({r['column_name']})={r['violations']}" for r in failed)
            raise DataTestFailure(f"{len(failed)} data test(s) failed: {names}")
    return summary
