"""Incremental merge of fact_prices on the natural key, and full refresh.

Plain Parquet has no MERGE, so the merge is expressed as DataFrame algebra:
target rows without a source match (left anti join on the key) plus all
source rows; matched keys take the source version (update), new keys are
inserted. On disk (a ``VersionedTable``) the touched days are written beside the old
ones and replace them in one commit: a run that stops anywhere before it leaves the
old table, whatever it had written, and no reader sees some of the days only.

Incremental filter (kept from the reference): source rows with
``open_time_utc >= max(target.open_time_utc)`` -- inclusive, over the WHOLE
target. The newest bar is re-merged, and late bars older than that are
skipped until a full refresh. ``per_symbol=True`` uses each series' own max.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.functions import lit_ts
from candlewick.operators.checks import check_unique
from candlewick.operators.layout import DEFAULT_FILE_ROWS, clustered_by_day
from candlewick.schema import EMPTY_TARGET_FLOOR, FACT_PRICES_COLUMNS, NATURAL_KEY, SERIES_KEY
from candlewick.session import scratch_path, staged_run
from candlewick.sources.versioned import VersionedTable

EPOCH_FLOOR = EMPTY_TARGET_FLOOR


class SchemaDriftError(ValueError):
    pass


def newest_bar(target: DataFrame, time_col: str = "open_time_utc") -> dt.datetime:
    """max(open time) of the target -- ONE value to the driver (1900-01-01
    for an empty target). With days, the newest day is found first (on a stored
    table from its partition column) and only that day's times are read."""
    if "open_date" in target.columns:
        day = target.agg(F.max("open_date")).first()[0]
        if day is None:
            return EPOCH_FLOOR
        target = target.filter(F.col("open_date") == F.lit(day))
    return target.agg(F.max(time_col)).first()[0] or EPOCH_FLOOR


def incremental_filter(
    source: DataFrame,
    target: DataFrame,
    per_symbol: bool = False,
    time_col: str = "open_time_utc",
    newest: dt.datetime | None = None,
) -> DataFrame:
    """Source rows at or after the target's newest bar.

    The global max is a literal, together with the implied ``open_date``
    bound, so the source scan prunes day partitions.
    """
    if per_symbol:
        latest = target.groupBy(*SERIES_KEY).agg(F.max(time_col).alias("_newest"))
        return (
            source.join(latest, list(SERIES_KEY), "left")
            .filter(F.col(time_col) >= F.coalesce(F.col("_newest"), lit_ts(EPOCH_FLOOR)))
            .drop("_newest")
        )
    newest = newest or newest_bar(target, time_col)
    out = source
    if "open_date" in source.columns:
        out = out.filter(F.col("open_date") >= F.lit(newest.date()))
    return out.filter(F.col(time_col) >= lit_ts(newest))


def merge_rows(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str] = NATURAL_KEY,
    full_refresh: bool = False,
) -> DataFrame:
    """Pure merge: unmatched target rows + every source row (matched keys
    are replaced, new keys inserted). ``full_refresh`` rebuilds from source."""
    if full_refresh:
        return source.select(*target.columns)
    kept = target.join(source.select(*keys), list(keys), "left_anti")
    return kept.unionByName(source.select(*target.columns))


def assert_same_schema(target: DataFrame, source: DataFrame) -> None:
    """on_schema_change = fail."""
    t = [(f.name, f.dataType) for f in target.schema.fields]
    s = [(f.name, f.dataType) for f in source.schema.fields]
    if t != s:
        raise SchemaDriftError(f"source schema differs from target: {s} != {t}")


def assert_unique_keys(source: DataFrame, keys: Sequence[str] = NATURAL_KEY) -> None:
    """A MERGE must see at most one source row per target key."""
    if check_unique(source, keys).limit(1).count():
        raise ValueError("merge source has several rows for one key")


def assert_fact_columns(source: DataFrame) -> None:
    """The source must have the fact's columns and no others."""
    extra, missing = set(source.columns) - set(FACT_PRICES_COLUMNS), set(FACT_PRICES_COLUMNS) - set(source.columns)
    if extra or missing:
        raise SchemaDriftError(f"columns added: {sorted(extra)}; missing: {sorted(missing)}")


def fact_table(spark: SparkSession, path: str) -> VersionedTable:
    """The stored fact, day-partitioned. Its commits carry the rows and the content
    digest of every day."""
    return VersionedTable(spark, path, "open_date")


def read_fact_prices(spark: SparkSession, path: str) -> DataFrame:
    return fact_table(spark, path).read().select(*FACT_PRICES_COLUMNS)


def merge_into(
    spark: SparkSession,
    target_path: str,
    source: DataFrame,
    keys: Sequence[str] = NATURAL_KEY,
    full_refresh: bool = False,
    per_symbol: bool = False,
    layout_keys: DataFrame | None = None,
    file_rows: int = DEFAULT_FILE_ROWS,
) -> dict:
    """Incremental materialization of fact_prices at ``target_path``.

    ``full_refresh``, or no table committed there yet: rebuild from source.
    Otherwise: check the schema, filter the source (see module doc), stage what
    comes in once, check its keys, merge only the touched days and replace those days
    in one commit. Returns the mode and ``first_day``, the earliest day the merge
    touched (None when nothing came in).

    ``layout_keys``: rows (series, day, time) that a rebuild may count instead of the
    source to lay out files; without them the source is staged, so that it is
    computed once.
    """
    assert_fact_columns(source)
    table = fact_table(spark, target_path)
    with staged_run(spark):
        src = source.select(*FACT_PRICES_COLUMNS)
        if full_refresh or not table.exists():
            if layout_keys is None:
                src = layout_keys = _staged(src, "fact_prices_full")
            table.write(clustered_by_day(src, layout_keys, file_rows), digests=True)
            return {"mode": "full_refresh"}
        target = read_fact_prices(spark, target_path)
        assert_same_schema(target, src)
        newest = None if per_symbol else newest_bar(target)
        incoming = _staged(incremental_filter(src, target, per_symbol=per_symbol, newest=newest), "fact_prices_incoming")
        assert_unique_keys(incoming, keys)
        first_day = incoming.agg(F.min("open_date")).first()[0]  # one value
        if first_day is None:
            return {"mode": "merge", "first_day": None}
        # touched days: bounded by the calendar, one row per day. Every touched day
        # is >= the first one, a literal bound that prunes target partitions
        # statically; the semi join (dynamic partition pruning) skips days in
        # between that receive nothing.
        scope = target.filter(F.col("open_date") >= F.lit(first_day))
        touched = scope.join(incoming.select("open_date").distinct(), "open_date", "left_semi")
        both = touched.select(*NATURAL_KEY, "open_date").unionByName(incoming.select(*NATURAL_KEY, "open_date"))
        merged = clustered_by_day(merge_rows(touched, incoming, keys), both, file_rows)
        table.write(merged.select(*FACT_PRICES_COLUMNS), replace="touched", digests=True)
        return {"mode": "merge", "first_day": first_day}


def _staged(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
