"""Raw-zone writes, backfill / incremental ranges and the high-water mark.

The reference loops over days and calls an API per day; here the landed
payloads are one DataFrame and a range is one predicate, so all days of all
series are written by one job. Order is kept: data first, mark last -- a
crash re-runs days, which overwrite the same partitions. Rows are checked before
anything is stored.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from candlewick.functions import day_start_ms, lit_ts
from candlewick.operators.validate import with_reasons
from candlewick.schema import RAW_COLUMNS, RAW_PARTITION_COLUMNS, SUPPORTED_INTERVALS, WATERMARK, WATERMARK_KEY
from candlewick.sources import raw as raw_src
from candlewick.session import ensure_session_conf, scratch_path, staged_run, table_exists



@dataclass(frozen=True)
class RangeRequest:
    """Inclusive day range, optionally for named intervals; validated on the
    driver before any job starts."""

    start: dt.date
    end: dt.date
    intervals: Sequence[str] = ()
    supported: Sequence[str] = SUPPORTED_INTERVALS

    def validate(self) -> None:
        if self.start > self.end:
            raise ValueError(f"the range ends ({self.end}) before it starts ({self.start})")
        bad = [i for i in self.intervals if i not in self.supported]
        if bad:
            raise ValueError(f"unsupported interval(s) {bad}; supported: {list(self.supported)}")


def with_date(rows: DataFrame) -> DataFrame:
    if "date" in rows.columns:
        return rows
    return rows.withColumn("date", F.to_date(F.timestamp_millis("open_time_ms")))


def partition_path_expr() -> F.Column:
    parts = []
    for c in RAW_PARTITION_COLUMNS:
        parts += [F.lit(f"{c}="), F.col(c).cast("string"), F.lit("/")]
    return F.concat(*parts[:-1])


def write_summary(rows: DataFrame) -> DataFrame:
    """Per raw partition: row count and min/max open time (one partial
    aggregate; one row per written partition)."""
    return (
        with_date(rows)
        .groupBy(*RAW_PARTITION_COLUMNS)
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.min("open_time_ms").alias("min_open_time_ms"),
            F.max("open_time_ms").alias("max_open_time_ms"),
        )
        .withColumn("partition_path", partition_path_expr())
    )


def guard_partition_rules(dated: DataFrame) -> DataFrame:
    """Rows unchanged, but the job fails (inside the task) on a duplicate
    open time in one raw partition or a row outside its partition's day.

    Duplicates are adjacent once a partition is sorted by open time, so a
    ``lag`` over (partition key) ordered by open time finds them. That window
    clusters the rows by raw partition -- the same exchange the write needs --
    so the rules ride along with the write instead of a second pass.
    """
    w = Window.partitionBy(*RAW_PARTITION_COLUMNS).orderBy("open_time_ms")
    where = F.concat_ws("/", *[F.col(c).cast("string") for c in RAW_PARTITION_COLUMNS])
    row_day = F.to_date(F.timestamp_millis("open_time_ms"))
    guard = F.when(
        F.lag("open_time_ms").over(w) == F.col("open_time_ms"),
        F.raise_error(F.concat(F.lit("duplicate open_time_ms in raw partition "), where)),
    ).when(
        row_day != F.col("date"),
        F.raise_error(F.concat(F.lit("row date differs from partition date in "), where)),
    )
    return dated.withColumn("_violation", guard).filter(F.col("_violation").isNull()).drop("_violation")


def write_partitions(rows: DataFrame, root: str, check: bool = True) -> None:
    """Idempotent raw-zone write: each (source, dataset, symbol, interval,
    date) partition is replaced as a whole (dynamic overwrite); partitions
    not in ``rows`` are untouched.

    One shuffle on the partition key makes each partition one file, rows
    sorted by open time. A partition is one series-day -- bounded by the
    interval, since duplicate open times are rejected -- and a hot symbol
    spreads over its many days. ``check`` enforces the partition rules in the
    same pass (a violation fails the job before anything is committed).
    """
    dated = with_date(rows).select(*RAW_COLUMNS, "date")
    dated = guard_partition_rules(dated) if check else dated.repartition(*RAW_PARTITION_COLUMNS)
    (
        dated.sortWithinPartitions(*RAW_PARTITION_COLUMNS, "open_time_ms")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*RAW_PARTITION_COLUMNS)
        .parquet(root)
    )


def _range_bounds(start: dt.date, end: dt.date) -> tuple[int, int]:
    return day_start_ms(start), day_start_ms(end + dt.timedelta(days=1)) - 1


def backfill_rows(
    landed: DataFrame, start: dt.date, end: dt.date, intervals: Sequence[str] = ()
) -> DataFrame:
    """Bars with start-of-``start`` <= open_time_ms <= end-of-``end`` (UTC),
    of the given ``intervals`` (all when empty; each must be supported).

    The bounds are literals, so the scan prunes date partitions (when the
    input carries one) and pushes the time range into Parquet.
    """
    RangeRequest(start, end, tuple(intervals)).validate()
    lo, hi = _range_bounds(start, end)
    out = landed.filter(F.col("interval").isin(list(intervals))) if intervals else landed
    if "date" in landed.columns:
        out = out.filter(F.col("date").between(F.lit(start), F.lit(end)))
    return out.filter(F.col("open_time_ms").between(lo, hi))


def landed_range(landed: DataFrame, start: dt.date, end: dt.date, date_col: str = "date") -> DataFrame:
    """Landed payloads of the days ``start..end`` (a partition filter on the
    landing zone's date folders: only those days are read and parsed)."""
    RangeRequest(start, end).validate()
    return landed.filter(F.col(date_col).between(F.lit(start), F.lit(end)))


class InvalidRows(ValueError):
    """Rows broke a row rule and no place for rejects was named."""


def accepted_rows(rows: DataFrame, rejects_path: str | None, run_id: str) -> DataFrame:
    """The rows that keep every row rule; call it inside a ``staged_run``.

    ``rows`` are computed, checked and staged once, with the reasons against them. With
    ``rejects_path`` the others are filed there, one row per broken rule under their
    run (a repeated run replaces its own); without, any of them stops the run
    before it has written anything.
    """
    checked = _stage(with_reasons(rows), "checked-rows")
    bad = checked.filter(F.size("reasons") > 0)
    if rejects_path is None:
        first = bad.select("reasons").first()
        if first is not None:
            raise InvalidRows(f"invalid rows, e.g.: {'; '.join(first['reasons'])}")
    else:
        write_rejects(bad.select(*REJECT_KEY, F.explode("reasons").alias("reason")), rejects_path, run_id)
    return checked.filter(F.size("reasons") == 0).drop("reasons")


REJECT_KEY = (*WATERMARK_KEY, "open_time_ms")


def write_rejects(rejects: DataFrame, path: str, run_id: str) -> None:
    """File ``rejects`` under ``run=<run_id>``; other runs keep theirs."""
    (
        rejects.select(*REJECT_KEY, "reason").withColumn("run", F.lit(run_id))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run").parquet(path)
    )


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    """All filed rejects: series, open time, reason, run (none if nothing was filed)."""
    types = {f.name: f.dataType.simpleString() for f in WATERMARK.fields}
    keys = ", ".join(f"{c} {types[c]}" for c in WATERMARK_KEY)
    schema = f"{keys}, open_time_ms long, reason string, run string"
    if not table_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def run_backfill(
    landed: DataFrame, root: str, start: dt.date, end: dt.date, rejects_path: str | None = None, run_id: str = "backfill"
) -> DataFrame:
    """Write the valid rows of the range; returns the per-partition summary read back
    from the written partitions (empty days write nothing). Invalid rows are filed
    under ``rejects_path`` or, without one, stop the run (see ``accepted_rows``)."""
    spark = landed.sparkSession
    with staged_run(spark):
        rows = accepted_rows(backfill_rows(landed, start, end), rejects_path, run_id)
        write_partitions(rows, root)
        written = raw_src.scan_raw(spark, root).filter(F.col("date").between(F.lit(start), F.lit(end)))
        keys = rows.select(*RAW_PARTITION_COLUMNS[:-1]).distinct()
        return _stage(write_summary(written.join(keys, list(RAW_PARTITION_COLUMNS[:-1]), "left_semi")), "summary", lasting=True)


# --- high-water marks ---------------------------------------------------------

def high_water_marks(written: DataFrame, updated_at: dt.datetime | None = None) -> DataFrame:
    """Mark per (source, dataset, symbol, interval) = newest open time."""
    stamp = lit_ts(updated_at) if updated_at is not None else F.current_timestamp()
    return (
        written.groupBy(*WATERMARK_KEY)
        .agg(F.max("open_time_ms").alias("last_open_time_ms"))
        .withColumn("updated_at", stamp)
    )


def read_marks(spark: SparkSession, path: str) -> DataFrame:
    """All stored marks (empty if none were ever written)."""
    ensure_session_conf(spark)
    try:
        return spark.read.schema(WATERMARK).json(path).select(*WATERMARK.fieldNames())
    except Exception as exc:  # absent state folder == no marks yet
        if "PATH_NOT_FOUND" not in str(exc) and "does not exist" not in str(exc):
            raise
        return spark.createDataFrame([], WATERMARK)


def write_marks(marks: DataFrame, path: str) -> None:
    """Replace the marks of exactly the keys in ``marks`` (one JSON file per
    key folder); other keys keep theirs."""
    (
        marks.withColumns({f"_{k}": F.col(k) for k in WATERMARK_KEY})
        .repartition(*[f"_{k}" for k in WATERMARK_KEY])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*[f"_{k}" for k in WATERMARK_KEY])
        .json(path)
    )


def start_dates(marks: DataFrame) -> DataFrame:
    """Per key with a mark: the day after the mark's UTC date (a mark in
    mid-day skips the rest of that day, as in the reference)."""
    return marks.select(
        *WATERMARK_KEY,
        F.date_add(F.to_date(F.timestamp_millis("last_open_time_ms")), 1).alias("start_date"),
    )


def first_day(starts: DataFrame, keys: DataFrame, bootstrap: dt.date) -> dt.date:
    """The earliest day any of ``keys`` needs: its own start, or the bootstrap
    day if it has no mark. ONE value to the driver; a literal lower bound for
    the landed scan."""
    lowest = keys.join(starts, list(WATERMARK_KEY), "left").agg(
        F.min(F.coalesce("start_date", F.lit(bootstrap)))
    ).first()[0]
    return bootstrap if lowest is None else lowest


def incremental_rows(
    landed: DataFrame, marks: DataFrame, bootstrap: dt.date, end: dt.date, keys: DataFrame | None = None
) -> DataFrame:
    """Rows of an incremental run: per key from its start date (bootstrap if
    it has no mark) through ``end``; a key whose start is after ``end`` gets
    nothing (no-op).

    ``keys``: the series to look for; without them, those of ``landed`` (their
    key columns are scanned; on a landing zone these are folder names). The
    marks are one row per series, joined on the key.
    """
    RangeRequest(bootstrap, end).validate()
    starts = start_dates(marks)
    if keys is None:
        keys = landed.select(*WATERMARK_KEY).distinct()
    lo_day = first_day(starts, keys, bootstrap)
    if lo_day > end:
        return landed.limit(0)
    joined = backfill_rows(landed, lo_day, end).join(starts, list(WATERMARK_KEY), "left")
    start_ms = F.unix_millis(F.coalesce(F.col("start_date"), F.lit(bootstrap)).cast("timestamp"))
    return joined.filter(F.col("open_time_ms") >= start_ms).drop("start_date").select(*landed.columns)


@dataclass(frozen=True)
class IncrementalResult:
    """What a run did. ``starts``: each key's first day; ``outputs``: one row per
    partition written (as ``write_summary``)."""

    partitions_written: int
    rows_written: int
    starts: DataFrame
    outputs: DataFrame
    marks_before: DataFrame
    marks_after: DataFrame


def run_incremental(
    landed: DataFrame,
    root: str,
    state_path: str,
    bootstrap: dt.date,
    end: dt.date,
    keys: DataFrame | None = None,
    rejects_path: str | None = None,
    run_id: str = "incremental",
) -> IncrementalResult:
    """Bounded incremental load: read marks -> write the valid rows -> new marks for
    the keys that wrote something -> write marks.

    ``keys`` limits the run to some (source, dataset, symbol, interval);
    default: every key present in ``landed``. The rows are checked and staged once
    (see ``accepted_rows`` for the others); the raw zone, the summary and the marks all
    come from them, so a mark is the newest accepted bar of THIS run, whatever else the
    raw zone holds. The marks read at the start are staged because the state folder is
    rewritten at the end.
    """
    spark = landed.sparkSession
    with staged_run(spark):
        before = _stage(read_marks(spark, state_path), "marks", lasting=True)
        scope = landed if keys is None else landed.join(keys, list(WATERMARK_KEY), "left_semi")
        known = (scope if keys is None else keys).select(*WATERMARK_KEY).distinct()
        rows = accepted_rows(incremental_rows(scope, before, bootstrap, end, known), rejects_path, run_id)
        outputs = _stage(write_summary(rows), "outputs", lasting=True)
        stats = outputs.agg(F.count(F.lit(1)).alias("p"), F.sum("row_count").alias("r")).first()
        if stats["p"]:
            write_partitions(rows, root)
            write_marks(high_water_marks(rows), state_path)
    starts = known.join(start_dates(before), list(WATERMARK_KEY), "left").withColumn(
        "start_date", F.coalesce("start_date", F.lit(bootstrap))
    )
    return IncrementalResult(
        partitions_written=int(stats["p"] or 0),
        rows_written=int(stats["r"] or 0),
        starts=starts,
        outputs=outputs,
        marks_before=before,
        marks_after=read_marks(spark, state_path),
    )


def _stage(df: DataFrame, name: str, lasting: bool = False) -> DataFrame:
    path = scratch_path(df.sparkSession, name, lasting)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
