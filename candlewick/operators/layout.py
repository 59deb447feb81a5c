"""File layout of day tables: files of one size that hold disjoint ranges.

Row groups are skipped by a symbol predicate only if the symbols of a file are few. A
day that is too big for one task must therefore be cut along (series, time), not
by whatever map task a row came from. The cuts come from exact counts, so no task
gets more than its share of rows, however heavy one day or series is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlewick.schema import SERIES_KEY

#: Rows of one file of a day table (about 200 MB of bars).
DEFAULT_FILE_ROWS = 2_000_000
#: More days and cuts than this (about 10 MB of them) are joined by a shuffle.
BROADCAST_ROWS = 1 << 17


def day_cuts(
    keys: DataFrame, file_rows: int, series: Sequence[str] = SERIES_KEY, day: str = "open_date", time: str = "open_time_utc"
) -> DataFrame:
    """(day, start, cuts), one row a day: the number of the file that its first row
    goes to, and where each further file begins, as an ascending array of
    (series, hour) structs.

    Rows per (day, series, hour) are a partial aggregate over key columns. Their
    running count within a day, on top of the days before, is cut at multiples
    of ``file_rows``; only the day totals are summed up in one place.
    """
    at = F.struct(*[F.col(c) for c in series], F.date_trunc("hour", time).alias("hour"))
    counts = keys.groupBy(day, at.alias("at")).agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy(day).agg(F.sum("n").alias("rows"))
    # one row a day
    days = Window.orderBy(day).rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select(F.col(day).alias("__day"), F.coalesce(F.sum("rows").over(days), F.lit(0)).alias("base"))
    before = Window.partitionBy(day).orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    running = counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    numbered = running.join(bases, F.col(day).eqNullSafe(F.col("__day"))).withColumn(
        "file", F.floor((F.col("base") + F.col("before")) / file_rows).cast("int")
    )
    first = numbered.groupBy(day, "file").agg(F.min("at").alias("at"))
    return first.groupBy(day).agg(
        F.min("file").alias("start"),
        F.slice(F.array_sort(F.collect_list("at")), 2, 1 << 30).alias("cuts"),
    )


def clustered_by_day(
    df: DataFrame,
    keys: DataFrame | None = None,
    file_rows: int = DEFAULT_FILE_ROWS,
    series: Sequence[str] = SERIES_KEY,
    day: str = "open_date",
    time: str = "open_time_utc",
) -> DataFrame:
    """``df`` dealt into partitions of about ``file_rows`` rows that hold disjoint
    (day, series, time) ranges, each sorted in that order: a heavy day is written by
    several tasks whose files don't overlap, light days share a task.

    ``keys``: rows with the same key columns that are cheaper to read (the stored
    table that ``df`` is computed from); by default ``df`` itself. One shuffle of the
    rows. An (hour, series) is never cut: its rows are bounded by the interval.
    """
    cuts = day_cuts(keys if keys is not None else df, file_rows, series, day, time)
    # two values: files in all, and what the table of cuts holds
    files, entries = cuts.agg(F.max(F.col("start") + F.size("cuts")) + 1, F.sum(F.size("cuts") + 1)).first()
    order = [day, *series, time]
    if files is None:
        return df
    cuts = cuts.select(F.col(day).alias("__day"), F.col("start").alias("__start"), F.col("cuts").alias("__cuts"))
    if entries <= BROADCAST_ROWS:
        cuts = F.broadcast(cuts)
    at = F.struct(*[F.col(c) for c in series], F.date_trunc("hour", time).alias("hour"))
    passed = F.size(F.filter("__cuts", lambda cut: cut <= F.col("__at")))
    return (
        df.withColumn("__at", at)
        .join(cuts, F.col(day).eqNullSafe(F.col("__day")), "left")
        .withColumn("__file", F.coalesce(F.col("__start") + passed, F.lit(0)))
        .drop("__day", "__cuts", "__start", "__at")
        .repartitionById(int(files), F.col("__file").cast("int"))
        .drop("__file")
        .sortWithinPartitions(*order)
    )
