"""Staging (rename + derive) and latest-version dedup of bars."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlewick.schema import NATURAL_KEY, STG_COLUMNS


def stg_klines(raw: DataFrame) -> DataFrame:
    """Raw table -> staging: dataset->source_dataset, interval->bar_interval,
    open_date = UTC date of open_time_utc; rows without open time dropped.

    The raw table is day-partitioned by exactly that date; when its
    ``open_date`` partition column is present it is used as is, so day
    predicates downstream (merge, ranges) prune raw directories.
    """
    renamed = raw.filter(F.col("open_time_utc").isNotNull()).withColumnsRenamed(
        {"dataset": "source_dataset", "interval": "bar_interval"}
    )
    if "open_date" not in raw.columns:
        renamed = renamed.withColumn("open_date", F.to_date("open_time_utc"))
    return renamed.select(*STG_COLUMNS)


def latest_per_key(
    stg: DataFrame,
    keys: Sequence[str] = NATURAL_KEY,
    order: Sequence[str] = ("loaded_at", "batch_id"),
) -> DataFrame:
    """Keep the most recently loaded version of each key.

    ``row_number() = 1`` is planned as WindowGroupLimit Partial *before* the
    shuffle, so however many copies a hot key has, each map task forwards at
    most one of them. ``batch_id`` breaks ties in ``loaded_at`` (DESC puts
    NULLs last); a hash of the row's values breaks what remains, so a retried
    task keeps the same version as the first attempt would have.
    """
    content = F.xxhash64(*[F.col(c) for c in stg.columns if c not in keys])
    # open_date is a function of the open time: as a partition column of the
    # window it changes no group, and day predicates pass below the dedup
    day = ["open_date"] if "open_time_utc" in keys and "open_date" in stg.columns else []
    w = Window.partitionBy(*keys, *day).orderBy(*[F.col(c).desc() for c in order], content.desc())
    return (
        stg.withColumn("_rn", F.row_number().over(w))
        .filter(F.col("_rn") == 1)
        .drop("_rn")
    )


def int_klines_normalized(stg: DataFrame) -> DataFrame:
    return latest_per_key(stg)
