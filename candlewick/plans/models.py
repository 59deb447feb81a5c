"""The model graph, composed lazily.

raw -> stg -> int -> {dim_symbol, dim_calendar, fact_prices -> features ->
{timeseries, daily summary, data status}}; stg -> fact_price_hourly.

``ModelGraph`` only wires DataFrames; nothing runs until an action. The
materialized build (tables written once, dashboards reading the stored
features) is ``plans.build``.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from candlewick.operators import marts, serving, staging
from candlewick.operators.series import DEFAULT_BLOCK_ROWS
from candlewick.session import scratch_path
from candlewick.sources import fixtures
from candlewick.sources import raw as raw_src


class ModelGraph:
    """``block_rows``: rows of a series that one task windows at a time."""

    def __init__(
        self,
        raw: DataFrame,
        as_of: dt.datetime | None = None,
        block_rows: int = DEFAULT_BLOCK_ROWS,
    ):
        self.raw = raw
        self.as_of = as_of
        self.block_rows = block_rows

    @cached_property
    def stg(self) -> DataFrame:
        return staging.stg_klines(self.raw)

    @cached_property
    def norm(self) -> DataFrame:
        return staging.int_klines_normalized(self.stg)

    @cached_property
    def prices(self) -> DataFrame:
        return marts.fact_prices(self.norm)

    @cached_property
    def features(self) -> DataFrame:
        return marts.price_features(self.prices, block_rows=self.block_rows)

    @cached_property
    def hourly(self) -> DataFrame:
        return marts.price_hourly(self.stg, block_rows=self.block_rows)

    @cached_property
    def dim_symbol(self) -> DataFrame:
        return marts.dim_symbol(self.norm)

    def dim_calendar(self, as_of: dt.date | None = None) -> DataFrame:
        # dedup keeps one version of every key, so the date bounds of the
        # normalized bars are those of staging: read them there -- a scan of
        # the raw table's day-partition column, no dedup shuffle.
        return marts.dim_calendar(self.stg, as_of)

    @cached_property
    def timeseries(self) -> DataFrame:
        return serving.price_timeseries(self.features)

    @cached_property
    def daily_summary(self) -> DataFrame:
        return serving.daily_summary(self.features)

    @cached_property
    def data_status(self) -> DataFrame:
        return serving.data_status(self.features, self.as_of)


class FixtureGraph(ModelGraph):
    """The graph over the driver's test tables (``events`` as trade tape).

    As in the reference, the raw table is loaded once (full rebuild, K3) and
    every model reads the stored, day-partitioned table; ``materialize=False``
    keeps the whole chain lazy from ``events`` instead.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, materialize: bool = True, **kw):
        self.spark = spark
        self.sf_dir = sf_dir
        self.events = fixtures.load_table(spark, sf_dir, "events")
        raw = fixtures.raw_klines(self.events)
        self.raw_path = None
        if materialize:
            self.raw_path = scratch_path(spark, "raw_klines")
            raw_src.write_raw_table(raw, self.raw_path)
            raw = raw_src.read_raw_table(spark, self.raw_path)
        super().__init__(raw, **kw)

    @cached_property
    def stored(self):
        """The materialized build over the raw table: dashboards and the data
        tests read its stored facts and features, as a build's users do."""
        from candlewick.plans.build import build_marts

        root = scratch_path(self.spark, "marts")
        return build_marts(self.spark, self.raw, root, as_of=self.as_of, block_rows=self.block_rows)

    @cached_property
    def jobs(self) -> DataFrame:
        return fixtures.jobs(self.events)

    @cached_property
    def dirty(self) -> DataFrame:
        return fixtures.klines_dirty(self.norm)

    @cached_property
    def features_tampered(self) -> DataFrame:
        return fixtures.features_tampered(self.features)

    @cached_property
    def payloads(self) -> DataFrame:
        return fixtures.payloads(self.raw)
