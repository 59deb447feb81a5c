"""Data-quality checks. Each check returns the violating rows (pass <=> empty);
``run_checks`` turns a suite into one summary DataFrame.

Joins against dimensions are left-anti joins on the dimension key only; the
dimensions are tiny (one row per symbol / per day), and adaptive execution
broadcasts them once their real size is known.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlewick.functions import hours_between, lit_ts
from candlewick.operators.series import DEFAULT_BLOCK_ROWS, expand_copies, series_window
from candlewick.schema import (
    FRESHNESS_ERROR_DAYS,
    FRESHNESS_WARN_DAYS,
    LOG_RETURN_TOLERANCE,
    NATURAL_KEY,
    ROLLING_ROWS,
    SERIES_KEY,
)


def _sql_str(v: str) -> str:
    """A Spark SQL string literal."""
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def check_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULL counts of many columns in ONE scan -> (column_name, violations),
    only columns with violations."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("violations")) for c in columns])
    )
    return counts.select(pairs.alias("p")).select("p.*").filter(F.col("violations") > 0)


def check_unique(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Values of ``columns`` occurring more than once (NULL keys ignored)."""
    present = F.lit(True)
    for c in columns:
        present = present & F.col(c).isNotNull()
    return (
        df.filter(present)
        .groupBy(*columns)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .filter(F.col("row_count") > 1)
    )


def check_unique_natural_key(df: DataFrame, keys: Sequence[str] = NATURAL_KEY) -> DataFrame:
    return check_unique(df, keys)


def check_accepted_values(df: DataFrame, column: str, values: Iterable[str]) -> DataFrame:
    """Values outside ``values`` with their row count (NULLs are not judged)."""
    return (
        df.filter(~F.col(column).isin(list(values)))
        .groupBy(F.col(column).alias("value_field"))
        .agg(F.count(F.lit(1)).alias("n_records"))
    )


def check_relationships(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Child rows whose non-NULL ``column`` has no ``field`` in ``parent``."""
    keys = parent.select(F.col(field).alias(column)).distinct()
    # distinct child values (map-side first) decide which are missing; only rows
    # with such a value come back, and a hot value that is present none
    values = child.select(column).filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_rows"))
    missing = values.join(keys, column, "left_anti")
    return expand_copies(missing.select(F.col(column).alias("from_field"), "_rows"), "_rows")


# Row-level violations as Spark SQL predicates: a check is
# ``filter(predicate)``, and the suite fuses all predicates of one model into
# ONE aggregate scan. (Expression text is parsed JVM-side in one call.)

NEGATIVE_VOLUME = "volume < 0 OR quote_asset_volume < 0"

# high below max(open, close) or low above min(open, close). Rows where open
# or close is NULL are not judged (max/min of a NULL is unknown), which
# Spark's NULL-skipping greatest/least alone would not give.
OHLC_INCONSISTENT = (
    "CASE WHEN open IS NOT NULL AND close IS NOT NULL "
    "THEN high < greatest(open, close) OR low > least(open, close) END"
)


def log_return_inconsistent(tol: float = LOG_RETURN_TOLERANCE) -> str:
    return f"return_1h IS NOT NULL AND abs(log_return_1h - ln(1 + return_1h)) > {tol!r}"


def out_of_range(rows: int = ROLLING_ROWS) -> str:
    return (
        "price_range < 0 OR price_range_pct < 0 OR body_size_pct < 0 "
        f"OR rolling_window_observations_24h < 1 OR rolling_window_observations_24h > {int(rows)}"
    )


def is_null(column: str) -> str:
    return f"`{column}` IS NULL"


def not_in(column: str, values: Iterable[str]) -> str:
    quoted = ", ".join(_sql_str(str(v)) for v in values)
    return f"`{column}` NOT IN ({quoted})"


def check_no_negative_volume(stg: DataFrame) -> DataFrame:
    return stg.filter(NEGATIVE_VOLUME)


def check_ohlc_consistency(stg: DataFrame) -> DataFrame:
    return stg.filter(OHLC_INCONSISTENT)


def check_no_gaps(
    prices: DataFrame, step_hours: int = 1, block_rows: int = DEFAULT_BLOCK_ROWS
) -> DataFrame:
    """Bars whose predecessor in the series is not exactly ``step_hours``
    whole hours earlier."""

    def compute(df: DataFrame, w: Window) -> DataFrame:
        return df.withColumn("previous_open_time_utc", F.lag("open_time_utc").over(w))

    cols = prices.select("symbol", "bar_interval", "open_time_utc", "open_date")
    lagged = series_window(cols, compute, halo=1, block_rows=block_rows)
    return lagged.filter(
        F.col("previous_open_time_utc").isNotNull()
        & (hours_between("open_time_utc", "previous_open_time_utc") != step_hours)
    ).select("symbol", "bar_interval", "open_time_utc", "previous_open_time_utc")


def day_islands(prices: DataFrame, step_hours: int = 1) -> DataFrame:
    """Runs of bars that follow each other by exactly ``step_hours`` whole hours, by
    series and day: their first and last bar and number of bars. A day without a gap
    is one row. A day's islands depend on that day's bars only, so a changed day
    replaces its own."""
    w = Window.partitionBy(*SERIES_KEY, "open_date").orderBy("open_time_utc")
    before = F.lag("open_time_utc").over(w)
    begins = before.isNull() | (hours_between("open_time_utc", before) != step_hours)
    runs = prices.select(*SERIES_KEY, "open_date", "open_time_utc").withColumn("_begins", begins.cast("int"))
    runs = runs.withColumn("_run", F.sum("_begins").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return runs.groupBy(*SERIES_KEY, "open_date", "_run").agg(
        F.min("open_time_utc").alias("first_bar_utc"),
        F.max("open_time_utc").alias("last_bar_utc"),
        F.count(F.lit(1)).alias("bars"),
    ).drop("_run")


def check_no_gaps_of(islands: DataFrame, step_hours: int = 1, block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """``check_no_gaps`` from day islands: islands that don't join the one before."""

    def compute(df: DataFrame, w: Window) -> DataFrame:
        return df.withColumn("previous_open_time_utc", F.lag("last_bar_utc").over(w))

    lagged = series_window(islands, compute, halo=1, order=("first_bar_utc",), block_rows=block_rows)
    return lagged.filter(
        F.col("previous_open_time_utc").isNotNull()
        & (hours_between("first_bar_utc", "previous_open_time_utc") != step_hours)
    ).select("symbol", "bar_interval", F.col("first_bar_utc").alias("open_time_utc"), "previous_open_time_utc")


def check_first_return_null(features: DataFrame) -> DataFrame:
    """First bar of each series must have no return.

    The first row of each series is itself the result of a partial aggregate
    (``min_by`` of the row), so nothing is joined and at most one row of each
    series leaves a map task. Keys are unique, so there is one first bar.
    """
    row = F.struct(*[F.col(c) for c in features.columns])
    first = features.groupBy(*SERIES_KEY).agg(F.min_by(row, "open_time_utc").alias("_row"))
    return first.select("_row.*").filter(F.col("return_1h").isNotNull()).withColumn(
        "row_number_ascending", F.lit(1).cast("long")
    )


def check_log_return_consistency(features: DataFrame, tol: float = LOG_RETURN_TOLERANCE) -> DataFrame:
    return features.filter(log_return_inconsistent(tol))


def check_valid_ranges(features: DataFrame, rows: int = ROLLING_ROWS) -> DataFrame:
    return features.filter(out_of_range(rows))


def source_freshness(
    raw: DataFrame,
    as_of: dt.datetime | None = None,
    warn_days: int = FRESHNESS_WARN_DAYS,
    error_days: int = FRESHNESS_ERROR_DAYS,
    loaded_at: str = "loaded_at",
) -> DataFrame:
    """Age of the newest load: 'error' beyond ``error_days``, 'warn' beyond
    ``warn_days``, else 'pass'. One row."""
    now = lit_ts(as_of) if as_of is not None else F.current_timestamp()
    newest = raw.agg(F.max(loaded_at).alias("max_loaded_at"))
    age_s = (F.unix_micros(now) - F.unix_micros(F.col("max_loaded_at"))) / 1e6
    return newest.select(
        "max_loaded_at",
        now.alias("snapshotted_at"),
        age_s.alias("max_loaded_at_time_ago_in_s"),
        hours_between(now, "max_loaded_at").alias("hours_since_load"),
        F.when(F.col("max_loaded_at").isNull(), "error")
        .when(age_s > error_days * 86400, "error")
        .when(age_s > warn_days * 86400, "warn")
        .otherwise("pass")
        .alias("status"),
    )


@dataclass(frozen=True)
class Check:
    """One suite entry. Exactly one of:

    * ``violation`` -- SQL row predicate; violations = rows where it is true;
    * ``distinct_of`` + ``violation`` -- violations = distinct values of that
      column among rows where the predicate is true (accepted_values);
    * ``unique_keys`` -- violations = key values (NULL-free) held by more than
      one row;
    * ``references`` = (parent model, parent field) -- violations = rows whose
      non-NULL ``column`` has no match in the parent;
    * ``run`` -- maps the model DataFrames to violating rows (windows, joins).
    """

    model: str
    name: str
    column: str
    violation: str | None = None
    distinct_of: str | None = None
    unique_keys: tuple[str, ...] | None = None
    references: tuple[str, str] | None = None
    run: Callable[[dict[str, DataFrame]], DataFrame] | None = None


def missing_reference_counts(
    child: DataFrame, refs: Sequence[tuple[str, DataFrame, str]]
) -> DataFrame:
    """For each (child column, parent, parent field): child rows whose
    non-NULL value has no parent -- ONE pass over the child.

    The child's columns are left-joined with each parent's distinct keys
    (each child row matches at most one key, so rows are neither lost nor
    repeated; parents are dimensions, broadcast by adaptive execution when
    small), then one aggregate counts the misses. Returns one row with
    columns r0, r1, ... in ``refs`` order.
    """
    cols = list(dict.fromkeys(c for c, _, _ in refs))
    # values are counted map-side first: the joins see a row for each
    # combination of values, not each child row, whatever key is hot
    joined = child.groupBy(*cols).agg(F.count(F.lit(1)).alias("_rows"))
    for i, (col, parent, field) in enumerate(refs):
        keys = parent.select(F.col(field).alias(f"_k{i}")).distinct().withColumn(f"_hit{i}", F.lit(True))
        joined = joined.join(keys, F.col(col) == F.col(f"_k{i}"), "left").drop(f"_k{i}")
    return joined.selectExpr(
        *[
            f"CAST(coalesce(sum(IF(`{col}` IS NOT NULL AND _hit{i} IS NULL, _rows, 0)), 0) AS BIGINT) AS r{i}"
            for i, (col, _, _) in enumerate(refs)
        ]
    )


def duplicate_counts(df: DataFrame, key_sets: Sequence[tuple[str, ...]]) -> DataFrame:
    """For each key set: how many key values (without NULLs) occur more than
    once -- all sets in ONE scan and ONE partial aggregate.

    Every row is tagged once per key set (columns outside the set blanked),
    rows with a NULL key in their set are dropped, then rows per (set, key)
    are counted map-side first, so a hot key is combined before the shuffle.
    Returns one row with columns d0, d1, ... in ``key_sets`` order.
    """
    cols = list(dict.fromkeys(c for ks in key_sets for c in ks))
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    tags = []
    for i, ks in enumerate(key_sets):
        fields = [f"'_set', {i}"] + [
            f"'{c}', " + (f"`{c}`" if c in ks else f"CAST(NULL AS {types[c]})") for c in cols
        ]
        valid = " AND ".join(f"`{c}` IS NOT NULL" for c in ks)
        tags.append(f"IF({valid}, named_struct({', '.join(fields)}), NULL)")
    exploded = df.selectExpr(f"explode(array_compact(array({', '.join(tags)}))) AS _t").select("_t.*")
    groups = exploded.groupBy("_set", *cols).count().filter("count > 1")
    return groups.selectExpr(
        *[f"CAST(count_if(_set = {i}) AS BIGINT) AS d{i}" for i in range(len(key_sets))]
    )


def run_checks(models: dict[str, DataFrame], suite: Sequence[Check]) -> DataFrame:
    """(model, check_name, column_name, violations, status) for every check.

    All predicate checks of one model are fused into ONE global aggregate over
    that model (one scan, map-side partial counts); the other checks each
    reduce to a count on the executors. Only counts are unioned.
    """
    spark = next(iter(models.values())).sparkSession
    parts: list[DataFrame] = []
    fused: dict[str, list[Check]] = {}
    uniques: dict[str, list[Check]] = {}
    references: dict[str, list[Check]] = {}
    for chk in suite:
        if chk.references is not None:
            references.setdefault(chk.model, []).append(chk)
            continue
        if chk.unique_keys is not None:
            uniques.setdefault(chk.model, []).append(chk)
            continue
        if chk.run is None:
            fused.setdefault(chk.model, []).append(chk)
            continue
        parts.append(
            chk.run(models).selectExpr(
                f"{_sql_str(chk.model)} AS model",
                f"{_sql_str(chk.name)} AS check_name",
                f"{_sql_str(chk.column)} AS column_name",
                "count(1) AS violations",
            )
        )
    for model, chks in fused.items():
        aggs = [
            f"count(DISTINCT CASE WHEN {c.violation} THEN `{c.distinct_of}` END) AS v{i}"
            if c.distinct_of is not None
            else f"count_if(coalesce({c.violation}, false)) AS v{i}"
            for i, c in enumerate(chks)
        ]
        triples = ", ".join(
            f"{_sql_str(c.name)}, {_sql_str(c.column)}, CAST(v{i} AS BIGINT)" for i, c in enumerate(chks)
        )
        parts.append(
            models[model]
            .selectExpr(*aggs)
            .selectExpr(
                f"{_sql_str(model)} AS model",
                f"stack({len(chks)}, {triples}) AS (check_name, column_name, violations)",
            )
        )
    for model, chks in references.items():
        refs = [(c.column, models[c.references[0]], c.references[1]) for c in chks]
        triples = ", ".join(f"{_sql_str(c.name)}, {_sql_str(c.column)}, r{i}" for i, c in enumerate(chks))
        parts.append(
            missing_reference_counts(models[model], refs).selectExpr(
                f"{_sql_str(model)} AS model",
                f"stack({len(chks)}, {triples}) AS (check_name, column_name, violations)",
            )
        )
    for model, chks in uniques.items():
        sets = list(dict.fromkeys(tuple(c.unique_keys) for c in chks))
        triples = ", ".join(
            f"{_sql_str(c.name)}, {_sql_str(c.column)}, d{sets.index(tuple(c.unique_keys))}" for c in chks
        )
        parts.append(
            duplicate_counts(models[model], sets).selectExpr(
                f"{_sql_str(model)} AS model",
                f"stack({len(chks)}, {triples}) AS (check_name, column_name, violations)",
            )
        )
    if not parts:
        return spark.createDataFrame(
            [], "model string, check_name string, column_name string, violations long, status string"
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.selectExpr("*", "CASE WHEN violations = 0 THEN 'pass' ELSE 'fail' END AS status")
