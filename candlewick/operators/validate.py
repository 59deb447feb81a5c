"""Row validation of bars as column jobs (no per-row objects).

Every rule is one Column expression yielding its message or NULL; the rules of
a row are collected into an array, so one projection evaluates them all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.schema import KLINE_ARRAY_FIELDS, RAW_KLINES

# Bounds of a kline row. Prices strictly positive; times,
# volumes and trade counts non-negative.
POSITIVE_FIELDS = ["open", "high", "low", "close"]
NON_NEGATIVE_FIELDS = [
    "open_time_ms",
    "volume",
    "close_time_ms",
    "quote_asset_volume",
    "number_of_trades",
    "taker_buy_base_asset_volume",
    "taker_buy_quote_asset_volume",
]


def row_rules() -> list[Column]:
    """One message-or-NULL Column per rule."""
    rules: list[Column] = []
    for name, dtype in KLINE_ARRAY_FIELDS:
        missing = F.col(name).isNull()
        if isinstance(dtype, T.DoubleType):
            # Spark orders NaN above every number, so "> 0" alone would pass it
            missing = missing | F.isnan(F.col(name))
        rules.append(F.when(missing, F.lit(f"{name} is missing or not a number")))
    for name in POSITIVE_FIELDS:
        rules.append(F.when(F.col(name) <= 0, F.lit(f"{name} must be > 0")))
    for name in NON_NEGATIVE_FIELDS:
        rules.append(F.when(F.col(name) < 0, F.lit(f"{name} must be >= 0")))
    o, h, lo, c = (F.col(n) for n in ("open", "high", "low", "close"))
    rules.append(F.when(h < F.greatest(o, c), F.lit("high is below open or close")))
    rules.append(F.when(lo > F.least(o, c), F.lit("low is above open or close")))
    rules.append(
        F.when(F.col("close_time_ms") <= F.col("open_time_ms"), F.lit("bar closes before it opens"))
    )
    return rules


def with_reasons(df: DataFrame) -> DataFrame:
    """Adds ``reasons``: array of violated-rule messages (empty = valid).

    The cross-field rules only judge rows whose inputs are all present; a
    missing input is already reported by its own rule.
    """
    complete = F.lit(True)
    for name in ("open", "high", "low", "close", "open_time_ms", "close_time_ms"):
        complete = complete & F.col(name).isNotNull()
    rules = row_rules()
    n_cross = 3
    guarded = rules[:-n_cross] + [F.when(complete, r) for r in rules[-n_cross:]]
    return df.withColumn("reasons", F.array_compact(F.array(*guarded)))


def validate_rows(df: DataFrame, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """Split bars into (accepted, rejects). ``rejects`` has one row per
    (row, violated rule) with a ``reason`` column. ``strict=True`` raises if
    anything is rejected (one count action), as the per-row model does."""
    checked = with_reasons(df)
    ok = checked.filter(F.size("reasons") == 0).drop("reasons")
    rejects = checked.filter(F.size("reasons") > 0).select(
        *[c for c in df.columns], F.explode("reasons").alias("reason")
    )
    if strict:
        first = rejects.select("reason").limit(1).collect()
        if first:
            raise ValueError(f"invalid kline rows, e.g.: {first[0]['reason']}")
    return ok, rejects


def partition_duplicates(
    landed: DataFrame, partition: Sequence[str] = ("source", "dataset", "symbol", "interval", "date")
) -> DataFrame:
    """open_time_ms values occurring more than once in one raw partition."""
    return (
        landed.groupBy(*partition, "open_time_ms")
        .agg(F.count(F.lit(1)).alias("row_count"))
        .filter(F.col("row_count") > 1)
    )


def partition_date_mismatch(landed: DataFrame, date_col: str = "date") -> DataFrame:
    """Rows whose UTC open date differs from their partition's date."""
    row_date = F.to_date(F.timestamp_millis("open_time_ms"))
    return landed.filter(row_date != F.col(date_col)).withColumn("row_date", row_date)


def check_partition(landed: DataFrame) -> DataFrame:
    """Both partition rules as a report; one row per violation with
    ``reason``. (The raw-zone writer enforces the same rules inside its own
    write pass, see ``plans.ingest.guard_partition_rules``.)"""
    dup = partition_duplicates(landed).select(
        "source", "dataset", "symbol", "interval", "date", "open_time_ms",
        F.lit("duplicate open_time_ms in partition").alias("reason"),
    )
    wrong = partition_date_mismatch(landed).select(
        "source", "dataset", "symbol", "interval", "date", "open_time_ms",
        F.lit("row date differs from partition date").alias("reason"),
    )
    return dup.unionByName(wrong)


def check_required(df: DataFrame, schema: T.StructType = RAW_KLINES) -> DataFrame:
    """Per declared column: present with the declared type, and NULL count
    (one scan). Missing columns report ``type_ok = false`` and no count."""
    actual = {f.name: f.dataType for f in df.schema.fields}
    present = [f for f in schema.fields if f.name in actual]
    counts = df.agg(*[F.count_if(F.col(f.name).isNull()).alias(f.name) for f in present])
    items = []
    for f in schema.fields:
        n = F.col(f.name).cast("long") if f.name in actual else F.lit(None).cast("long")
        items.append(
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.lit(actual.get(f.name) == f.dataType).alias("type_ok"),
                n.alias("null_count"),
            )
        )
    return counts.select(F.explode(F.array(*items)).alias("r")).select("r.*")
