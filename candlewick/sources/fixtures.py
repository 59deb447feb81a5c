"""Test-data adapter: derives bar tables from the driver's ``events`` table.

``events`` plays the trade tape. Every derived table is a Spark job over the
whole input, so its work grows with the data. The derivation rules are fixed
by the project's fixture document (FIXTURES.md) and mirrored by the DuckDB
oracle SQL; they are test inputs, not library semantics.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.functions import from_epoch_ms
from candlewick.schema import BAR_INTERVAL, DATASET_NAME, KLINE_ARRAY_FIELDS, RAW_COLUMNS, SOURCE_NAME
from candlewick.session import ensure_session_conf

# Fixed values of the fixture (must equal the oracle SQL):
# event type -> symbol: purchase BTCUSDT, click ETHUSDT, view SOLUSDT,
# signup BNBUSDT, anything else XRPUSDT.
EVENT_SYMBOLS = [
    ("purchase", "BTCUSDT"),
    ("click", "ETHUSDT"),
    ("view", "SOLUSDT"),
    ("signup", "BNBUSDT"),
]
OTHER_SYMBOL = "XRPUSDT"
# Two load batches: batch-001 holds every tick before 2024-01-15 and after that
# those with event_id % 3 <> 0, loaded 2024-02-01; batch-002 re-delivers every
# tick from 2024-01-15 on, loaded 2024-02-02.
BATCH_1 = ("batch-001", "2024-02-01 00:00:00")
BATCH_2 = ("batch-002", "2024-02-02 00:00:00")
BATCH_2_FROM = "2024-01-15 00:00:00"
SOURCE, DATASET, INTERVAL = SOURCE_NAME, DATASET_NAME, BAR_INTERVAL
HOUR_MS = 3_600_000


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ensure_session_conf(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ticks(events: DataFrame) -> DataFrame:
    symbol = F.lit(OTHER_SYMBOL)
    for event_type, sym in reversed(EVENT_SYMBOLS):
        symbol = F.when(F.col("event_type") == event_type, sym).otherwise(symbol)
    return events.select(
        "event_id",
        symbol.alias("symbol"),
        F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("open_time_utc"),
        F.col("value").alias("price"),
        (F.col("event_id") % 10 + 1).cast("double").alias("qty"),
        (F.col("user_id") % 2 == 0).alias("is_buy"),
    )


def raw_klines(events: DataFrame) -> DataFrame:
    """Hourly bars of both load batches from ONE scan and ONE shuffle.

    Each tick is tagged with the batches it belongs to (0, 1 or 2), exploded,
    and aggregated by (batch, symbol, hour); the aggregate is partial, so a hot
    symbol is combined map-side before the shuffle.
    """
    t = ticks(events)
    in_b2 = F.col("open_time_utc") >= F.lit(BATCH_2_FROM).cast("timestamp")
    in_b1 = (F.col("event_id") % 3 != 0) | ~in_b2
    tagged = t.withColumn(
        "batch_id",
        F.explode(F.array_compact(F.array(F.when(in_b1, BATCH_1[0]), F.when(in_b2, BATCH_2[0])))),
    )
    notional = F.col("price") * F.col("qty")
    bars = tagged.groupBy("batch_id", "symbol", "open_time_utc").agg(
        F.min_by("price", "event_id").alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", "event_id").alias("close"),
        F.sum("qty").alias("volume"),
        F.round(F.sum(notional), 6).alias("quote_asset_volume"),
        F.count(F.lit(1)).alias("number_of_trades"),
        F.sum(F.when(F.col("is_buy"), F.col("qty")).otherwise(0.0)).alias("taker_buy_base_asset_volume"),
        F.round(F.sum(F.when(F.col("is_buy"), notional).otherwise(0.0)), 6).alias(
            "taker_buy_quote_asset_volume"
        ),
    )
    open_ms = F.unix_millis("open_time_utc")
    loaded_at = F.when(F.col("batch_id") == BATCH_1[0], F.lit(BATCH_1[1])).otherwise(F.lit(BATCH_2[1]))
    return bars.select(
        F.lit(SOURCE).alias("source"),
        F.lit(DATASET).alias("dataset"),
        "symbol",
        F.lit(INTERVAL).alias("interval"),
        open_ms.alias("open_time_ms"),
        "open_time_utc",
        "open",
        "high",
        "low",
        "close",
        "volume",
        (open_ms + (HOUR_MS - 1)).alias("close_time_ms"),
        from_epoch_ms(open_ms + (HOUR_MS - 1)).alias("close_time_utc"),
        "quote_asset_volume",
        "number_of_trades",
        "taker_buy_base_asset_volume",
        "taker_buy_quote_asset_volume",
        loaded_at.cast("timestamp").alias("loaded_at"),
        "batch_id",
    ).select(*RAW_COLUMNS)


def klines_dirty(norm: DataFrame) -> DataFrame:
    """Deduplicated bars with four independent kinds of damage.

    Fixed values: with h = open_time_ms div 3600000, symbol := 'UNKNOWN' when
    h % 79 = 0; high := low * 0.5 when h % 97 = 0; close := NULL when
    h % 83 = 0; volume := -1 when h % 89 = 0.
    """
    h = F.expr(f"open_time_ms div {HOUR_MS}")
    return norm.withColumns(
        {
            "symbol": F.when(h % 79 == 0, F.lit("UNKNOWN")).otherwise(F.col("symbol")),
            "high": F.when(h % 97 == 0, F.col("low") * 0.5).otherwise(F.col("high")),
            "close": F.when(h % 83 == 0, F.lit(None).cast("double")).otherwise(F.col("close")),
            "volume": F.when(h % 89 == 0, F.lit(-1.0)).otherwise(F.col("volume")),
        }
    )


def features_tampered(features: DataFrame) -> DataFrame:
    """return_1h := coalesce(return_1h, 0); log_return_1h + 0.1
    on even hours; price_range - 5."""
    even = F.hour("open_time_utc") % 2 == 0
    return features.withColumns(
        {
            "return_1h": F.coalesce(F.col("return_1h"), F.lit(0.0)),
            "log_return_1h": F.when(even, F.col("log_return_1h") + 0.1).otherwise(F.col("log_return_1h")),
            "price_range": F.col("price_range") - 5,
        }
    )


def jobs(events: DataFrame) -> DataFrame:
    """Warehouse job log. user = 'user' || user_id % 5 ||
    '@example.com'; click/view/purchase are QUERY jobs, the rest LOAD;
    processed = event_id * 1000 bytes; billed = (event_id % 7 + 1) * 10485760."""
    return events.select(
        F.col("ts").cast("timestamp").alias("creation_time"),
        F.concat(F.lit("user"), (F.col("user_id") % 5).cast("string"), F.lit("@example.com")).alias("user_email"),
        F.when(F.col("event_type").isin("click", "view", "purchase"), "QUERY").otherwise("LOAD").alias("job_type"),
        (F.col("event_id") * 1000).alias("total_bytes_processed"),
        ((F.col("event_id") % 7 + 1) * 10485760).alias("total_bytes_billed"),
    )


def landed_bars(raw: DataFrame) -> DataFrame:
    """The bars in the landing zone: the re-delivery replaced its days."""
    again = F.col("open_time_utc") >= F.lit(BATCH_2_FROM).cast("timestamp")
    return raw.filter(F.col("batch_id") == F.when(again, BATCH_2[0]).otherwise(BATCH_1[0]))


def payloads(raw: DataFrame) -> DataFrame:
    """Landed exchange payloads of both batches: one JSON string per (symbol,
    interval, day), an array of 12-element string arrays, plus one extra payload
    holding a short row and a row with a non-numeric open.

    Columns: source, dataset, symbol, interval, date, payload.
    """
    num = lambda c: F.col(c).cast("string")
    row = F.array(*[num(name) for name, _ in KLINE_ARRAY_FIELDS], F.lit("0"))
    per_day = (
        landed_bars(raw)
        .select(
            "source",
            "dataset",
            "symbol",
            "interval",
            F.to_date("open_time_utc").alias("date"),
            F.struct(F.col("open_time_ms").alias("t"), row.alias("r")).alias("item"),
        )
        .groupBy("source", "dataset", "symbol", "interval", "date")
        # rows of one day are bounded by the interval (24 for 1h bars)
        .agg(F.to_json(F.transform(F.array_sort(F.collect_list("item")), lambda s: s["r"])).alias("payload"))
    )
    bad = raw.sparkSession.createDataFrame(
        [
            (
                SOURCE,
                DATASET,
                "BTCUSDT",
                INTERVAL,
                '[["1704067200000","1","2","0.5","1.5","10","1704070799999","15","3","1"],'
                '["1704070800000","abc","2","0.5","1.5","10","1704074399999","15","3","1","1","0"]]',
            )
        ],
        "source string, dataset string, symbol string, interval string, payload string",
    ).withColumn("date", F.lit("2024-01-01").cast("date"))
    return per_day.unionByName(bad)
