"""The incremental load as a Structured Streaming job.

Landed payload files (one row per series-day: source, dataset, symbol,
interval, date, payload) are read as a file stream; every micro-batch is
parsed, validated and written to the raw zone with the same idempotent
partition overwrite as the batch path, and the high-water marks are advanced
after the data. ``trigger(availableNow=True)`` processes what has landed and
stops, so the job can run on a schedule; the stream checkpoint records which
files were consumed, and the micro-batch id fixes the batch_id, so a retried
micro-batch rewrites the same partitions with the same rows. With
``fact_path`` each micro-batch is also merged into fact_prices on the natural
key (same merge as the batch build).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from candlewick.operators import marts, staging
from candlewick.operators.validate import validate_rows
from candlewick.plans import ingest, merge
from candlewick.plans.ingest import _stage
from candlewick.schema import RAW_COLUMNS, RAW_PARTITION_COLUMNS, WATERMARK_KEY
from candlewick.session import ensure_session_conf, staged_run, table_exists
from candlewick.sources.payload import enrich_raw, parse_klines
from candlewick.sources.raw import scan_raw

LANDED = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("dataset", T.StringType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("interval", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("payload", T.StringType()),
    ]
)


def process_batch(
    landed: DataFrame,
    raw_root: str,
    state_path: str,
    batch_id: str,
    loaded_at: dt.datetime | None = None,
    rejects_path: str | None = None,
    fact_path: str | None = None,
) -> dict:
    """One micro-batch (also usable on a static DataFrame): parse -> validate
    -> write raw partitions -> advance marks of the written keys -> (with
    ``fact_path``) merge the batch's bars into fact_prices."""
    # one load time for every write of this batch (raw zone and fact)
    loaded_at = loaded_at or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    spark = landed.sparkSession
    with staged_run(spark):  # an endless stream leaves nothing behind
        rows, parse_rejects = parse_klines(landed)
        ok, rejects = validate_rows(rows)
        if rejects_path is not None:
            # filed by batch and overwritten: a retried micro-batch writes the same
            (
                parse_rejects.select(*WATERMARK_KEY, "row_index", "reason")
                .unionByName(rejects.select(*WATERMARK_KEY, F.lit(None).cast("long").alias("row_index"), "reason"))
                .withColumn("batch_id", F.lit(batch_id))
                .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id")
                .parquet(rejects_path)
            )
        # parsed and validated once; everything below reads the staged rows
        raw = _stage(enrich_raw(ok, loaded_at=loaded_at, batch_id=batch_id).select(*RAW_COLUMNS), "stream-rows")
        ingest.write_partitions(with_stored_bars(raw, raw_root), raw_root)
        written = raw.groupBy(*WATERMARK_KEY).agg(F.max("open_time_ms").alias("last_open_time_ms"))
        current = ingest.read_marks(spark, state_path)
        # a mark only moves forward (a late, older day does not pull it back)
        merged = _stage(
            written.join(current.select(*WATERMARK_KEY, F.col("last_open_time_ms").alias("_old")), list(WATERMARK_KEY), "left")
            .select(*WATERMARK_KEY, F.greatest("last_open_time_ms", F.coalesce("_old", F.lit(0))).alias("last_open_time_ms"))
            .withColumn("updated_at", F.current_timestamp()),
            "stream-marks",  # the state folder is rewritten below
        )
        n = merged.count()
        if n:
            ingest.write_marks(merged, state_path)
        if fact_path is not None and n:
            bars = marts.fact_prices(staging.int_klines_normalized(staging.stg_klines(raw)))
            merge.merge_into(spark, fact_path, bars, per_symbol=True)
        return {"keys": n}


def with_stored_bars(raw: DataFrame, raw_root: str) -> DataFrame:
    """The batch's rows and the stored bars of the same raw partitions: a day
    that lands in several files keeps the bars of the earlier ones. Of one open
    time the latest load stays. Staged, as those partitions are overwritten."""
    spark = raw.sparkSession
    every = ingest.with_date(raw)
    if table_exists(spark, raw_root):
        days = every.select(*RAW_PARTITION_COLUMNS).distinct()
        low, high = days.agg(F.min("date"), F.max("date")).first()  # literal bounds prune folders
        stored = scan_raw(spark, raw_root).filter(F.col("date").between(F.lit(low), F.lit(high)))
        kept = stored.join(days, list(RAW_PARTITION_COLUMNS), "left_semi").select(*every.columns)
        every = kept.unionByName(every)
    latest = staging.latest_per_key(every, [*RAW_PARTITION_COLUMNS, "open_time_ms"])
    return _stage(latest, "stream-partitions")


def start(
    spark: SparkSession,
    landing_dir: str,
    raw_root: str,
    state_path: str,
    checkpoint_dir: str,
    loaded_at: dt.datetime | None = None,
    rejects_path: str | None = None,
    fact_path: str | None = None,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Start the file stream; with ``available_now`` it stops by itself once
    every landed file is processed."""
    ensure_session_conf(spark)
    reader = spark.readStream.schema(LANDED)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(landing_dir)

    def each(df: DataFrame, epoch_id: int) -> None:
        process_batch(df, raw_root, state_path, f"stream-{epoch_id:06d}", loaded_at, rejects_path, fact_path)

    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint_dir)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
