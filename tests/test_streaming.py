"""The availableNow file stream gives the same raw zone as the batch path,
and a second run consumes only newly landed files."""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import functions as F

from candlewick.operators import marts, staging
from candlewick.plans import ingest, merge
from candlewick.sources import fixtures
from candlewick.sources import raw as raw_src
from candlewick.sources.payload import enrich_raw, parse_klines
from candlewick.streaming import incremental
from tests.helpers import bars

LOADED = dt.datetime(2024, 2, 1)


def test_stream_matches_batch(spark, g01, tmp_root):
    landed = g01.payloads.select(*incremental.LANDED.fieldNames())
    landing = os.path.join(tmp_root, "landing")
    early = landed.filter(F.col("date") < F.lit(dt.date(2024, 1, 15)))
    late = landed.filter(F.col("date") >= F.lit(dt.date(2024, 1, 15)))
    early.write.parquet(os.path.join(landing, "part=1"))

    raw_root, state = os.path.join(tmp_root, "raw"), os.path.join(tmp_root, "state")
    ckpt, rejects = os.path.join(tmp_root, "ckpt"), os.path.join(tmp_root, "rejects")
    fact = os.path.join(tmp_root, "fact_prices")
    q = incremental.start(spark, landing, raw_root, state, ckpt, loaded_at=LOADED, rejects_path=rejects, fact_path=fact)
    q.awaitTermination(300)
    first = raw_src.scan_raw(spark, raw_root).count()
    assert first > 0

    late.write.parquet(os.path.join(landing, "part=2"))
    q = incremental.start(spark, landing, raw_root, state, ckpt, loaded_at=LOADED, rejects_path=rejects, fact_path=fact)
    q.awaitTermination(300)

    streamed = raw_src.scan_raw(spark, raw_root).drop("batch_id", "date")
    rows, _ = parse_klines(landed)
    batch_root = os.path.join(tmp_root, "batch")
    ingest.write_partitions(enrich_raw(rows, loaded_at=LOADED, batch_id="b"), batch_root)
    batch = raw_src.scan_raw(spark, batch_root).drop("batch_id", "date")
    assert streamed.count() == batch.count() == 3385
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0
    # the two malformed rows were set aside with their reasons
    assert spark.read.parquet(rejects).count() == 2
    marks = {r["symbol"]: r["last_open_time_ms"] for r in ingest.read_marks(spark, state).collect()}
    newest = {r["symbol"]: r["m"] for r in batch.groupBy("symbol").agg(F.max("open_time_ms").alias("m")).collect()}
    assert marks == newest
    # the merged fact equals the batch-built fact (load stamps aside)
    streamed_fact = merge.read_fact_prices(spark, fact).drop("loaded_at", "batch_id")
    batch_raw = enrich_raw(rows, loaded_at=LOADED, batch_id="b")
    batch_fact = marts.fact_prices(staging.int_klines_normalized(staging.stg_klines(batch_raw))).drop(
        "loaded_at", "batch_id"
    )
    assert streamed_fact.count() == 3385
    assert streamed_fact.exceptAll(batch_fact).count() == 0 and batch_fact.exceptAll(streamed_fact).count() == 0


def _landed(spark, raw):
    return fixtures.payloads(raw).select(*incremental.LANDED.fieldNames()).filter(F.size(F.from_json("payload", "array<array<string>>")) > 2)


def test_a_day_in_two_files_keeps_both_halves(spark, tmp_root):
    raw_root, state = f"file://{tmp_root}/raw", f"file://{tmp_root}/state"
    day = bars(spark, dt.date(2024, 1, 3), 7, batch_id="batch-001")
    cut = F.hour("open_time_utc") < 4
    for n, part in enumerate((day.filter(cut), day.filter(~cut))):
        incremental.process_batch(_landed(spark, part), raw_root, state, f"stream-{n}", LOADED)
    assert raw_src.scan_raw(spark, raw_root).count() == 7


def test_a_retried_batch_writes_the_same_rejects(spark, g01, tmp_root):
    raw_root, state, rejects = (os.path.join(tmp_root, x) for x in ("raw", "state", "rejects"))
    bad = g01.payloads.filter(F.col("payload").contains("abc"))
    for _ in range(2):
        incremental.process_batch(bad, raw_root, state, "stream-000001", LOADED, rejects)
    assert spark.read.parquet(rejects).count() == 2


def test_two_stream_batches_on_a_uri(spark, tmp_root):
    root = f"file://{tmp_root}"
    for n in (0, 1):
        part = bars(spark, dt.date(2024, 1, 1 + 5 * n), 120, batch_id="batch-001")
        incremental.process_batch(
            _landed(spark, part), f"{root}/raw", f"{root}/state", f"stream-{n}", LOADED, fact_path=f"{root}/fact"
        )
    assert merge.read_fact_prices(spark, f"{root}/fact").count() == 240


def test_micro_batches_leave_no_staged_folder(spark, tmp_root):
    from candlewick import session

    folder = f"{session.ensure_checkpoint_dir(spark)}/staged"
    before = session.list_names(spark, folder)
    raw = bars(spark, dt.date(2024, 1, 1), 72, batch_id="batch-001")
    for n in range(3):
        part = raw.filter(F.dayofmonth("open_time_utc") == n + 1)
        incremental.process_batch(
            fixtures.payloads(part), f"{tmp_root}/raw", f"{tmp_root}/marks", f"s-{n}", rejects_path=f"{tmp_root}/rejects",
            fact_path=f"{tmp_root}/fact",
        )
    assert session.list_names(spark, folder) == before
