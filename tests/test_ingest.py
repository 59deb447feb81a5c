"""Raw-zone writes (K1, K2), range loads (I1, I3), marks (I4, I5), raw table (K3)."""

from __future__ import annotations

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from candlewick.functions import day_start_ms
from candlewick.plans import ingest
from candlewick.sources import raw as raw_src
from tests.helpers import bars

D1, D2, D3 = dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3)


def test_partition_path_layout(spark, tmp_root):
    ingest.write_partitions(bars(spark, D1, 24), tmp_root)
    dirs = glob.glob(os.path.join(tmp_root, "source=*/dataset=*/symbol=*/interval=*/date=*"))
    rel = [os.path.relpath(d, tmp_root) for d in dirs]
    assert rel == ["source=binance_spot/dataset=klines/symbol=BTCUSDT/interval=1h/date=2024-01-01"]
    assert len(glob.glob(os.path.join(dirs[0], "*.parquet"))) == 1  # one file per partition


def test_idempotent_rewrite_and_other_partitions_survive(spark, tmp_root):
    ingest.write_partitions(bars(spark, D1, 48), tmp_root)  # two days
    ingest.write_partitions(bars(spark, D1, 24, batch_id="t-002"), tmp_root)  # day 1 again
    scanned = raw_src.scan_raw(spark, tmp_root)
    assert scanned.count() == 48
    by_day = {r["date"]: r["b"] for r in scanned.groupBy("date").agg(F.max("batch_id").alias("b")).collect()}
    assert by_day == {D1: "t-002", D2: "t-001"}


def test_rows_sorted_and_microsecond_timestamps(spark, tmp_root):
    ingest.write_partitions(bars(spark, D1, 24), tmp_root)
    files = glob.glob(os.path.join(tmp_root, "**", "*.parquet"), recursive=True)
    import pyarrow.parquet as pq

    t = pq.read_table(files[0])
    assert str(t.schema.field("open_time_utc").type) == "timestamp[us, tz=UTC]"
    ms = t.column("open_time_ms").to_pylist()
    assert ms == sorted(ms)


def test_duplicate_and_wrong_date_rejected(spark, tmp_root):
    ingest.write_partitions(bars(spark, D1, 48), tmp_root)  # days 1 and 2 exist
    dup = bars(spark, D1, 24, batch_id="t-9").unionByName(bars(spark, D1, 1, batch_id="t-9"))
    with pytest.raises(Exception, match="duplicate open_time_ms"):
        ingest.write_partitions(dup, tmp_root)
    wrong = bars(spark, D1, 1, batch_id="t-9").withColumn("date", F.lit(D2))
    with pytest.raises(Exception, match="row date differs"):
        ingest.write_partitions(wrong, tmp_root)
    # nothing was committed: both days still hold the first write only
    scanned = raw_src.scan_raw(spark, tmp_root)
    assert scanned.count() == 48 and scanned.filter(F.col("batch_id") == "t-9").count() == 0


def test_backfill_inclusive_and_empty_days(spark, tmp_root):
    landed = bars(spark, D1, 24 * 5, skip_days=(D2,))
    summary = ingest.run_backfill(landed, tmp_root, D1, D3).orderBy("date").collect()
    assert [r["date"] for r in summary] == [D1, D3]  # the empty day writes nothing
    assert [r["row_count"] for r in summary] == [24, 24]
    assert summary[0]["min_open_time_ms"] == day_start_ms(D1)
    assert summary[1]["max_open_time_ms"] == day_start_ms(D3) + 23 * 3_600_000
    with pytest.raises(ValueError):
        ingest.backfill_rows(landed, D3, D1)
    with pytest.raises(ValueError, match="unsupported interval"):
        ingest.backfill_rows(landed, D1, D3, intervals=["4h"])
    assert ingest.backfill_rows(landed, D1, D1, intervals=["1h"]).count() == 24


def test_marks_round_trip(spark, tmp_root):
    marks = ingest.high_water_marks(bars(spark, D1, 30), updated_at=dt.datetime(2024, 1, 5, 6, 7, 8))
    state = os.path.join(tmp_root, "state")
    ingest.write_marks(marks, state)
    back = ingest.read_marks(spark, state).collect()
    assert len(back) == 1
    assert back[0]["last_open_time_ms"] == day_start_ms(D1) + 29 * 3_600_000
    assert back[0]["updated_at"] == dt.datetime(2024, 1, 5, 6, 7, 8)
    assert ingest.read_marks(spark, os.path.join(tmp_root, "absent")).count() == 0


def test_incremental_bootstrap_then_noop(spark, tmp_root):
    root, state = os.path.join(tmp_root, "raw"), os.path.join(tmp_root, "state")
    landed = bars(spark, D1, 24 * 3)
    first = ingest.run_incremental(landed, root, state, bootstrap=D1, end=D1)
    assert (first.partitions_written, first.rows_written) == (1, 24)
    mark = first.marks_after.collect()[0]["last_open_time_ms"]
    assert mark == day_start_ms(D1) + 23 * 3_600_000  # 2024-01-01T23:00
    # mark at 2024-01-01T23:00 and end 2024-01-01 -> start 2024-01-02 > end: no-op
    again = ingest.run_incremental(landed, root, state, bootstrap=D1, end=D1)
    assert (again.partitions_written, again.rows_written) == (0, 0)
    assert again.marks_after.collect()[0]["last_open_time_ms"] == mark
    # next run continues the day after the mark
    nxt = ingest.run_incremental(landed, root, state, bootstrap=D1, end=D3)
    assert (nxt.partitions_written, nxt.rows_written) == (2, 48)
    assert raw_src.scan_raw(spark, root).count() == 72


def test_incremental_mark_mid_day_skips_rest_of_day(spark):
    landed = bars(spark, D1, 48)
    marks = ingest.high_water_marks(landed.filter(F.col("open_time_ms") < day_start_ms(D1) + 12 * 3_600_000))
    rows = ingest.incremental_rows(landed, marks, D1, D2)
    assert rows.agg(F.min("open_time_ms")).first()[0] == day_start_ms(D2)


def test_raw_table_rebuild(spark, tmp_root):
    raw = bars(spark, D1, 48).unionByName(bars(spark, D1, 24, symbol="ETHUSDT"))
    path = os.path.join(tmp_root, "raw_klines")
    raw_src.write_raw_table(raw, path)
    table = raw_src.read_raw_table(spark, path)
    assert table.count() == 72
    assert sorted(raw_src.raw_table(spark, path).commit().parts) == ["open_date=2024-01-01", "open_date=2024-01-02"]
    # full rebuild truncates
    raw_src.write_raw_table(bars(spark, D1, 1), path)
    assert raw_src.read_raw_table(spark, path).count() == 1


def test_load_raw_table_whole_root_or_glob(spark, tmp_root):
    zone, table = os.path.join(tmp_root, "zone"), os.path.join(tmp_root, "raw_klines")
    ingest.write_partitions(bars(spark, D1, 48).unionByName(bars(spark, D1, 24, symbol="ETHUSDT")), zone)
    full = raw_src.load_raw_table(spark, zone, table)
    assert full.count() == 72 and full.select("symbol").distinct().count() == 2
    one = raw_src.load_raw_table(spark, zone, table, "source=*/dataset=klines/symbol=ETHUSDT/interval=1h/date=*")
    assert one.count() == 24 and {r[0] for r in one.select("symbol").distinct().collect()} == {"ETHUSDT"}


def test_mark_is_the_newest_bar_of_this_run(spark, tmp_root):
    """A later day already in the raw zone doesn't push the mark past days that
    were not loaded."""
    root, state = os.path.join(tmp_root, "raw"), os.path.join(tmp_root, "state")
    ingest.write_partitions(bars(spark, dt.date(2024, 1, 8), 12), root)
    landed = bars(spark, D1, 24 * 4 + 19)
    result = ingest.run_incremental(landed, root, state, bootstrap=D1, end=dt.date(2024, 1, 7))
    assert result.marks_after.collect()[0]["last_open_time_ms"] == day_start_ms(dt.date(2024, 1, 5)) + 18 * 3_600_000
    assert result.outputs.count() == 5
    assert [r["start_date"] for r in result.starts.collect()] == [D1]
    rest = ingest.run_incremental(bars(spark, D1, 24 * 8), root, state, bootstrap=D1, end=dt.date(2024, 1, 7))
    assert rest.rows_written == 48 and rest.starts.collect()[0]["start_date"] == dt.date(2024, 1, 6)


def test_only_keys_without_a_mark_start_at_the_bootstrap(spark):
    landed = bars(spark, D1, 24 * 4).unionByName(bars(spark, D1, 24 * 4, symbol="ETHUSDT"))
    marks = ingest.high_water_marks(landed.filter((F.col("symbol") == "BTCUSDT") & (F.col("open_time_ms") < day_start_ms(D3))))
    keys = landed.select("source", "dataset", "symbol", "interval").distinct()
    starts = ingest.start_dates(marks)
    assert ingest.first_day(starts, keys.filter(F.col("symbol") == "BTCUSDT"), D1) == D3
    assert ingest.first_day(starts, keys, D1) == D1
    rows = ingest.incremental_rows(landed, marks, D1, dt.date(2024, 1, 4))
    assert {r["symbol"]: r["count"] for r in rows.groupBy("symbol").count().collect()} == {"BTCUSDT": 48, "ETHUSDT": 96}


def test_null_in_a_required_column_fails_the_raw_load(spark, tmp_root):
    path = os.path.join(tmp_root, "raw_klines")
    raw_src.write_raw_table(bars(spark, D1, 24), path)
    bad = bars(spark, D1, 48).withColumn("close", F.when(F.col("open") < 110, F.col("close")))
    with pytest.raises(Exception, match="required column close is NULL"):
        raw_src.write_raw_table(bad, path)
    assert raw_src.read_raw_table(spark, path).count() == 24


def _spoiled(landed):
    """high -1 on every tenth bar, a missing close on every seventeenth."""
    n = F.expr("open_time_ms div 3600000")
    return landed.withColumns({
        "high": F.when(n % 10 == 0, F.lit(-1.0)).otherwise(F.col("high")),
        "close": F.when(n % 17 == 0, F.lit(None).cast("double")).otherwise(F.col("close")),
    })


def test_invalid_rows_never_reach_the_raw_zone(spark, tmp_root):
    from candlewick import session
    from candlewick.operators.validate import validate_rows

    before = session.list_names(spark, f"{session.ensure_checkpoint_dir(spark)}/staged")
    root, rejects, state = (os.path.join(tmp_root, n) for n in ("raw", "rejects", "state"))
    landed = _spoiled(bars(spark, D1, 24 * 4))
    ok, bad = validate_rows(landed)
    assert 0 < ok.count() < 96
    # without a place for rejects, nothing at all is written
    with pytest.raises(ingest.InvalidRows, match="high must be > 0|close is missing"):
        ingest.run_backfill(landed, root, D1, D3)
    with pytest.raises(ingest.InvalidRows):
        ingest.run_incremental(landed, root, state, D1, D3)
    assert not os.path.exists(root) and ingest.read_marks(spark, state).count() == 0
    summary = ingest.run_backfill(landed, root, D1, D2, rejects, "first")
    again = ingest.run_backfill(landed, root, D1, D2, rejects, "first")  # replaces its own rejects
    assert sorted(summary.collect()) == sorted(again.collect())
    result = ingest.run_incremental(landed, root, state, D3, dt.date(2024, 1, 4), rejects_path=rejects, run_id="second")
    stored = raw_src.scan_raw(spark, root)
    assert stored.count() == ok.count() and validate_rows(stored)[1].count() == 0
    assert result.rows_written == stored.filter(F.col("date") >= F.lit(D3)).count()
    filed = ingest.read_rejects(spark, rejects)
    assert sorted((r.open_time_ms, r.reason) for r in filed.collect()) == sorted(
        (r.open_time_ms, r.reason) for r in bad.select("open_time_ms", "reason").collect())
    assert {r[0] for r in filed.select("run").distinct().collect()} == {"first", "second"}
    assert ingest.read_rejects(spark, os.path.join(tmp_root, "none")).count() == 0
    # what results still read goes when they are done with
    assert summary.count() == 2 and result.outputs.count() == 2
    session.drop_lasting(spark)
    assert set(session.list_names(spark, f"{session.ensure_checkpoint_dir(spark)}/staged")) <= set(before)


def test_a_day_of_invalid_rows_moves_no_mark(spark, tmp_root):
    root, rejects, state = (os.path.join(tmp_root, n) for n in ("raw", "rejects", "state"))
    landed = bars(spark, D1, 48).withColumn("low", F.when(F.col("open_time_ms") >= day_start_ms(D2), F.lit(0.0)).otherwise(F.col("low")))
    result = ingest.run_incremental(landed, root, state, D1, D2, rejects_path=rejects)
    assert result.rows_written == 24
    assert result.marks_after.collect()[0]["last_open_time_ms"] == day_start_ms(D1) + 23 * 3_600_000
    assert ingest.read_rejects(spark, rejects).count() == 24
