"""All-or-nothing tables, file layout, life of staged folders."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from candlewick import session
from candlewick.operators import marts, staging
from candlewick.operators.layout import clustered_by_day, day_cuts
from candlewick.plans import merge
from candlewick.sources import raw as raw_src
from candlewick.sources import versioned
from candlewick.sources.versioned import ConcurrentWrite, VersionedTable
from tests.helpers import bars

D1 = dt.date(2024, 1, 1)


def _prices(raw):
    return marts.fact_prices(staging.int_klines_normalized(staging.stg_klines(raw)))


def _failing(df):
    """Fails in the write's own stage, after every shuffle."""
    bad = F.when(F.col("close") > 140, F.raise_error(F.lit("lost in the last stage"))).otherwise(F.lit(None).cast("string"))
    shuffled = df.repartition(4, "open_time_utc")
    return shuffled.withColumn("_x", bad).filter(F.col("_x").isNull()).drop("_x")


@pytest.mark.parametrize("scheme", ["", "file://"])
def test_a_write_that_fails_in_its_last_stage_leaves_the_old_rows(spark, tmp_root, scheme):
    path = f"{scheme}{tmp_root}/raw"
    raw_src.write_raw_table(bars(spark, D1, 48), path)
    table = raw_src.raw_table(spark, path)
    with pytest.raises(Exception, match="lost in the last stage"):
        # straight into the write: no shuffle between the failure and the files
        table.write(_failing(raw_src.read_raw_table(spark, path).unionByName(
            bars(spark, D1, 72).withColumn("open_date", F.to_date("open_time_utc")))))
    assert raw_src.read_raw_table(spark, path).count() == 48
    assert len(session.list_names(spark, f"{path}/data")) == 1  # the failed write's folder is gone


def test_failed_rebuild_of_the_fact(spark, tmp_root):
    path = f"{tmp_root}/fact"
    merge.merge_into(spark, path, _prices(bars(spark, D1, 30)))
    for full in (True, False):
        with pytest.raises(Exception, match="lost in the last stage"):
            merge.merge_into(spark, path, _failing(_prices(bars(spark, D1, 72))), full_refresh=full)
        assert merge.read_fact_prices(spark, path).count() == 30


def test_several_days_are_one_commit(spark, tmp_root, monkeypatch):
    """A run that stops after its days were written, before the commit: all old days;
    the next run brings all the new ones."""
    path = f"{tmp_root}/fact"
    merge.merge_into(spark, path, _prices(bars(spark, D1, 30)))
    old = sorted(merge.read_fact_prices(spark, path).collect())
    more = _prices(bars(spark, D1, 24 * 4, price=500.0, batch_id="t-2"))

    def stop(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(versioned, "create_file", stop)
        with pytest.raises(KeyboardInterrupt):
            merge.merge_into(spark, path, more)
    assert sorted(merge.read_fact_prices(spark, path).collect()) == old
    merge.merge_into(spark, path, more)
    days = {r["open_date"]: r["count"] for r in merge.read_fact_prices(spark, path).groupBy("open_date").count().collect()}
    assert days == {D1 + dt.timedelta(days=i): 24 for i in range(4)}


def test_two_writers_cannot_both_commit(spark, tmp_root, monkeypatch):
    table = VersionedTable(spark, f"{tmp_root}/t")
    table.write(spark.range(3).toDF("x"))
    first = table.commit()
    table.write(spark.range(4).toDF("x"))
    with monkeypatch.context() as m:
        m.setattr(VersionedTable, "commit", lambda self, version=None: first)
        with pytest.raises(ConcurrentWrite):
            table.write(spark.range(9).toDF("x"))
    assert table.read().count() == 4 and table.read(version=1).count() == 3


def test_empty_old_and_null_partitions(spark, tmp_root):
    table = VersionedTable(spark, f"{tmp_root}/t", "d")
    assert not table.exists() and table.commit() is None
    with pytest.raises(FileNotFoundError):
        table.read()
    schema = "x long, d date"
    table.write(spark.createDataFrame([], schema), digests=True)
    assert table.exists() and table.read().count() == 0 and table.read().columns == ["x", "d"]
    table.write(spark.createDataFrame([(1, D1), (2, None), (3, None)], schema), digests=True, notes={"k": 1})
    parts = table.commit().parts
    assert {p: e["rows"] for p, e in parts.items()} == {"d=2024-01-01": 1, "d=__HIVE_DEFAULT_PARTITION__": 2}
    assert sorted(table.read().collect(), key=lambda r: r.x) == [(1, D1), (2, None), (3, None)]
    # only what is touched or named goes; the notes stay
    table.write(spark.createDataFrame([(9, D1)], schema), replace="touched", drop=["d=__HIVE_DEFAULT_PARTITION__"])
    assert [tuple(r) for r in table.read().collect()] == [(9, D1)] and table.commit().notes == {"k": 1}
    with pytest.raises(ValueError, match="columns"):
        table.write(spark.createDataFrame([("a", D1)], "x string, d date"), replace="touched")
    # commits before the last two and their folders are gone
    assert table.versions() == [2, 3] and len(session.list_names(spark, f"{tmp_root}/t/data")) == 2


def test_digests_tell_content_not_order(spark, tmp_root):
    one, two = VersionedTable(spark, f"{tmp_root}/a", "d"), VersionedTable(spark, f"{tmp_root}/b", "d")
    df = spark.range(100).selectExpr("id AS x", "CAST('2024-01-01' AS DATE) AS d")
    a = one.write(df.repartition(5), digests=True).parts["d=2024-01-01"]
    b = two.write(df.orderBy(F.desc("x")), digests=True).parts["d=2024-01-01"]
    c = two.write(df.withColumn("x", F.when(F.col("x") == 7, 8).otherwise(F.col("x"))), digests=True).parts["d=2024-01-01"]
    assert (a["rows"], a["digest"]) == (b["rows"], b["digest"]) and c["rows"] == 100 and c["digest"] != a["digest"]


# --- layout -----------------------------------------------------------------------

def test_a_heavy_day_is_cut_into_disjoint_ranges(spark, tmp_root):
    """One day holds most rows: its files hold disjoint (series, time) ranges and no task
    gets more than its share."""
    heavy = [bars(spark, D1, 24, symbol=f"S{i:03d}") for i in range(60)]
    raw = heavy[0]
    for more in heavy[1:]:
        raw = raw.unionByName(more)
    raw = raw.unionByName(bars(spark, D1, 24 * 20, symbol="S000"))
    path = f"{tmp_root}/raw"
    raw_src.write_raw_table(raw, path, file_rows=200)
    assert raw_src.read_raw_table(spark, path).count() == 60 * 24 + 480
    day = raw_src.read_raw_table(spark, path).filter(F.col("open_date") == F.lit(D1))
    at = F.struct("symbol", "interval", "open_time_utc")
    files = day.groupBy(F.input_file_name().alias("f")).agg(F.min(at).alias("lo"), F.max(at).alias("hi"), F.count("*").alias("n"))
    ranges = sorted((r.lo, r.hi, r.n) for r in files.collect())
    assert len(ranges) >= 7 and max(n for *_, n in ranges) <= 224
    assert all(hi < lo for (_, hi, _), (lo, _, _) in zip(ranges, ranges[1:]))
    # light days share a task
    tasks = clustered_by_day(raw.withColumn("open_date", F.to_date("open_time_utc")), file_rows=200, series=("symbol", "interval"))
    sizes = [r["count"] for r in tasks.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) <= 224 and len(sizes) <= 11


def test_cuts_of_no_rows_and_null_series(spark):
    schema = "symbol string, bar_interval string, open_time_utc timestamp, open_date date, x long"
    none = spark.createDataFrame([], schema)
    assert day_cuts(none, 10).count() == 0 and clustered_by_day(none).count() == 0
    rows = [(None, "1h", dt.datetime(2024, 1, 1, h), D1, h) for h in range(20)] + [("A", None, None, None, 1)]
    out = clustered_by_day(spark.createDataFrame(rows, schema), file_rows=5)
    assert out.count() == 21 and out.agg(F.sum("x")).first()[0] == 191


# --- staged folders ---------------------------------------------------------------

def _staged(spark):
    return session.list_names(spark, f"{session.ensure_checkpoint_dir(spark)}/staged")


def test_staged_folders_go_with_their_run(spark):
    before = _staged(spark)

    def put(name, lasting=False):
        path = session.scratch_path(spark, name, lasting)
        spark.range(1).write.parquet(path)
        return path

    with session.staged_run(spark):
        with session.staged_run(spark):
            put("inner")
            kept = put("kept", lasting=True)
        assert _staged(spark) != before and spark.read.parquet(kept).count() == 1
    assert _staged(spark) == before
    with pytest.raises(RuntimeError):
        with session.staged_run(spark):
            put("failed")
            raise RuntimeError
    assert _staged(spark) == before


def test_dropping_lasting_folders_leaves_what_no_run_staged(spark):
    own = session.scratch_path(spark, "own")
    spark.range(3).write.parquet(own)
    with session.staged_run(spark):
        result = session.scratch_path(spark, "result", lasting=True)
        spark.range(1).write.parquet(result)
    session.drop_lasting(spark)
    assert not session.table_exists(spark, result) and spark.read.parquet(own).count() == 3


def test_no_staged_folder_is_left_after_merges(spark, tmp_root):
    before = _staged(spark)
    for hours in (30, 50, 50):
        merge.merge_into(spark, f"{tmp_root}/fact", _prices(bars(spark, D1, hours)))
    with pytest.raises(ValueError):
        dup = _prices(bars(spark, D1, 60))
        merge.merge_into(spark, f"{tmp_root}/fact", dup.unionByName(dup))
    assert _staged(spark) == before
