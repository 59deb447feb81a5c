"""Raw-zone scans and the raw table.

Raw zone layout (one Parquet file per partition, deterministic path)::

    <root>/source=<s>/dataset=<d>/symbol=<sym>/interval=<i>/date=<yyyy-mm-dd>/

The raw table (a ``VersionedTable``: a rebuild is all or nothing) keeps the 19
declared columns, is day-partitioned by ``open_date`` and its files hold disjoint
(symbol, interval, open_time_utc) ranges, so day predicates prune directories and
row-group statistics skip other symbols.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.operators.layout import DEFAULT_FILE_ROWS, clustered_by_day
from candlewick.schema import RAW_COLUMNS, RAW_KLINES
from candlewick.session import ensure_session_conf
from candlewick.sources.versioned import VersionedTable

# All 19 columns of the raw table are REQUIRED.
REQUIRED_COLUMNS = tuple(RAW_COLUMNS)

# Partition columns in the raw-zone path; the file also stores symbol and
# interval, and a same-named path value wins on read.
_PATH_SCHEMA = T.StructType(
    [f for f in RAW_KLINES.fields] + [T.StructField("date", T.DateType(), True)]
)


def scan_raw(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """Read landed raw partitions under ``root`` (optionally one glob below it,
    e.g. ``source=*/dataset=klines/symbol=BTCUSDT/interval=1h/date=*``).

    The schema is declared; nothing is inferred. Predicates on the path
    columns (symbol, interval, date) prune directories.
    """
    ensure_session_conf(spark)
    path = f"{root.rstrip('/')}/{glob}" if glob else root
    return (
        spark.read.schema(_PATH_SCHEMA)
        .option("basePath", root)
        .parquet(path)
    )


def raw_records(landed: DataFrame) -> DataFrame:
    """Landed rows -> the 19 raw columns, types enforced."""
    return landed.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in RAW_KLINES.fields])


def require_columns(records: DataFrame, required: Sequence[str] = REQUIRED_COLUMNS) -> DataFrame:
    """Rows unchanged, but the job fails inside the task on a NULL in a required
    column, before the write commits anything."""
    guard = F.lit(None).cast("string")
    for c in reversed(list(required)):
        guard = F.when(F.col(c).isNull(), F.raise_error(F.lit(f"required column {c} is NULL"))).otherwise(guard)
    return records.withColumn("_missing", guard).filter(F.col("_missing").isNull()).drop("_missing")


def raw_table(spark: SparkSession, path: str) -> VersionedTable:
    return VersionedTable(spark, path, "open_date")


def write_raw_table(raw: DataFrame, path: str, file_rows: int = DEFAULT_FILE_ROWS) -> None:
    """Full rebuild of the raw table (truncate + load), day-partitioned. Whatever fails
    -- a NULL in a required column, a lost job in any stage -- leaves the old table in
    place: the new one counts once its commit is written.

    Rows are dealt by exact counts per (day, series, hour) (``clustered_by_day``);
    counting reads the key columns of ``raw`` once more.
    """
    records = raw_records(raw)
    day = F.to_date("open_time_utc").alias("open_date")
    table = require_columns(records).withColumn("open_date", day)
    keys = records.select("symbol", "interval", "open_time_utc", day)
    raw_table(raw.sparkSession, path).write(
        clustered_by_day(table, keys, file_rows, series=("symbol", "interval"))
    )


def read_raw_table(spark: SparkSession, path: str) -> DataFrame:
    return raw_table(spark, path).read().select(*RAW_COLUMNS, "open_date")


def load_raw_table(spark: SparkSession, landing_root: str, table_path: str, glob: str | None = None) -> DataFrame:
    """K3: rebuild the raw table from the raw zone (truncate + load).

    By default the whole root is loaded, so every symbol and interval stays in
    the table; a narrower ``glob`` (e.g. one symbol's folders) loads only
    those partitions -- and, as a full rebuild, drops everything else.
    Returns the rebuilt table.
    """
    write_raw_table(raw_records(scan_raw(spark, landing_root, glob)), table_path)
    return read_raw_table(spark, table_path)
