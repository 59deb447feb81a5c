"""Row-frame windows over time series that may be arbitrarily long.

A plain ``Window.partitionBy(series)`` puts every row of one series into one
task. A series can hold a third of all rows, so the windows here run over
fixed-size *blocks* of a series instead:

1. rows per (series, day) -- a partial aggregate, small;
2. running total of those counts per series = offset of each day (window over
   the small count table);
3. position = row_number within (series, day) + offset of the day. The
   (series, day) groups are bounded (keys are unique per day and interval);
4. block = (position - 1) div block_rows; the last ``halo`` rows of a block
   are also sent to the next block;
5. the caller's window runs partitioned by (series, block), ordered by
   position; halo rows are dropped afterwards.

Because every frame is a ROWS frame of at most ``halo`` preceding rows, the
blocked result equals the unblocked one exactly.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.schema import SERIES_KEY

# Rows per block: the unit a long series is split into. Blocks are hashed
# over the shuffle partitions; the halo costs halo/block_rows extra rows
# (24 / 100,000 = 0.024 %).
DEFAULT_BLOCK_ROWS = 100_000

POS, BLOCK, HALO = "_pos", "_block", "_halo"


def with_positions(
    df: DataFrame,
    series: Sequence[str] = SERIES_KEY,
    order: Sequence[Column | str] = ("open_time_utc",),
    bucket: Column | str = "open_date",
) -> DataFrame:
    """Add ``_pos``, the 1-based position of each row in its series.

    Rows per (series, day) come from a partial aggregate over the key columns
    only (on a stored table: a key-column scan); the offsets window runs on
    that small count table. The join back needs no shuffle of the rows: the
    row-numbering window already partitions them by the join keys.
    """
    bucket_col = F.col(bucket) if isinstance(bucket, str) else bucket
    # one struct is the key of the numbering window and of the join: it is
    # never null itself, so rows with NULL in the series are kept, and both use
    # one partitioning
    df = df.withColumn("_key", F.struct(*[F.col(c) for c in series], bucket_col.alias("_bucket")))
    local = df.withColumn("_local", F.row_number().over(Window.partitionBy("_key").orderBy(*order)))
    counts = df.groupBy("_key").agg(F.count(F.lit(1)).alias("_n"))
    before = (
        Window.partitionBy(*[f"_key.{c}" for c in series]).orderBy("_key._bucket")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = counts.select("_key", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    return (
        local.join(offsets, "_key")
        .withColumn(POS, F.col("_local") + F.col("_offset"))
        .drop("_local", "_offset", "_key")
    )


def blocked(df: DataFrame, block_rows: int, halo: int) -> DataFrame:
    """Assign ``_block``; rows in the last ``halo`` positions of a block are
    duplicated into the next block with ``_halo = true``."""
    if block_rows < max(halo, 1):
        raise ValueError(f"block_rows ({block_rows}) must be >= halo ({halo})")
    own = F.floor((F.col(POS) - 1) / F.lit(block_rows)).cast("long")
    in_tail = (F.col(POS) - 1) % block_rows >= block_rows - halo
    targets = F.when(in_tail & F.lit(halo > 0), F.array(own, own + 1)).otherwise(F.array(own))
    return (
        df.withColumn(BLOCK, F.explode(targets))
        .withColumn(HALO, F.col(BLOCK) != own)
    )


def series_window(
    df: DataFrame,
    compute: Callable[[DataFrame, Window], DataFrame],
    halo: int,
    series: Sequence[str] = SERIES_KEY,
    order: Sequence[str] = ("open_time_utc",),
    block_rows: int = DEFAULT_BLOCK_ROWS,
    bucket: Column | str = "open_date",
) -> DataFrame:
    """Run ``compute(df, window_spec)`` -- window expressions over each series
    whose frames reach at most ``halo`` rows back -- in blocks of
    ``block_rows``. NULLs in the series columns form series of their own."""
    blocks = blocked(with_positions(df, series, order, bucket), block_rows, halo)
    out = compute(blocks, Window.partitionBy(*series, BLOCK).orderBy(POS))
    return out.filter(~F.col(HALO)).drop(POS, BLOCK, HALO)


def expand_copies(df: DataFrame, copies: str, chunk_rows: int = 10_000) -> DataFrame:
    """Emit each row ``copies`` times without one task generating a huge
    group: a row is first cut into chunks of at most ``chunk_rows`` copies,
    the chunks are spread over tasks by hash, and each chunk explodes."""
    n = F.col(copies)
    chunks = df.withColumn("_chunk", F.explode(F.sequence(F.lit(0), F.ceil(n / chunk_rows).cast("int") - 1)))
    sized = chunks.withColumn("_k", F.least(F.lit(chunk_rows), n - F.col("_chunk") * chunk_rows).cast("int"))
    spread = sized.repartition(*[c for c in df.columns if c != copies], "_chunk")
    return spread.withColumn("_one", F.explode(F.array_repeat(F.lit(1), F.col("_k")))).drop(
        "_chunk", "_k", "_one", copies
    )
