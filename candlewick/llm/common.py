"""Helpers shared by the training-data operators: reading tables, staging
intermediate tables in the shared folder, numbering rows without one big
window, connected components."""

from __future__ import annotations

import contextlib
import ctypes
import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(spark: SparkSession, df: DataFrame, name: str, lasting: bool = False) -> DataFrame:
    """Write ``df`` as Parquet under ``spark.checkpoint.dir`` and read it back:
    lineage ends there, and every executor can read the files. The innermost
    ``staged_run`` drops it at its end, a ``lasting`` one the run around that."""
    path = scratch_path(spark, name, lasting)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or with underscores added until ``df`` has no such column."""
    while name in df.columns:
        name += "_"
    return name


def partitions(spark: SparkSession) -> int:
    """The session's shuffle width (sized for the data by the job's config)."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def crc_mod(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo; a null id counts as ''."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def thinned(df: DataFrame, group: str, key: str, sizes: dict, wanted: dict) -> DataFrame:
    """Rows whose key's hash is low enough that about four times ``wanted`` rows
    of each group stay, all if it has fewer; adds ``__share``, the hash as 0 to 1.
    ``sizes`` holds the groups' row counts. So what a later ordered limit works
    on doesn't grow with the data. Rows without a key or group go."""
    share = F.xxhash64(key).bitwiseAND(F.lit((1 << 40) - 1)) / F.lit(float(1 << 40))
    rate = F.create_map(*[F.lit(x) for g, n in sizes.items() for x in (g, min(1.0, 4.0 * wanted[g] / max(n, 1)))])
    return df.filter(F.col(key).isNotNull() & F.col(group).isNotNull()).withColumn("__share", share).filter(
        F.col("__share") < rate[F.col(group)]
    )


def number_rows(df: DataFrame, group: list[str], out: str, order: list[str], buckets: int) -> DataFrame:
    """Add ``out``: a gapless number from 0 within each group.

    A group of any size is spread over ``buckets`` buckets by the hash of its
    order columns; rows are numbered inside a bucket and shifted by the sizes
    of the buckets before it, so no task holds a whole group. Nulls in
    ``group`` form a group of their own. ``order`` decides the bucket as well:
    rows equal in all of it share a bucket (number in any order).
    """
    k, rn, base = (free_name(df, name) for name in ("__k", "__rn", "__base"))
    key = F.struct(
        F.struct(*[F.col(g) for g in group]).alias("group"), F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int").alias("salt")
    )
    salted = df.withColumn(k, key)
    sizes = salted.groupBy(k).agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy(f"{k}.group").orderBy(f"{k}.salt").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select(k, F.coalesce(F.sum("n").over(before), F.lit(0)).alias(base))
    within = Window.partitionBy(k).orderBy(*order)
    return (
        salted.withColumn(rn, F.row_number().over(within) - 1)
        .join(bases, k, "left")
        .withColumn(out, (F.col(base) + F.col(rn)).cast("long"))
        .drop(k, base, rn)
    )


def place_runs(df: DataFrame, keys: np.ndarray, place, schema: str, columns: tuple[str, str]) -> DataFrame:
    """Add columns looked up in a sorted table of runs.

    ``keys`` holds ``class << 40 | first rank`` of each run, ascending;
    ``place(run, rank_in_run)`` gives a dict of Arrow-ready columns. The table
    is bounded by the number of classes, so it travels with the task.
    """
    cls, rank = columns
    first = keys & ((1 << 40) - 1)

    def look_up(batches):
        for batch in batches:
            c = batch.column(cls).to_numpy(zero_copy_only=False).astype(np.int64)
            r = batch.column(rank).to_numpy(zero_copy_only=False).astype(np.int64)
            run = np.searchsorted(keys, (c << 40) | r, side="right") - 1
            new = place(run, r - first[run])
            arrays = list(batch.columns) + [pa.array(v) for v in new.values()]
            yield pa.RecordBatch.from_arrays(arrays, names=batch.schema.names + list(new))

    out = T.StructType(df.schema.fields + T._parse_datatype_string(schema).fields)
    return df.mapInArrow(look_up, out)


def connected_components(
    spark: SparkSession, links: DataFrame, name: str = "components", rounds: int | None = None
) -> DataFrame:
    """``links(a long, b long)`` -> ``(id, component)``, component the smallest
    id reachable; only ids that occur in a link are returned.

    Labels start at the smaller end of each link. A round takes the smallest
    label among a node and its neighbours, then follows that label once more
    (pointer jumping), until nothing changes. Each round is a staged table. With
    ``rounds``, it stops after so many: then equal components are connected, but
    a component may still have several names.
    """
    both = stage(
        spark,
        links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        .filter("a <> b").distinct(),
        f"{name}-links",
    )
    labels = stage(
        spark,
        both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m")).select("id", F.least("id", "m").alias("label")),
        f"{name}-labels",
    )
    done = 0
    while True:
        near = (
            both.join(labels.withColumnRenamed("id", "b"), "b")
            .groupBy(F.col("a").alias("id")).agg(F.min("label").alias("m"))
        )
        step = labels.join(near, "id").select("id", F.col("label").alias("old"), F.least("label", "m").alias("mid"))
        jump = labels.select(F.col("id").alias("mid"), F.col("label").alias("jumped"))
        new = stage(
            spark,
            step.join(jump, "mid").select("id", "old", F.least("mid", "jumped").alias("label")),
            f"{name}-labels",
        )
        labels = new.select("id", "label")
        done += 1
        if done == rounds or new.filter("old <> label").isEmpty():
            return labels.withColumnRenamed("label", "component")


#: What empties the tables that an operator keeps in a worker from task to task.
KEPT_TABLES: list = []


def release(keep=None) -> None:
    """Drop tables that other operators left in this worker (``keep``: the entry of
    KEPT_TABLES that stays), and give what its earlier tasks freed back to the system:
    a worker lives through many stages, and its peaks would add up with those of the JVM."""
    for clear in KEPT_TABLES:
        if clear != keep:
            clear()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not with every C library
        ctypes.CDLL(None).malloc_trim(0)


def slices(batches, rows: int = 256):
    """Arrow batches in pieces of at most ``rows`` rows, so that a task holds
    few texts as Python objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def segments(lengths: np.ndarray) -> np.ndarray:
    """Start of each run when runs of these lengths are laid end to end."""
    out = np.zeros(len(lengths), np.int64)
    np.cumsum(lengths[:-1], out=out[1:])
    return out


@functools.cache
def ascii_lower() -> dict[int, int]:
    return {c: c + 32 for c in range(65, 91)}
