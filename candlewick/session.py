"""Session settings the library relies on, and the shared scratch location.

All bar semantics are UTC (dates of bars, day partitions, hour differences), so
the session time zone is pinned to UTC. Work that must survive executor loss
is cut at a table written under ``spark.checkpoint.dir`` (a shared folder on a
cluster); a private temporary folder is only chosen when that setting is unset,
which is the case in local tests.
"""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every session needs for correct results.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # Dynamic overwrite replaces only the partitions present in the written
    # data, which is what the idempotent raw writes and the merge rely on.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}

# Settings for scale; safe to keep on small data.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # No table is broadcast by hand: Spark does so below its own threshold,
    # from sizes that it has measured.
}


# Recommended for a large cluster (~100 TB of bars): let AQE size shuffles
# from a generous start, split skewed join partitions, read big splits, and
# keep broadcasts to what the planner has measured. Applied by the cluster's
# job config, not by the library.
CLUSTER_CONF = {
    **REQUIRED_CONF,
    **SCALE_CONF,
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
}


def ensure_session_conf(spark: SparkSession) -> SparkSession:
    """Pin the runtime settings results depend on (idempotent)."""
    for key, value in REQUIRED_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(
    master: str | None = None, shuffle_partitions: int | None = None, app: str = "candlewick", **conf: str
) -> SparkSession:
    """A session with the library's settings. On a cluster leave ``master`` and
    ``shuffle_partitions`` out: the job's own configuration decides. ``conf``
    adds settings, dots written as double underscores."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    if master is not None:
        builder = builder.master(master)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    for key, value in {**REQUIRED_CONF, **SCALE_CONF}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return ensure_session_conf(spark)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named in ``spark.checkpoint.dir``. Only a local master
    may go without: a private temporary folder serves it (tests). On a cluster
    that would be another folder on each machine, so it is an error there."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not configured:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="candlewick-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    spark.sparkContext.setCheckpointDir(configured)
    return configured


# Staged folders of the runs that are open, innermost last, and those that outlive
# their run because a result still reads them.
_RUNS: list[list[str]] = []
_LASTING: dict[str, SparkSession] = {}
# Those staged outside any run, which stay until the program ends.
_OWN: dict[str, SparkSession] = {}


def scratch_path(spark: SparkSession, name: str, lasting: bool = False) -> str:
    """A fresh folder under the shared checkpoint location for a staged table. It is
    dropped when the innermost ``staged_run`` ends; a ``lasting`` one belongs to the
    run around that (and, like all without a run, is dropped when the program ends)."""
    root = ensure_checkpoint_dir(spark)
    path = f"{root.rstrip('/')}/staged/{name}-{uuid.uuid4().hex}"
    runs = _RUNS[:-1] if lasting else _RUNS
    if runs:
        runs[-1].append(path)
    else:
        (_LASTING if lasting else _OWN)[path] = spark
    return path


@contextmanager
def staged_run(spark: SparkSession) -> Iterator[None]:
    """Drops every folder staged inside at its end, after a failure as well. What is
    returned from it may only read ``lasting`` ones."""
    mine: list[str] = []
    _RUNS.append(mine)
    try:
        yield
    finally:
        _RUNS.pop()
        for path in mine:
            drop_staged(spark, path)


def drop_lasting(spark: SparkSession) -> int:
    """Drop the staged folders that results of this session's runs still read; their
    number. What was staged outside any run, such as the raw table of a model graph, stays."""
    return _drop(spark, _LASTING)


def _drop(spark: SparkSession, staged: dict[str, SparkSession]) -> int:
    mine = [p for p, of in staged.items() if of is spark]
    for path in mine:
        drop_staged(spark, path)
        del staged[path]
    return len(mine)


@atexit.register
def _drop_at_exit() -> None:
    """Only while the session still runs: a stopped one has no file system to ask."""
    for staged in (_LASTING, _OWN):
        for spark in {id(s): s for s in staged.values()}.values():
            if spark.sparkContext._jsc is not None:
                _drop(spark, staged)


def _file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a table was ever committed at ``path``, on any file system that
    Spark reads: the folder holds something besides hidden files (a write that
    was cut off leaves only those)."""
    return any(not name.startswith(("_", ".")) for name in list_names(spark, path))


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none if there is no such folder."""
    fs, at = _file_system(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(at)) if fs.exists(at) else []


def read_file(spark: SparkSession, path: str) -> str:
    """A small control file as text."""
    fs, at = _file_system(spark, path)
    stream = fs.open(at)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_file(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small control file with its whole content in one step (written
    beside it, then renamed); False if there is one already."""
    fs, at = _file_system(spark, path)
    folder, name = path.rsplit("/", 1)
    beside = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/.{name}.{uuid.uuid4().hex}")
    stream = fs.create(beside, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    done = not fs.exists(at) and fs.rename(beside, at)
    if not done:
        fs.delete(beside, False)
    return done


def delete_path(spark: SparkSession, path: str) -> None:
    fs, at = _file_system(spark, path)
    fs.delete(at, True)


def drop_staged(spark: SparkSession, path: str) -> None:
    """Remove a staged table once nothing reads it any more."""
    if "/staged/" not in path:
        raise ValueError(f"{path} is not a staged table")
    delete_path(spark, path)
