"""Tables whose every change is all or nothing.

Plain Parquet has no transactions: an overwrite in place first deletes the old
files, so a job that fails in its last stage leaves an empty table, and one that
replaces several day folders can stop between two of them. Here a write only adds
files, in a folder of its own; what the table holds is said by numbered commit
files, written last and in one step::

    <table>/data/commit=<number>-<id>/[<partition>=<value>/]part-...parquet
    <table>/commits/<number>.json

The newest commit names, for each partition, the folder that holds it. A write that
fails anywhere before its commit file leaves the table as it was; a replaced set of
days appears at once. Readers resolve the newest commit and read just those
folders, so partition predicates still prune. Folders that no kept commit names
are removed by a later commit; a reader keeps its files until ``keep`` more
commits were made. Two writers that start from one version can't both commit.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Collection
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.session import create_file, delete_path, ensure_session_conf, list_names, read_file


class ConcurrentWrite(RuntimeError):
    """Another writer committed the version that this one was about to."""


@dataclass(frozen=True)
class Commit:
    """``parts``: partition folder ('' for an unpartitioned table) -> its entry, with
    the name of the ``commit`` that wrote it and, if asked for, ``rows`` and
    ``digest`` of its content. ``notes`` belong to the table as a whole."""

    version: int
    schema: str
    parts: dict[str, dict]
    notes: dict = field(default_factory=dict)

    def to_json(self) -> str:
        return json.dumps({"version": self.version, "schema": self.schema, "parts": self.parts, "notes": self.notes})

    @staticmethod
    def from_json(text: str) -> Commit:
        d = json.loads(text)
        return Commit(d["version"], d["schema"], d["parts"], d["notes"])


def content_digests(df: DataFrame, by: str) -> DataFrame:
    """(by, rows, digest): number and order-free sum of the rows' hashes for each
    value of ``by``. One partial aggregate; equal content gives equal digests in
    any order and file layout."""
    h = F.xxhash64(*[F.col(c) for c in sorted(df.columns)]).cast("decimal(38,0)")
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("rows"), F.sum(h).cast("string").alias("digest"))


class VersionedTable:
    """A table at ``path``, partitioned by the column ``partition`` or not at all."""

    def __init__(self, spark: SparkSession, path: str, partition: str | None = None, keep: int = 2):
        ensure_session_conf(spark)
        self.spark, self.path, self.partition, self.keep = spark, path.rstrip("/"), partition, keep

    # --- what is committed --------------------------------------------------------

    def versions(self) -> list[int]:
        names = list_names(self.spark, f"{self.path}/commits")
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and not n.startswith("."))

    def commit(self, version: int | None = None) -> Commit | None:
        """The newest commit (or a kept older one); None if there is no table yet."""
        if version is None:
            known = self.versions()
            if not known:
                return None
            version = known[-1]
        return Commit.from_json(read_file(self.spark, self._commit_file(version)))

    def exists(self) -> bool:
        return bool(self.versions())

    def _commit_file(self, version: int) -> str:
        return f"{self.path}/commits/{version:08d}.json"

    def folder(self, value) -> str:
        """Name of a partition's folder."""
        return f"{self.partition}={value}"

    # --- reading ---------------------------------------------------------------------

    def read(self, version: int | None = None) -> DataFrame:
        """The table as of the newest commit (or a kept older one)."""
        at = self.commit(version)
        if at is None:
            raise FileNotFoundError(f"no committed table at {self.path}")
        return self._read(at, at.parts)

    def _read(self, at: Commit, parts: dict[str, dict]) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(at.schema))
        if not parts:
            return self.spark.createDataFrame([], schema)
        base = f"{self.path}/data"
        paths = [f"{base}/commit={entry['commit']}/{name}".rstrip("/") for name, entry in sorted(parts.items())]
        return self.spark.read.schema(schema).option("basePath", base).parquet(*paths).select(*schema.fieldNames())

    # --- writing ---------------------------------------------------------------------

    def write(
        self,
        df: DataFrame,
        replace: str = "all",
        drop: Collection[str] = (),
        digests: bool = False,
        notes: dict | None = None,
    ) -> Commit:
        """Write ``df`` and commit it. ``replace="all"``: the table holds nothing else
        afterwards. ``replace="touched"``: partitions without rows in ``df`` stay, but
        for the folders named in ``drop``. ``digests`` reads what was written
        once more, for each partition's rows and digest. ``notes`` replaces the
        table's notes (None keeps them). ``df`` may read the table itself."""
        if replace not in ("all", "touched"):
            raise ValueError(f"replace is 'all' or 'touched', not {replace!r}")
        before = self.commit()
        schema = self._schema(df)
        if before is not None and replace == "touched" and before.schema != schema:
            raise ValueError(f"the columns of {self.path} would change: {before.schema} -> {schema}")
        version = before.version + 1 if before else 1
        name = f"{version:08d}-{uuid.uuid4().hex[:12]}"
        target = f"{self.path}/data/commit={name}"
        writer = df.write.mode("errorifexists")
        if self.partition is not None:
            writer = writer.partitionBy(self.partition)
        try:
            writer.parquet(target)
            parts = {p: {"commit": name} for p in self._written(target)}
            if digests and parts:
                self._add_digests(parts, target, schema)
        except BaseException:
            delete_path(self.spark, target)
            raise
        if replace == "touched" and before is not None:
            parts = {p: e for p, e in before.parts.items() if p not in drop} | parts
        done = Commit(version, schema, parts, notes if notes is not None else (before.notes if before else {}))
        if not create_file(self.spark, self._commit_file(version), done.to_json()):
            delete_path(self.spark, target)
            raise ConcurrentWrite(f"version {version} of {self.path} was committed by another writer")
        self._vacuum(version)
        return done

    def _schema(self, df: DataFrame) -> str:
        """Columns in order, all nullable (as Parquet reads them), without metadata;
        a partition column last, as it is not in the files."""
        fields = [f for f in df.schema.fields if f.name != self.partition]
        if self.partition is not None:
            fields.append(df.schema[self.partition])
        plain = T.StructType([T.StructField(f.name, f.dataType, True) for f in fields])
        return json.dumps(json.loads(plain.json()), sort_keys=True)

    def _written(self, target: str) -> list[str]:
        if self.partition is None:
            return [""]
        return [n for n in list_names(self.spark, target) if n.startswith(f"{self.partition}=")]

    def _add_digests(self, parts: dict[str, dict], target: str, schema: str) -> None:
        fresh = self.spark.read.schema(T.StructType.fromJson(json.loads(schema))).parquet(target)
        by = self.partition
        if by is None:
            by, fresh = "__all", fresh.withColumn("__all", F.lit(""))
        # one row for each written partition
        for r in content_digests(fresh, by).collect():
            value = "__HIVE_DEFAULT_PARTITION__" if r[by] is None else r[by]
            parts[self.folder(value) if self.partition else ""] |= {"rows": r["rows"], "digest": r["digest"]}

    def _vacuum(self, version: int) -> None:
        """Remove commits before the last ``keep`` and the folders that none of these
        names. Folders numbered later belong to writers that are still at work."""
        kept = [v for v in self.versions() if version - self.keep < v <= version]
        for v in self.versions():
            if v <= version - self.keep:
                delete_path(self.spark, self._commit_file(v))
        named = {e["commit"] for v in kept for e in self.commit(v).parts.values()}
        for folder in list_names(self.spark, f"{self.path}/data"):
            name = folder.removeprefix("commit=")
            if name not in named and int(name.split("-")[0]) <= version - self.keep:
                delete_path(self.spark, f"{self.path}/data/{folder}")
