"""Reversible line dedup: sharded cuckoo filters backed by exact reference counts.

A line's key is the md5 of the line, white space stripped at both ends and A-Z
lower-cased; short lines have none. The index holds

* ``refs``, the exact table: how many lines of a document have a key. An insert or a
  delete appends its (signed) rows as one more batch; nothing is rewritten.
* ``filters``, one cuckoo filter a shard of keys: a key is in it once for each
  document that holds it, up to ``least`` times. Copies are inserted and deleted as
  the exact count passes, so a filter never undercounts a key.

A new batch asks the filters first: a key that no filter knows is new, and only the
others are looked up in the exact table. So do verdicts: only keys that the filters hold
``least`` times are counted exactly. As every change is a signed row, deleting a document
brings back the lines that others lost to it.

A filter that fills up gets a further segment of twice the size; ``compact`` adds up the
batches and deals the keys anew. Both tables are committed as a whole
(``VersionedTable``); filters that an interrupted run left behind the exact table are
rebuilt from it.

Keys are aggregated before every shuffle, so a line that stands in a third of all documents
is one key to the filters; where its documents are told apart, rows are salted.

Documents are told apart by id: rows with one id (null is an id, the least one) are one
document. A null or empty text is one empty line, which has no key. Inserting an id
again replaces its lines; deleting an unknown id does nothing.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.llm.common import slices, stage
from candlewick.session import staged_run
from candlewick.sources.versioned import VersionedTable

SPACE = b" \t\n\x0b\x0c\r"
#: Slots of a bucket, the load at which a new filter is sized, kicks before it counts
#: as full.
SLOTS, LOAD, KICKS = 4, 0.8, 200
#: Keys that a shard is planned for.
SHARD_KEYS = 1 << 18
#: A key's documents are joined in this many parts.
SALTS = 16


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """The key of a line (UTF-8), None if it is too short."""
    bare = line.strip(SPACE).lower()  # bytes: A-Z only
    if len(bare) < min_chars or len(bare.decode("utf-8", "replace")) < min_chars:
        return None
    return hashlib.md5(bare).digest()


# --- cuckoo filters ---------------------------------------------------------------

def _mix(x: np.ndarray) -> np.ndarray:
    x = (x.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(31))


class CuckooFilter:
    """A multiset of 64-bit hashes as 16-bit fingerprints, in segments of buckets."""

    def __init__(self, segments: list[np.ndarray] | None = None):
        self.segments = segments or []

    @staticmethod
    def sized(items: int) -> CuckooFilter:
        """Empty, for this many copies."""
        out = CuckooFilter()
        out._grow(items)
        return out

    def _grow(self, items: int) -> None:
        last = self.segments[-1].shape[0] if self.segments else 0
        buckets = max(2 * last, 1 << max(3, int(np.ceil(np.log2(max(1, items) / (SLOTS * LOAD))))))
        self.segments.append(np.zeros((buckets, SLOTS), np.uint16))

    @staticmethod
    def _places(hashes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Fingerprint (never 0) and the two buckets of each hash."""
        mark = (hashes % np.uint64(65535)).astype(np.uint16) + np.uint16(1)
        one = (_mix(hashes) & np.uint64(buckets - 1)).astype(np.int64)
        return mark, one, CuckooFilter._other(mark, one, buckets)

    @staticmethod
    def _other(mark: np.ndarray, bucket: np.ndarray, buckets: int) -> np.ndarray:
        return bucket ^ (_mix(mark) & np.uint64(buckets - 1)).astype(np.int64)

    def count(self, hashes: np.ndarray) -> np.ndarray:
        """How often each hash is held: never less than it was inserted."""
        out = np.zeros(len(hashes), np.int64)
        for table in self.segments:
            mark, one, two = self._places(hashes, len(table))
            out += (table[one] == mark[:, None]).sum(1)
            out += np.where(one != two, (table[two] == mark[:, None]).sum(1), 0)
        return out

    def insert(self, hashes: np.ndarray) -> None:
        """One copy of each hash (repeat a hash for more). A part that doesn't fit into
        the last segment goes to a new one as a whole."""
        while len(hashes):
            if not self.segments:
                self._grow(len(hashes))
            table = self.segments[-1]
            room = int(0.9 * table.size) - int(np.count_nonzero(table))
            if room > 0:
                before = table.copy()
                if self._place(table, hashes[:room]):
                    hashes = hashes[room:]
                    continue
                table[:] = before  # marks that were kicked out have lost their hash
            self._grow(len(hashes))

    def _place(self, table: np.ndarray, hashes: np.ndarray) -> bool:
        """Place all or report that some are left over. Round by round: what fits into
        its bucket is placed; of the rest, one mark a bucket takes the place of
        another, which tries its other bucket in the next round."""
        rng = np.random.default_rng(len(hashes))
        mark, one, two = self._places(hashes, len(table))
        left = self._fill(table, mark, one)
        mark, bucket = mark[left], two[left]
        for _ in range(KICKS):
            left = self._fill(table, mark, bucket)
            mark, bucket = mark[left], bucket[left]
            if not len(mark):
                return True
            _, first = np.unique(bucket, return_index=True)
            slot = rng.integers(0, SLOTS, len(first))
            out = table[bucket[first], slot]
            table[bucket[first], slot] = mark[first]
            mark[first] = out
            bucket[first] = self._other(out, bucket[first], len(table))
        return False

    @staticmethod
    def _fill(table: np.ndarray, mark: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        """Put marks into free slots of their buckets; positions of those without one."""
        order = np.argsort(bucket, kind="stable")
        b = bucket[order]
        rank = np.arange(len(b)) - np.searchsorted(b, b)
        free = table[b] == 0
        fits = rank < free.sum(1)
        at = order[fits]
        # the rank-th free slot
        slot = (np.cumsum(free[fits], axis=1) == (rank[fits] + 1)[:, None]).argmax(1)
        table[bucket[at], slot] = mark[at]
        return np.sort(order[~fits])

    def delete(self, hashes: np.ndarray) -> None:
        """One copy of each hash less; all must be held. The largest segment goes first:
        hashes that look alike there look alike in the smaller ones, so whichever of
        their copies goes, both are still found."""
        for table in reversed(self.segments):
            if not len(hashes):
                return
            mark, one, two = self._places(hashes, len(table))
            # equal marks in the same buckets one after another
            pair = np.minimum(one, two) << 16 | mark
            order = np.argsort(pair, kind="stable")
            rank = np.empty(len(pair), np.int64)
            rank[order] = np.arange(len(pair)) - np.searchsorted(pair[order], pair[order])
            found = np.zeros(len(hashes), bool)
            for r in range(int(rank.max()) + 1):
                at = np.flatnonzero(rank == r)
                for bucket in (one, two):
                    rest = at[~found[at]]
                    same = table[bucket[rest]] == mark[rest][:, None]
                    hit = same.any(1)
                    table[bucket[rest[hit]], same[hit].argmax(1)] = 0
                    found[rest[hit]] = True
            hashes = hashes[~found]
        if len(hashes):
            raise ValueError(f"{len(hashes)} keys to delete are not in the filter")


def _hashes(keys: pa.ChunkedArray | pa.Array) -> np.ndarray:
    raw = b"".join(keys.to_pylist())
    return np.frombuffer(raw, "<u8").reshape(-1, 2)[:, 0].copy()


def _load(rows: pa.Table) -> CuckooFilter:
    """The filter of a shard's row (an empty one without a row)."""
    if rows.num_rows == 0:
        return CuckooFilter()
    blobs = rows.column("segments")[0].as_py()
    return CuckooFilter([np.frombuffer(b, "<u2").reshape(-1, SLOTS).copy() for b in blobs])


# --- the index --------------------------------------------------------------------

def same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


class LineIndex:
    """Lines of documents at ``path``. ``least``: in how many documents a line must
    stand to be a repeated one (at most 8, what two buckets hold of one key);
    ``min_chars``: code points of the shortest key; ``shards``: of the filters, by
    default as many as the first insert's keys need."""

    def __init__(self, spark: SparkSession, path: str, least: int = 3, min_chars: int = 20, shards: int | None = None):
        if not 1 <= least <= 2 * SLOTS:
            raise ValueError(f"least must be 1 to {2 * SLOTS}")
        self.spark, self.least, self.min_chars, self.wanted = spark, least, min_chars, shards
        self.refs = VersionedTable(spark, f"{path}/refs", "batch")
        self.filters = VersionedTable(spark, f"{path}/filters")

    # --- contents -----------------------------------------------------------------

    def lines(self, docs: DataFrame, id: str = "doc_id") -> DataFrame:
        """(key, doc, n): how many lines of a document have a key, one row for each."""
        least = self.min_chars

        def look(batches):
            for batch in slices(batches):
                at, keys = [], []
                for i, text in enumerate(batch.column("text").cast(pa.binary()).to_pylist()):
                    for line in (text or b"").split(b"\n"):
                        key = line_key(line, least)
                        if key is not None:
                            at.append(i)
                            keys.append(key)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.binary()), batch.column("doc").take(pa.array(at, pa.int64()))], names=["key", "doc"]
                )

        schema = T.StructType([T.StructField("key", T.BinaryType()), T.StructField("doc", docs.schema[id].dataType)])
        texts = docs.select(F.col(id).alias("doc"), F.col("text").cast("string").alias("text"))
        return texts.mapInArrow(look, schema).groupBy("key", "doc").agg(F.count(F.lit(1)).alias("n"))

    def references(self, version: int | None = None) -> DataFrame:
        """(shard, key, doc, n): the exact table, batches added up."""
        at = self.refs.commit(version)
        rows = self.refs.read(version).drop("batch")
        if len(at.parts) == 1:
            return rows
        return rows.groupBy("shard", "key", "doc").agg(F.sum("n").alias("n")).filter("n > 0")

    # --- changes ------------------------------------------------------------------

    def insert(self, docs: DataFrame, id: str = "doc_id") -> None:
        """Add documents (or replace those with a known id)."""
        with staged_run(self.spark):
            new = stage(self.spark, self.lines(docs, id), "lines-new")
            if not self.refs.exists():
                self._create(new)
                return
            ids = docs.select(F.col(id).alias("id")).distinct()
            self._append(new, ids)

    def delete(self, ids: DataFrame) -> None:
        """Remove the documents whose ids are in the one column of ``ids``."""
        if not self.refs.exists():
            return
        with staged_run(self.spark):
            self._append(None, ids.toDF("id").distinct())

    def _shard(self, shards: int) -> Column:
        return F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int")

    def _create(self, new: DataFrame) -> None:
        shards = self.wanted
        if shards is None:
            keys = new.select("key").distinct().count()
            shards = 1 << max(3, int(np.ceil(np.log2(max(1, keys) / SHARD_KEYS))))
        rows = new.withColumn("shard", self._shard(shards)).select("shard", "key", "doc", "n", F.lit(1).alias("batch"))
        self.refs.write(rows, notes={"shards": shards, "batches": 1})
        self._rebuild()

    def _append(self, new: DataFrame | None, ids: DataFrame) -> None:
        at = self.refs.commit()
        shards, batch = at.notes["shards"], at.notes["batches"] + 1
        had = self.references()
        gone = had.join(ids, same(had["doc"], ids["id"]), "left_semi").select("shard", "key", "doc", (-F.col("n")).alias("n"))
        delta = gone
        if new is not None:
            delta = new.withColumn("shard", self._shard(shards)).select("shard", "key", "doc", "n").unionByName(gone)
        delta = stage(self.spark, delta, "lines-delta")
        known = self._filter_rows()
        self.refs.write(
            delta.withColumn("batch", F.lit(batch)), replace="touched", notes={"shards": shards, "batches": batch}
        )
        # documents more or fewer that hold a key
        changes = (
            delta.groupBy("shard", "key", "doc").agg(F.sum(F.signum("n")).alias("c"))
            .groupBy("shard", "key").agg(F.sum("c").cast("long").alias("change")).filter("change <> 0")
        )
        changes = stage(self.spark, changes, "lines-changes")
        # what no filter knows is new; only the rest is looked up
        looked_up = self._ask(known, changes.select("shard", "key"), 1)
        before = self._documents(looked_up, at.version).select(F.col("key").alias("__key"), "documents")
        was = F.coalesce("documents", F.lit(0))
        capped = lambda n: F.least(n, F.lit(self.least))
        updates = (
            changes.join(before, F.col("key") == F.col("__key"), "left")
            .select("shard", "key", (capped(was + F.col("change")) - capped(was)).cast("long").alias("copies"))
            .filter("copies <> 0")
        )
        self._store(self._updated(known, updates))

    def _documents(self, keys: DataFrame, version: int | None = None) -> DataFrame:
        """Exact count and largest id of the documents that hold each of ``keys``. Counted
        before the join: a key's rows are added up in the map tasks."""
        counts = self.references(version).groupBy("key").agg(
            F.count(F.lit(1)).alias("documents"), F.max("doc").alias("largest")
        )
        return counts.join(keys.select("key"), "key", "left_semi")

    def compact(self, shards: int | None = None) -> None:
        """Add up all batches and deal the keys over ``shards`` (by default what the
        number of keys asks for) anew."""
        with staged_run(self.spark):
            self.wanted = shards
            kept = stage(self.spark, self.references().select("key", "doc", "n"), "lines-compact")
            self._create(kept)

    # --- filters ------------------------------------------------------------------

    _FILTER = "shard int, segments array<binary>"

    def _filter_rows(self) -> DataFrame:
        """Filters that belong to the newest exact table, rebuilt if they don't."""
        at = self.filters.commit()
        if at is None or at.notes["refs"] != self.refs.commit().version:
            self._rebuild()
        return self.filters.read()

    def _rebuild(self) -> None:
        counts = self.references().groupBy("shard", "key").agg(F.least(F.count(F.lit(1)), F.lit(self.least)).alias("copies"))
        none = self.spark.createDataFrame([], self._FILTER)
        self._store(self._updated(none, counts))

    def _store(self, filters: DataFrame) -> None:
        self.filters.write(filters, notes={"refs": self.refs.commit().version})

    def _updated(self, filters: DataFrame, updates: DataFrame) -> DataFrame:
        """Filters after ``updates(shard, key, copies)``, copies more or fewer."""
        def apply(old: pa.Table, new: pa.Table) -> pa.Table:
            held = _load(old)
            hashes, copies = _hashes(new.column("key")), new.column("copies").to_numpy()
            less, more = copies < 0, copies > 0
            if less.any():
                held.delete(np.repeat(hashes[less], -copies[less]))
            added = np.repeat(hashes[more], copies[more])
            if not held.segments:
                held = CuckooFilter.sized(len(added))
            held.insert(added)
            shard = (old if old.num_rows else new).column("shard")[0].as_py()
            return pa.table({
                "shard": pa.array([shard], pa.int32()),
                "segments": pa.array([[t.astype("<u2").tobytes() for t in held.segments]], pa.list_(pa.binary())),
            })

        return filters.groupBy("shard").cogroup(updates.groupBy("shard")).applyInArrow(apply, self._FILTER)

    def _ask(self, filters: DataFrame, keys: DataFrame, least: int) -> DataFrame:
        """Those of ``keys(shard, key)``, each given once, that the filters hold ``least``
        times or more."""
        def ask(old: pa.Table, asked: pa.Table) -> pa.Table:
            hits = _load(old).count(_hashes(asked.column("key"))) >= least
            return asked.select(["shard", "key"]).filter(pa.array(hits))

        return filters.groupBy("shard").cogroup(keys.groupBy("shard")).applyInArrow(ask, "shard int, key binary")

    # --- verdicts -----------------------------------------------------------------

    def repeated(self) -> DataFrame:
        """(key, documents, largest): keys in ``least`` documents or more."""
        keys = self.references().select("shard", "key").distinct()
        return self._documents(self._ask(self._filter_rows(), keys, self.least)).filter(F.col("documents") >= self.least)

    def drops(self) -> DataFrame:
        """(doc, key): lines that go, which is a repeated key's in all of its documents
        but the largest."""
        salt = F.pmod(F.xxhash64("doc"), F.lit(SALTS))
        salts = F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))
        spread = self.repeated().withColumn("salt", F.explode(salts))
        refs = self.references().select("key", "doc").withColumn("salt", salt)
        return refs.join(spread, ["key", "salt"]).filter(~same(F.col("doc"), F.col("largest"))).select("doc", "key")

    def apply(self, docs: DataFrame, id: str = "doc_id") -> DataFrame:
        """All columns of ``docs`` (documents of the index) plus ``n_lines``, ``n_dropped``
        and ``kept``, the text without the lines that go (columns of those names are
        replaced)."""
        names = ["n_lines", "n_dropped", "kept"]
        rest = docs.drop(*[c for c in names if c not in (id, "text")])
        # a document's keys are no more than its lines
        gone = self.drops().groupBy(F.col("doc").alias("__doc")).agg(F.collect_list("key").alias("__gone"))
        joined = rest.join(gone, same(F.col(id), F.col("__doc")), "left").drop("__doc")
        least = self.min_chars
        fields = rest.schema.fields + T._parse_datatype_string("n_lines long, n_dropped long, kept string").fields

        own, every = rest.columns, [f.name for f in fields]

        def look(batches):
            for batch in slices(batches):
                texts, gone = batch.column("text").cast(pa.binary()).to_pylist(), batch.column("__gone").to_pylist()
                out: list[tuple[int, int, bytes]] = []
                for text, keys in zip(texts, gone):
                    lines = (text or b"").split(b"\n")
                    kept = lines
                    if keys:
                        drop = set(keys)
                        kept = [line for line in lines if line_key(line, least) not in drop]
                    out.append((len(lines), len(lines) - len(kept), b"\n".join(kept)))
                n, dropped, kept = zip(*out) if out else ((), (), ())
                columns = [batch.column(c) for c in own]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(n, pa.int64()), pa.array(dropped, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                    names=every,
                )

        return joined.mapInArrow(look, T.StructType(fields))
