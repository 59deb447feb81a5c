"""MinHash near-duplicates with odd sketches and exact confirmation.

Documents with equal shingle sets form a class; one row of each class goes on.
Its MinHash values are banded into buckets and folded into an odd sketch: a
bitmap in which each sampled value flips one bit, so that the population count
of two bitmaps' XOR estimates the similarity, precisely where it is high.
Pairs that share a bucket are screened by their sketches and confirmed on full
sets.

Buckets of any size are worked off without listing their pairs: in a few
rounds each member is compared with one hub of its bucket (the most alike over
its buckets), and members that are already connected need no further
comparison. What is left, members of one bucket in different components, is
compared in blocks of bounded size, by sketches and then by full sets inside
the task, so that only nodes and links leave a block.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from candlewick.llm.common import connected_components, free_name, number_rows, partitions, release, segments, slices, stage
from candlewick.session import staged_run

#: MinHash samples of a set; the first BANDS * ROWS of them are banded, all are
#: folded into the sketch. A pair at 0.75 shares no band about once in 10^7.
SAMPLES, BANDS, ROWS = 512, 40, 4
#: Bits of the odd sketch.
BITS = 2048
#: Pairs whose estimate is below this are not confirmed: a pair at 0.75 falls so
#: low about once in 10^8 (six standard deviations).
SCREEN = 0.6

_RNG = np.random.default_rng(20240607)
_FLIP = _RNG.integers(0, 1 << 32, SAMPLES, dtype=np.uint32)
_TURN = _RNG.integers(0, 1 << 31, SAMPLES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, n: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of runs of ``n`` words (A-Z lowered, white
    space is ASCII's); with fewer words, of the whole sequence; none without words."""
    ws = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not ws:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, ws), np.uint64, len(ws))
    k = min(n, len(ws))
    out = np.full(len(ws) - k + 1, k, np.uint64)
    for i in range(k):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[i : len(h) - k + 1 + i]
    return np.unique(_mix(out))


def minhashes(sets: list[np.ndarray], piece: int = 1 << 16) -> np.ndarray:
    """(sets, SAMPLES) smallest upper hash half of each set under each
    permutation; sets must not be empty. They are taken in pieces that fit in
    cache."""
    out = np.empty((len(sets), SAMPLES), np.uint32)
    at = 0
    while at < len(sets):
        end, size = at, 0
        while end < len(sets) and (end == at or size + len(sets[end]) <= piece):
            size += len(sets[end])
            end += 1
        flat = (np.concatenate(sets[at:end]) >> np.uint64(32)).astype(np.uint32)
        starts = segments(np.fromiter(map(len, sets[at:end]), np.int64))
        work = np.empty_like(flat)
        for k in range(SAMPLES):
            np.bitwise_xor(flat, _FLIP[k], out=work)
            np.multiply(work, _TURN[k], out=work)
            out[at:end, k] = np.minimum.reduceat(work, starts)
        at = end
    return out


def band_keys(low: np.ndarray) -> np.ndarray:
    by = low[:, : BANDS * ROWS].reshape(len(low), BANDS, ROWS).astype(np.uint64)
    key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), by.shape[:2]).copy()
    for r in range(ROWS):
        key = _mix(key * np.uint64(0x9E3779B97F4A7C15) + by[:, :, r])
    return key.view(np.int64)


def odd_sketches(low: np.ndarray) -> np.ndarray:
    """(sets, BITS / 64) words; bit = parity of the samples that hash to it."""
    n, k = low.shape
    bit = (_mix(low.astype(np.uint64) + np.arange(k, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)) % np.uint64(BITS)).astype(np.int64)
    parity = np.bincount((bit + np.arange(n)[:, None] * BITS).ravel(), minlength=n * BITS) & 1
    return np.packbits(parity.astype(np.uint8).reshape(n, BITS), axis=1).view(np.uint64)


#: Estimated Jaccard similarity for each XOR population count: differing bits
#: give the size of the samples' symmetric difference, two for each mismatch.
_ESTIMATE = np.array(
    [1 + BITS / 2 * np.log(max(1 - 2 * z / BITS, 1e-9)) / (2 * SAMPLES) for z in range(BITS + 1)]
)


def estimates(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return _ESTIMATE[np.bitwise_count(a ^ b).sum(-1, dtype=np.int64)]


def describe(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Stored ``(doc_id, text_hash, n, key, bands, sketch, row)`` of every row; ``key`` is
    the digest of its shingle set and ``row`` a number of its own."""

    def look(batches):
        release()
        for batch in slices(batches):
            ids, texts, hashes = batch.column(0), batch.column(1).to_pylist(), batch.column(2)
            for at in range(0, len(texts), 512):
                sets = [shingles(t) for t in texts[at : at + 512]]
                full = [i for i, s in enumerate(sets) if len(s)]
                bands: list = [None] * len(sets)
                sketch: list = [None] * len(sets)
                if full:
                    low = minhashes([sets[i] for i in full])
                    for i, b, s in zip(full, band_keys(low), odd_sketches(low)):
                        bands[i], sketch[i] = b, s.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [ids[at : at + 512], hashes[at : at + 512], pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([_digest(s) for s in sets], pa.binary()),
                     pa.array(bands, pa.list_(pa.int64())), pa.array(sketch, pa.binary())],
                    names=["doc_id", "text_hash", "n", "key", "bands", "sketch"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text", F.xxhash64("text")).mapInArrow(
        look, f"doc_id {kind}, text_hash long, n long, key binary, bands array<long>, sketch binary"
    )
    return stage(spark, rows.withColumn("row", F.monotonically_increasing_id()), "shingled")


def _digest(s: np.ndarray) -> bytes | None:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None


def _screen(pairs: DataFrame, info: DataFrame) -> DataFrame:
    """``pairs(a, b, ...)`` with the sketches' estimate ``est``, at least SCREEN,
    and sizes that allow the threshold."""

    def look(batches):
        for batch in batches:
            a, b = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint64).reshape(-1, BITS // 64)
                for c in ("sketch_a", "sketch_b")
            )
            kept = [c for c in batch.schema.names if c not in ("sketch_a", "sketch_b")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(estimates(a, b) if len(a) else [], pa.float64())],
                names=[*kept, "est"],
            )

    of = lambda s: info.select(F.col("node").alias(s), F.col("n").alias(f"n_{s}"), F.col("sketch").alias(f"sketch_{s}"))
    rows = pairs.join(of("a"), "a").join(of("b"), "b").filter(
        (F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * 75)
    ).drop("n_a", "n_b")
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name not in ("sketch_a", "sketch_b"))
    return rows.mapInArrow(look, f"{kept}, est double").filter(F.col("est") >= SCREEN)


def _full_sets(spark: SparkSession, docs: DataFrame, nodes: DataFrame, max_broadcast: int = 1 << 20) -> DataFrame:
    """``(node, shingles)`` for ``nodes(node, doc_id, key)``: their documents are
    read again. The ids are broadcast only if they are at most
    ``max_broadcast``; beyond that the join shuffles."""
    nodes = stage(spark, nodes, "nodes")
    ids = nodes.select(F.struct("doc_id").alias("k")).distinct()
    if nodes.count() <= max_broadcast:
        ids = F.broadcast(ids)
    rows = docs.select("doc_id", "text").withColumn("k", F.struct("doc_id")).join(ids, "k", "left_semi").select("text")

    def look(batches):
        for batch in slices(batches):
            sets = [shingles(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([_digest(s) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())],
                names=["key", "shingles"],
            )

    found = rows.mapInArrow(look, "key binary, shingles binary").join(nodes.select("key", "node"), "key")
    return stage(spark, found.dropDuplicates(["node"]).select("node", "shingles"), "full-sets")


def _confirm(spark: SparkSession, docs: DataFrame, pairs: DataFrame, info: DataFrame) -> DataFrame:
    """The pairs ``(a, b)`` whose full sets are linked: 100 |both| >= 75 |either|."""
    ends = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    held = _full_sets(spark, docs, info.join(ends, "node", "left_semi").select("node", "doc_id", "key"))

    def look(batches):
        for batch in batches:
            ok = []
            for x, y in zip(batch.column("sa").to_pylist(), batch.column("sb").to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * both >= 75 * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    rows = (
        pairs.select("a", "b")
        .join(held.select(F.col("node").alias("b"), F.col("shingles").alias("sb")), "b")
        .join(held.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), "a")
        .select("a", "b", "sa", "sb")
    )
    return rows.mapInArrow(look, "a long, b long")


def _in_blocks(spark: SparkSession, left: DataFrame, columns: list[str], work, schema: str, block: int) -> DataFrame:
    """Compare the rows of ``left`` that share a band. A band's members are
    numbered and cut into blocks; each task holds two blocks of one band at a
    time and calls ``work(members, one, two)``: the columns by name, and the
    rows of either block."""
    numbered = stage(spark, number_rows(left, ["band"], "at", ["node"], partitions(spark)), "members")
    last = numbered.groupBy("band").agg((F.floor(F.max("at") / block)).cast("int").alias("last"))
    spread = numbered.withColumn("mine", F.floor(F.col("at") / block).cast("int")).join(last, "band").withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("last")))
    )
    spread = spread.select("band", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine", *columns)

    def pairs(held):
        members = dict(zip(["mine", *columns], held))
        side = np.array(members["mine"])
        members["sketch"] = np.frombuffer(b"".join(members["sketch"]), np.uint64).reshape(-1, BITS // 64)
        for name in ("node", "label", "n", "bands"):
            members[name] = np.array(members[name], np.int64)
        # where this band stands among a set's bands
        members["place"] = int(np.flatnonzero(members["bands"][0] == members["here"][0])[0])
        return work(members, np.flatnonzero(side == side.min()), np.flatnonzero(side == side.max()))

    def look(batches):
        release()
        held, key = None, None
        for batch in slices(batches):
            for band, i, j, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if (band, i, j) != key:
                    if held and (got := pairs(held)):
                        yield got
                    key, held = (band, i, j), [[] for _ in row]
                for column, v in zip(held, row):
                    column.append(v)
        if held and (got := pairs(held)):
            yield got

    return (
        spread.repartition(partitions(spark), "band", "i", "j").sortWithinPartitions("band", "i", "j")
        .mapInArrow(look, schema)
    )


def _partners(members: dict, i: int, two: np.ndarray) -> np.ndarray:
    """Rows of ``two`` that may be linked with row ``i`` and aren't connected yet.
    A pair counts in the first band that it shares only."""
    label, n, bands = members["label"], members["n"], members["bands"]
    ok = two[label[two] != label[i]]
    ok = ok[np.minimum(n[ok], n[i]) * 100 >= np.maximum(n[ok], n[i]) * 75]
    if len(ok):
        ok = ok[estimates(members["sketch"][ok], members["sketch"][i]) >= SCREEN]
    place = members["place"]
    return ok[~(bands[ok, :place] == bands[i, :place]).any(1)] if len(ok) and place else ok


def _involved(members: dict, one: np.ndarray, two: np.ndarray) -> pa.RecordBatch | None:
    """The rows that have a possible partner here."""
    found = np.zeros(len(members["node"]), bool)
    for i in one:
        partners = _partners(members, i, two)
        found[partners] = True
        found[i] |= len(partners) > 0
    if found.any():
        return pa.RecordBatch.from_arrays(
            [pa.array(np.array(members["here"])[found], pa.int64()), pa.array(members["node"][found])], names=["band", "node"]
        )


def _links(members: dict, one: np.ndarray, two: np.ndarray) -> pa.RecordBatch | None:
    """Linked pairs by full sets, without those already connected by others."""
    sets = [np.frombuffer(x, np.uint64) for x in members["shingles"]]
    label, up = members["label"], {}

    def top(x):
        while up.get(x, x) != x:
            x = up[x]
        return x

    a, b = [], []
    for i in one:
        for j in _partners(members, i, two):
            x, y = top(label[i]), top(label[j])
            if x == y:
                continue
            both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                up[x] = y
                a.append(members["node"][i])
                b.append(members["node"][j])
    if a:
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _remaining_links(spark: SparkSession, docs: DataFrame, left: DataFrame, info: DataFrame, block: int = 512) -> DataFrame:
    """Links between rows of ``left(band, node, label)`` that share a band and
    differ in label. First the sketches tell which rows may have any; only those
    are compared again, with their full sets, so nothing leaves a task but row
    names and links."""
    left = left.withColumn("here", F.col("band"))
    columns = ["node", "label", "n", "sketch", "bands", "here"]
    sketched = left.join(info.select("node", "n", "sketch", "bands"), "node")
    found = _in_blocks(spark, sketched, columns, _involved, "band long, node long", block)
    involved = stage(spark, found.distinct(), "involved")
    nodes = involved.select("node").distinct()
    held = _full_sets(spark, docs, info.join(nodes, "node", "left_semi").select("node", "doc_id", "key"))
    rows = sketched.join(involved, ["band", "node"], "left_semi").join(held, "node")
    return _in_blocks(spark, rows, [*columns, "shingles"], _links, "a long, b long", block)


def keep_one(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``docs`` without all but one row of each group of near copies, the one
    with the smallest doc_id (of repeated rows, any one). Rows without words are
    in no group and stay. Rows are told apart by id and text."""
    key = F.struct("doc_id", F.xxhash64("text").alias("text_hash"))
    worded = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    firsts = components(spark, docs).filter("first AND n_shingles > 0")
    same, rank = free_name(docs, "__key"), free_name(docs, "__rank")
    firsts = stage(spark, firsts.select(F.struct("doc_id", "text_hash").alias(same)).distinct(), "kept", lasting=True)
    order = F.row_number().over(Window.partitionBy(same).orderBy("doc_id"))
    rows = docs.filter(worded).withColumn(same, key).join(firsts, same).withColumn(rank, order)
    return rows.filter(F.col(rank) == 1).select(docs.columns).union(docs.filter(~worded).select(docs.columns))


def components(spark: SparkSession, docs: DataFrame, rounds: int = 2) -> DataFrame:
    """``docs(doc_id, text)`` -> ``(doc_id, text_hash, n_shingles,
    component_id, kept, first)``.

    ``component_id`` is the smallest doc_id reachable over links (null ids only
    count if there is no other); ``kept`` is ``doc_id = component_id`` (both
    null counts), ``first`` marks exactly one row of each component. Null, empty
    and blank texts are linked with nothing. Repeated rows are copies of each
    other. Other columns of ``docs`` are left out. What is staged on the way is dropped
    at the end; the result reads a table of its own.
    """
    with staged_run(spark):
        return stage(spark, _components(spark, docs, rounds), "near-copies", lasting=True)


def _components(spark: SparkSession, docs: DataFrame, rounds: int) -> DataFrame:
    rows = describe(spark, docs)
    full = rows.filter("n > 0")
    smallest = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row"))
    classes = stage(spark, full.groupBy("key").agg(F.min("row").alias("node"), smallest.alias("low")), "classes")
    reps = full.join(classes.select(F.col("node").alias("row")), "row", "left_semi").withColumnRenamed("row", "node")
    buckets = reps.select("node", F.explode("bands").alias("band"))
    shared = buckets.groupBy("band").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    live = stage(spark, buckets.join(shared, "band"), "buckets")
    # the node that shares buckets with most others is the likely original of copies
    degree = live.groupBy("node").agg(F.sum("c").alias("degree"))
    info = stage(spark, reps.select("node", "doc_id", "key", "n", "sketch", "bands").join(degree, "node"), "sketches")
    live = stage(spark, live.select("node", "band").join(info.select("node", "degree"), "node"), "buckets")
    links, labels = None, None

    def labelled() -> DataFrame:
        if labels is None:
            return live.withColumn("label", F.col("node"))
        return live.join(labels.select(F.col("id").alias("node"), "component"), "node", "left").select(
            "node", "band", "degree", F.coalesce("component", "node").alias("label")
        )

    def join_up(pairs: DataFrame):
        new = _confirm(spark, docs, pairs, info)
        every = stage(spark, new if links is None else links.union(new), "links")
        # which members need no comparison; whole components come at the end
        return every, connected_components(spark, every, rounds=3)

    apart = F.min("label") != F.max("label")
    for k in range(rounds):
        now = stage(spark, labelled(), "labelled")
        rank = F.col("degree") if k == 0 else F.xxhash64("node", F.lit(k))
        hubs = now.groupBy("band").agg(
            F.max_by(F.struct("node", "label"), F.struct(rank, "node")).alias("hub"), apart.alias("apart")
        ).filter("apart").select("band", "hub")
        pairs = now.join(hubs, "band").filter("label <> hub.label").select(
            F.col("node").alias("member"), F.least("node", "hub.node").alias("a"), F.greatest("node", "hub.node").alias("b")
        ).distinct()
        best = _screen(pairs, info).groupBy("member").agg(F.max_by(F.struct("a", "b"), F.col("est")).alias("p"))
        pairs = stage(spark, best.select("p.a", "p.b").distinct(), "pairs")
        if pairs.isEmpty():
            break
        links, labels = join_up(pairs)
    now = stage(spark, labelled(), "labelled")
    open_bands = now.groupBy("band").agg(apart.alias("apart")).filter("apart").select("band")
    left = stage(spark, now.join(open_bands, "band").select("band", "node", "label"), "open")
    if not left.isEmpty():
        new = _remaining_links(spark, docs, left, info)
        links = new if links is None else links.union(new)
    if links is not None:
        labels = connected_components(spark, links)
    else:
        labels = classes.select(F.col("node").alias("id"), F.col("node").alias("component")).limit(0)
    member = classes.join(labels.withColumnRenamed("id", "node"), "node", "left").select(
        "key", "low", F.coalesce("component", "node").alias("component")
    )
    lows = member.groupBy("component").agg(F.min("low").alias("low"))
    lows = member.select("key", "component").join(lows, "component").select("key", "low")
    in_class = full.select("doc_id", "text_hash", "n", "key", "row").join(lows, "key").select(
        "doc_id", "text_hash", F.col("n").alias("n_shingles"), F.col("low.doc_id").alias("component_id"),
        F.col("doc_id").eqNullSafe(F.col("low.doc_id")).alias("kept"), (F.col("row") == F.col("low.row")).alias("first"),
    )
    alone = rows.filter("n = 0").select(
        "doc_id", "text_hash", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(True).alias("kept"),
        F.lit(True).alias("first"),
    )
    return in_class.union(alone)
