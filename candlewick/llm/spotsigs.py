"""SpotSigs fingerprints: chains of content words that follow common words.

A spot signature is an anchor (a very common word) with the next ``chain``
content words. A text's fingerprint is the set of its signatures' hashes. Texts
with few anchors also carry a section where every word is an anchor, and very
short ones a section of character 4-grams; two fingerprints are compared by the
finest section that both have, through Jaccard similarity pruned by set sizes.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.llm.common import connected_components, number_rows, partitions, release, slices, stage
from candlewick.llm.decontaminate import words
from candlewick.session import staged_run

#: Common words of four languages (fixed values).
ANCHORS = (
    "the of and to in a is that it for on was with be as by this are from at an or not "
    "der die das und den von zu mit ist des auf für nicht ein eine dem sich als auch "
    "de la le les et un une du en que qui est dans pour par sur pas au "
    "el los las y se por con una para es no lo del al su"
).split()
#: Below so many words (or anchors), every word counts as an anchor as well.
FEW_WORDS, FEW_ANCHORS = 64, 16
#: Below so many code points, character 4-grams are kept as well.
FEW_CHARS = 256
#: Slots of the table that ranks signatures by rarity, and bits of a parity bitmap.
SLOTS, BITS = 1 << 18, 512

Sections = dict[str, np.ndarray]


def _mix(*parts: np.ndarray) -> np.ndarray:
    out = np.zeros(len(parts[0]), np.uint64)
    for p in parts:
        out = (out ^ p) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return np.unique((out >> np.uint64(16)).astype(np.uint32))


class Anchors:
    """Finds anchors among word hashes: a table of the low bits, then exactly."""

    def __init__(self, of: tuple[str, ...] | list[str] = ANCHORS):
        self.hashes = np.unique(np.array([zlib.crc32(w.encode()) for w in of], np.uint64))
        self.low = np.zeros(1 << 16, bool)
        self.low[self.hashes & np.uint64(0xFFFF)] = True

    def at(self, h: np.ndarray) -> np.ndarray:
        maybe = np.flatnonzero(self.low[h & np.uint64(0xFFFF)])
        return maybe[np.isin(h[maybe], self.hashes)]


def sections(text: str, anchors: Anchors, chain: int = 2) -> Sections:
    """Sorted distinct 32-bit hashes by section: ``s`` spots, ``a`` all words,
    ``c`` characters."""
    ws = words(text)
    h = np.fromiter(map(zlib.crc32, ws), np.uint64, len(ws))
    at = anchors.at(h)
    content = np.ones(len(h), bool)
    content[at] = False
    content = np.flatnonzero(content)
    after = np.searchsorted(content, at)
    whole = after + chain <= len(content)
    at, after = at[whole], after[whole]
    out = {"s": _mix(h[at], *(h[content[after + k]] for k in range(chain)))}
    if len(ws) < FEW_WORDS or len(at) < FEW_ANCHORS:
        out["a"] = _mix(h[:-1], h[1:]) if len(h) > 1 else _mix(h)
    if len(text) < FEW_CHARS or not len(ws):
        c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        out["c"] = _mix(*(c[k : len(c) - 3 + k] for k in range(4))) if len(c) > 3 else _mix(c)
    return out


def encode(of: Sections) -> str:
    return ";".join(k + v.astype(">u4").tobytes().hex() for k, v in of.items())


def decode(fingerprint: str) -> Sections:
    return {p[0]: np.frombuffer(bytes.fromhex(p[1:]), ">u4").astype(np.uint32) for p in fingerprint.split(";")}


def jaccard(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """Jaccard similarity of sorted sets; 0.0 without counting if their sizes
    alone keep it below ``least``."""
    small, large = sorted((len(a), len(b)))
    if not large:
        return 1.0
    if small < least * large or not small:
        return 0.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (small + large - both)


def likeness(a: Sections, b: Sections, least: float = 0.0) -> float:
    """0 to 1, by the finest section that both have; of two texts without
    signatures there, only equal fingerprints are alike."""
    for k in ("c", "a", "s"):
        if k in a and k in b and (len(a[k]) or len(b[k]) or k == "s"):
            if not len(a[k]) and not len(b[k]):
                return float(a.keys() == b.keys() and all(np.array_equal(a[x], b[x]) for x in a))
            return jaccard(a[k], b[k], least)
    return 0.0


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter (whole code points, rounded down) replaced
    by the first as many of ``following``, or all it has."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def _tree(cuts: list[tuple], low: int) -> Column:
    """The number of cuts ``(doc_id, h)`` at or below a row, plus ``low``, by halving."""
    if not cuts:
        return F.lit(low)
    m = len(cuts) // 2
    key, h = cuts[m]
    above = F.col("h") >= h if key is None else (F.col("doc_id") > key) | ((F.col("doc_id") == key) & (F.col("h") >= h))
    return F.when(above, _tree(cuts[m + 1 :], low + m + 1)).otherwise(_tree(cuts[:m], low))


def _cuts(key, ranges: int) -> list[tuple]:
    """Cuts inside the rows of one id, by the text's hash."""
    return [(key, -(1 << 63) + (1 << 64) * j // ranges) for j in range(ranges)]


def with_next(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text)`` dealt into ranges of doc_id and sorted, one
    partition a range: ``(bucket, halo, doc_id, text)``. The first row of the
    next range (of the first range, after the last) ends each range as a halo
    row, so every row's successor is in its own partition. Null ids come first;
    rows of one id follow the text's hash, and an id (or null) with the rows of
    several ranges is cut by it; repeated rows come in any order.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    width = partitions(spark)
    found = rows.agg(
        F.percentile_approx("doc_id", [i / width for i in range(1, width)] or [0.5], 100 * width).alias("cuts"),
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("doc_id").isNull()).alias("none"),
    ).first()
    none = _cuts(None, max(1, found["none"] * width // max(1, found["n"])))[1:]
    cuts = [c for key, n in sorted(Counter(found["cuts"] or []).items()) for c in _cuts(key, n)]
    rows = rows.withColumn("bucket", F.when(F.col("doc_id").isNull(), _tree(none, 0)).otherwise(_tree(cuts, len(none))))
    # one row a range
    firsts = sorted(
        (r["bucket"], r["f"]) for r in rows.groupBy("bucket").agg(F.min(F.struct("doc_id", "h")).alias("f")).collect()
    )
    halo = [(b, f["doc_id"], f["h"], firsts[i - 1][0]) for i, (b, f) in enumerate(firsts)]
    kind = docs.schema["doc_id"].dataType.simpleString()
    heads = spark.createDataFrame(halo, f"bucket int, f_id {kind}, f_h long, before int")
    is_first = F.col("doc_id").eqNullSafe(F.col("f_id")) & (F.col("h") == F.col("f_h"))
    own, copy = F.struct(F.col("bucket"), F.lit(False).alias("halo")), F.struct(F.col("before").alias("bucket"), F.lit(True).alias("halo"))
    return (
        rows.join(F.broadcast(heads), "bucket")
        .withColumn("to", F.explode(F.when(is_first, F.array(own, copy)).otherwise(F.array(own))))
        .select("to.bucket", "to.halo", "doc_id", "text", "h")
        .repartitionById(len(none) + len(cuts) + 1, "bucket")
        .sortWithinPartitions("bucket", "halo", "doc_id", "h").select("bucket", "halo", "doc_id", "text")
    )


def fingerprints(spark: SparkSession, docs: DataFrame, anchors: tuple[str, ...] = tuple(ANCHORS), chain: int = 2) -> DataFrame:
    """``docs(doc_id, text)`` -> ``(doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next)``, one row per row; null texts
    count as empty, other columns are left out. With one row, the next document
    is the document itself."""

    def look(batches):
        spots = Anchors(anchors)
        held: tuple | None = None  # bucket, doc_id, text, sections
        out: list[list] = [[] for _ in range(7)]

        def emit(doc, following, following_sections):
            _, key, text, own = doc
            changed = edited(text, following)
            new = sections(changed, spots, chain) if changed != text else own
            values = (
                key, len(text), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(), encode(own),
                encode(new), likeness(own, new), likeness(own, following_sections),
            )
            for column, v in zip(out, values):
                column.append(v)

        of = None
        for batch in slices(batches):
            of = batch.schema.types[2]
            for bucket, halo, key, text in zip(*(c.to_pylist() for c in batch.columns)):
                if halo and held is None:
                    continue  # a further copy of the next range's first row
                own = sections(text, spots, chain)
                if held is not None:
                    emit(held, text, own)
                held = None if halo else (bucket, key, text, own)
            yield _batch(out, of)
            out = [[] for _ in range(7)]

    kind = docs.schema["doc_id"].dataType.simpleString()
    return with_next(spark, docs).mapInArrow(
        look,
        f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double",
    )


def _batch(out: list[list], of: pa.DataType) -> pa.RecordBatch:
    kinds = [of, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out, kinds)], names=names)


def length_bounds(percent: int, up_to: int) -> np.ndarray:
    """First length of each partition, until beyond ``up_to``: the largest
    partner of any set of a partition is in the next one at most."""
    bounds = [1]
    while bounds[-1] <= up_to:
        bounds.append(bounds[-1] * 100 // percent + 1)
    return np.array(bounds)


def _tagged(section: str, signatures: np.ndarray) -> np.ndarray:
    """64-bit values of their own for each section's signatures."""
    x = (signatures.astype(np.uint64) | np.uint64(ord(section) << 32)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def rarity(reps: DataFrame) -> np.ndarray:
    """How many signatures of all fingerprints fall in each of SLOTS slots: a
    table of one size, counted in the tasks and added up."""

    def look(batches):
        counts = np.zeros(SLOTS, np.int64)
        for batch in slices(batches):
            for print_ in batch.column(0).to_pylist():
                for k, v in decode(print_).items():
                    np.add.at(counts, (_tagged(k, v) % np.uint64(SLOTS)).astype(np.int64), 1)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(counts[at])], names=["slot", "n"])

    out = np.zeros(SLOTS, np.int64)
    total = reps.select("fingerprint").mapInArrow(look, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    for slot, n in total.toPandas().itertuples(index=False):
        out[slot] = n
    return out


def prefix_keys(section: str, signatures: np.ndarray, counts: np.ndarray, percent: int) -> np.ndarray:
    """The buckets of a set: its rarest signatures, as many as two alike sets
    need to share one, in its own length partition and, if it may have shorter
    partners there, in the one before."""
    n = len(signatures)
    tagged = _tagged(section, signatures)
    order = np.lexsort((tagged, counts[(tagged % np.uint64(SLOTS)).astype(np.int64)]))
    shortest = -(-n * percent // 100)
    first = tagged[order[: n - shortest + 1]]
    bounds = length_bounds(percent, n)
    own, low = np.searchsorted(bounds, [n, shortest], side="right")
    return np.concatenate([first ^ (np.uint64(p) * np.uint64(0xA24BAED4963EE407)) for p in range(low, own + 1)]).view(np.int64)


def parity(section: str, signatures: np.ndarray) -> bytes:
    bit = (_tagged(section, signatures) >> np.uint64(40)) % np.uint64(BITS)
    return np.packbits((np.bincount(bit.astype(np.int64), minlength=BITS) & 1).astype(np.uint8)).tobytes()


def _entries(reps: DataFrame, counts: np.ndarray, percent: int) -> DataFrame:
    """``reps(node, fingerprint)`` -> ``(bucket, node, section)``."""

    def look(batches):
        release()
        for batch in slices(batches):
            keys, nodes, kinds = [np.empty(0, np.int64)], [np.empty(0, np.int64)], []
            for node, print_ in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for k, v in decode(print_).items():
                    if len(v):
                        keys.append(prefix_keys(k, v, counts, percent))
                        nodes.append(np.full(len(keys[-1]), node, np.int64))
                        kinds += [k] * len(keys[-1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(keys)), pa.array(np.concatenate(nodes)), pa.array(kinds, pa.string())],
                names=["bucket", "node", "section"],
            )

    return reps.select("node", "fingerprint").mapInArrow(look, "bucket long, node long, section string")


def _bitmaps(reps: DataFrame) -> DataFrame:
    """``reps(node, fingerprint)`` -> ``(node, section, n, bits)``."""

    def look(batches):
        for batch in slices(batches):
            rows = [
                (node, k, len(v), parity(k, v))
                for node, print_ in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                for k, v in decode(print_).items()
            ]
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[c] for r in rows], kind) for c, kind in enumerate(kinds)], names=["node", "section", "n", "bits"]
            )

    return reps.select("node", "fingerprint").mapInArrow(look, "node long, section string, n long, bits binary")


def _alike(x: str, y: str, percent: int) -> bool:
    return round(likeness(decode(x), decode(y), (percent - 0.5) / 100) * 100, 9) >= percent


def _confirmed(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    of = lambda s: reps.select(F.col("node").alias(s), F.col("fingerprint").alias(f"f_{s}"))

    def look(batches):
        for batch in slices(batches):
            ok = [_alike(x, y, percent) for x, y in zip(batch.column("f_a").to_pylist(), batch.column("f_b").to_pylist())]
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    rows = pairs.join(of("a"), "a").join(of("b"), "b").select("a", "b", "f_a", "f_b")
    return rows.mapInArrow(look, "a long, b long")


def _in_blocks(spark: SparkSession, rows: DataFrame, work, schema: str, block: int) -> DataFrame:
    """Give ``work(members, one, two)`` any two blocks of a bucket's rows: the
    columns by name, and the rows of either block. A bucket of any size is cut
    into blocks of ``block`` rows; a task holds two."""
    columns = rows.columns
    numbered = stage(spark, number_rows(rows, ["bucket"], "__at", ["node", "section"], partitions(spark)), "spot-members")
    last = numbered.groupBy("bucket").agg((F.floor(F.max("__at") / block)).cast("int").alias("__last"))
    spread = numbered.withColumn("__mine", F.floor(F.col("__at") / block).cast("int")).join(last, "bucket").withColumn(
        "__other", F.explode(F.sequence(F.lit(0), F.col("__last")))
    ).select(F.least("__mine", "__other").alias("__i"), F.greatest("__mine", "__other").alias("__j"), "__mine", *columns)
    at = columns.index("bucket") + 3

    def done(held):
        members = dict(zip(["mine", *columns], held))
        side = np.array(members["mine"])
        for name in ("node", "label", "n"):
            members[name] = np.array(members[name], np.int64)
        members["bits"] = np.frombuffer(b"".join(members["bits"]), np.uint64).reshape(-1, BITS // 64)
        return work(members, np.flatnonzero(side == side.min()), np.flatnonzero(side == side.max()))

    def look(batches):
        release()
        held, key = None, None
        for batch in slices(batches):
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if (row[at], *row[:2]) != key:
                    if held and (got := done(held)):
                        yield got
                    key, held = (row[at], *row[:2]), [[] for _ in row[2:]]
                for column, v in zip(held, row[2:]):
                    column.append(v)
        if held and (got := done(held)):
            yield got

    return (
        spread.repartition(partitions(spark), "bucket", "__i", "__j").sortWithinPartitions("bucket", "__i", "__j")
        .mapInArrow(look, schema)
    )


def similar(spark: SparkSession, prints: DataFrame, percent: int = 75, rounds: int = 2, block: int = 512) -> DataFrame:
    """``prints(doc_id, fingerprint)`` -> ``(doc_id, class_id, component_id)``,
    one row per row.

    Fingerprints are linked if ``likeness`` is at least ``percent`` / 100.
    ``class_id`` is the smallest doc_id with an equal fingerprint (of texts
    without any signature, empty ones too, these are equal), ``component_id``
    the smallest reachable over links; null ids count only if there is no other.
    Null fingerprints are linked with nothing: both ids are their own. Repeated
    rows are of one class, other columns are left out, an empty table gives
    none. No link is lost: the buckets are exact, whatever their size.

    Copies are one class before any comparison. Then each class is compared with
    the first of its buckets' members that it shares most buckets with, ``rounds``
    times; what is in one component needs no more comparison, the rest of
    each bucket is compared in blocks.
    """
    with staged_run(spark):
        return stage(spark, _similar(spark, prints, percent, rounds, block), "spot-similar", lasting=True)


def _similar(spark: SparkSession, prints: DataFrame, percent: int, rounds: int, block: int) -> DataFrame:
    key = F.md5(F.col("fingerprint").cast("binary"))
    rows = stage(spark, prints.select("doc_id", "fingerprint", key.alias("key")).withColumn("row", F.monotonically_increasing_id()), "spot-prints")
    full = rows.filter("fingerprint IS NOT NULL")
    low = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id"))
    classes = stage(spark, full.groupBy("key").agg(F.min("row").alias("node"), low.alias("low")), "spot-classes")
    reps = stage(
        spark,
        full.join(classes.select(F.col("node").alias("row")), "row", "left_semi").select(F.col("row").alias("node"), "fingerprint"),
        "spot-reps",
    )
    entries = stage(spark, _entries(reps, rarity(reps), percent), "spot-entries")
    shared = entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("bucket")
    live = stage(spark, entries.join(shared, "bucket"), "spot-buckets")
    links, labels = None, None

    def labelled() -> DataFrame:
        now = live.withColumn("label", F.col("node"))
        if labels is not None:
            now = live.join(labels.select(F.col("id").alias("node"), "component"), "node", "left").select(
                *live.columns, F.coalesce("component", "node").alias("label")
            )
        now = stage(spark, now, "spot-labelled")
        apart = now.groupBy("bucket").agg(F.min("label").alias("x"), F.max("label").alias("y")).filter("x <> y")
        return stage(spark, now.join(apart.select("bucket"), "bucket"), "spot-open")

    now = labelled()
    for k in range(rounds):
        order = F.col("node") if k == 0 else F.xxhash64("node", F.lit(k))
        hubs = now.groupBy("bucket").agg(F.min_by(F.struct("node", "label"), F.struct(order, "node")).alias("hub"))
        met = now.join(hubs, "bucket").filter("label <> hub.label").groupBy("node", F.col("hub.node").alias("hub")).agg(
            F.count(F.lit(1)).alias("c")
        )
        best = met.groupBy("node").agg(F.max_by("hub", F.struct("c", "hub")).alias("hub"))
        pairs = stage(spark, best.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct(), "spot-pairs")
        new = _confirmed(pairs, reps, percent)
        links = stage(spark, new if links is None else links.union(new), "spot-links")
        # equal labels are connected; whole components come at the end
        labels = connected_components(spark, links, "spot-components", rounds=3)
        now = labelled()

    def partners(m: dict, i: int, two: np.ndarray) -> np.ndarray:
        label, n, bits = m["label"], m["n"], m["bits"]
        ok = two[label[two] != label[i]]
        ok = ok[np.minimum(n[ok], n[i]) * 100 >= np.maximum(n[ok], n[i]) * percent]
        differ = np.bitwise_count(bits[ok] ^ bits[i]).sum(-1, dtype=np.int64)
        return ok[differ * (100 + percent) <= (n[ok] + n[i]) * (100 - percent)]

    def involved(m: dict, one: np.ndarray, two: np.ndarray) -> pa.RecordBatch | None:
        found = np.zeros(len(m["node"]), bool)
        for i in one:
            ok = partners(m, i, two)
            found[ok] = True
            found[i] |= len(ok) > 0
        if found.any():
            return pa.RecordBatch.from_arrays(
                [pa.array(np.array(m["bucket"])[found], pa.int64()), pa.array(m["node"][found])], names=["bucket", "node"]
            )

    def linked(m: dict, one: np.ndarray, two: np.ndarray) -> pa.RecordBatch | None:
        up: dict = {}

        def top(x):
            while up.get(x, x) != x:
                x = up[x]
            return x

        a, b = [], []
        for i in one:
            for j in partners(m, i, two):
                x, y = top(m["label"][i]), top(m["label"][j])
                if x != y and _alike(m["fingerprint"][i], m["fingerprint"][j], percent):
                    up[x] = y
                    a.append(m["node"][i])
                    b.append(m["node"][j])
        if a:
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    now = stage(spark, now.join(_bitmaps(reps), ["node", "section"]), "spot-open")
    near = stage(spark, _in_blocks(spark, now, involved, "bucket long, node long", block).distinct(), "spot-involved")
    held = now.join(near, ["bucket", "node"], "left_semi").join(reps, "node")
    new = _in_blocks(spark, held, linked, "a long, b long", block)
    labels = connected_components(spark, new if links is None else links.union(new), "spot-components")
    member = classes.join(labels.withColumnRenamed("id", "node"), "node", "left").select(
        "key", "low", F.coalesce("component", "node").alias("component")
    )
    lows = member.groupBy("component").agg(F.min("low").alias("lowest"))
    found = member.join(lows, "component").select(
        "key", F.col("low.doc_id").alias("class_id"), F.col("lowest.doc_id").alias("component_id")
    )
    return full.select("doc_id", "key").join(found, "key").select("doc_id", "class_id", "component_id").union(
        rows.filter("fingerprint IS NULL").select("doc_id", F.col("doc_id").alias("class_id"), F.col("doc_id").alias("component_id"))
    )
