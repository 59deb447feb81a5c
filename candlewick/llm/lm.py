"""A log-bilinear language model over word classes, fitted by noise-contrastive
estimation, that gives every token a normalised probability.

Words: each of the most frequent has a class of its own; other words share
classes by their last two bytes. The model predicts the next class from the two
before it: context vectors pass through a matrix for each position, and the sum
is compared with every class's vector. All training text counts: word counts
are gathered from every document, and so are the class trigrams; each step of the
estimation goes over all of them. A word's probability is its class's times
its share of the class's training tokens; words never seen share the mass that
Good-Turing gives them. Over the distinct training words and one unseen word
the probabilities sum to one.

Word counts travel by block of documents: each block's distinct words are
joined with the corpus's counts and come back to it, so no task or broadcast
holds the whole vocabulary.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.llm.common import stage

TOP, SUFFIXES = 47, 48
#: Class 0 is the end, 1 to TOP are single words, the rest are suffix classes.
CLASSES = 1 + TOP + SUFFIXES
END = np.uint64(0)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def tokens(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and suffix numbers of a text's words and of the end."""
    raw = (text or "").encode("utf-8", "surrogatepass").lower()
    ws = raw.split()
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, ws), np.uint64, len(ws))
    buf = np.frombuffer(b" " + raw + b" ", np.uint8)
    space = _SPACE[buf]
    last = np.flatnonzero(~space[:-1] & space[1:])
    before = np.where(space[last - 1], 0, buf[last - 1]).astype(np.int64)
    return np.append(h, END), np.append((buf[last].astype(np.int64) * 53 + before * 11) % SUFFIXES, 0)


class Classes:
    def __init__(self, top: list[int]):
        """``top``: hashes of the single words, as signed 64-bit."""
        h = np.array(top, np.int64).view(np.uint64)
        order = np.argsort(h)
        self.hashes, self.number = h[order], order + 1

    def of(self, h: np.ndarray, suffix: np.ndarray) -> np.ndarray:
        out = suffix + 1 + TOP
        if len(self.hashes):
            at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
            out = np.where(self.hashes[at] == h, self.number[at], out)
        return np.where(h == END, 0, out)


def trigrams(classes: np.ndarray) -> np.ndarray:
    """Each token with the two classes before it (ends before the first), as one number."""
    padded = np.concatenate([[0, 0], classes])
    return (padded[:-2] * CLASSES + padded[1:-1]) * CLASSES + padded[2:]


def fit(cells: np.ndarray, counts: np.ndarray, dim: int = 32, steps: int = 300, noise: int = 32, seed: int = 5) -> np.ndarray:
    """Noise-contrastive estimation on class trigrams: (CLASSES^2, CLASSES)
    natural log-probabilities, each row normalised. ``seed`` is for where the vectors
    start; nothing is drawn from the data or the noise.

    A step takes the gradient over all training tokens, each against ``noise`` noise
    tokens in expectation. Scores are sums of a part for each of the two classes before,
    so the sums over contexts need no table larger than CLASSES^3."""
    rng = np.random.default_rng(seed)
    data = np.bincount(cells, counts, CLASSES**3).reshape(CLASSES, CLASSES, CLASSES)
    uni = data.sum((0, 1)) + 0.5
    uni /= uni.sum()
    log_uni = np.log(uni)
    p = {
        "r": rng.normal(0, 0.1, (2, CLASSES, dim)), "c": np.stack([np.eye(dim)] * 2) * 0.5,
        "q": rng.normal(0, 0.1, (CLASSES, dim)), "b": log_uni.copy(),
    }
    first = {k: np.zeros_like(v) for k, v in p.items()}
    second = {k: np.zeros_like(v) for k, v in p.items()}
    if len(cells):
        data /= data.sum()
        both = data + noise * data.sum(2, keepdims=True) * uni
    for step in range(1, steps + 1 if len(cells) else 1):
        guess = [p["r"][i] @ p["c"][i] for i in (0, 1)]
        parts = [g @ p["q"].T for g in guess]
        # log-odds that a class is data rather than one of the noise samples
        odds = parts[0][:, None, :] + (parts[1] + p["b"] - np.log(noise) - log_uni)
        error = both / (1 + np.exp(-odds)) - data
        g = {k: np.zeros_like(v) for k, v in p.items()}
        for i in (0, 1):
            e = error.sum(1 - i)
            back = e @ p["q"]
            g["q"] += e.T @ guess[i]
            g["c"][i] = p["r"][i].T @ back
            g["r"][i] = back @ p["c"][i].T
        g["b"] = e.sum(0)
        rate = 0.05 * (1 - step / (steps + 1))
        for k in p:
            first[k] = 0.9 * first[k] + 0.1 * g[k]
            second[k] = 0.99 * second[k] + 0.01 * g[k] ** 2
            p[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
    a, b = p["r"][0] @ p["c"][0], p["r"][1] @ p["c"][1]
    scores = (a[:, None, :] + b[None, :, :]).reshape(-1, dim) @ p["q"].T + p["b"]
    scores -= scores.max(1, keepdims=True)
    return scores - np.log(np.exp(scores).sum(1, keepdims=True))


def score(
    spark: SparkSession, docs: DataFrame, held_out: str = "held_out", block_bytes: int = 24 << 20
) -> DataFrame:
    """``docs(doc_id, text, <held_out>)`` -> ``(doc_id, held_out, n_tokens,
    n_known, train_tokens, base_score, score)``, one row per row.

    Learns from rows where ``held_out`` is false. Null and empty texts are one
    end. Repeated rows count as often as they stand; without training rows
    every token is unseen. ``block_bytes`` of text make a block, which is what
    a task holds. Other columns of ``docs`` are left out.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.col(held_out).alias("held_out"))
    size = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    blocks = -(-size // block_bytes) or 1
    blocked = docs.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int"))

    def count(group: pa.Table) -> pa.Table:
        hs, sfx, train = [], [], []
        for text, out in zip(group["text"].to_pylist(), group["held_out"].to_pylist()):
            h, s = tokens(text)
            hs.append(h)
            sfx.append(s.astype(np.int16))
            train.append(np.full(len(h), not out))
        h, at, back = np.unique(np.concatenate(hs), return_index=True, return_inverse=True)
        n = np.bincount(back, np.concatenate(train), len(h)).astype(np.int64)
        return pa.table({
            "block": pa.array(np.full(len(h), group["block"][0].as_py(), np.int32)), "h": pa.array(h.view(np.int64)),
            "suffix": pa.array(np.concatenate(sfx)[at]), "n": pa.array(n),
        })

    pairs = stage(spark, blocked.groupBy("block").applyInArrow(count, "block int, h long, suffix short, n long"), "words")
    vocabulary = stage(
        spark, pairs.groupBy("h").agg(F.sum("n").alias("c"), F.first("suffix").alias("suffix")).filter("c > 0"), "vocabulary"
    )
    total, distinct, once = vocabulary.agg(
        F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1)), F.count(F.when(F.col("c") == 1, 1))
    ).first()
    words = vocabulary.filter(F.col("h") != 0)
    top = [r["h"] for r in words.orderBy(F.desc("c"), "h").limit(TOP).collect()]
    kinds = Classes(top)
    shares = np.zeros(CLASSES)
    for r in words.filter(~F.col("h").isin(top)).groupBy("suffix").agg(F.sum("c").alias("c")).collect():
        shares[r["suffix"] + 1 + TOP] = r["c"]

    def classes(batches):
        """Counts of class trigrams in this task's training text."""
        held = np.zeros(CLASSES**3, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                np.add.at(held, trigrams(kinds.of(*tokens(text))), 1)
        cell = np.flatnonzero(held)
        for i in range(0, len(cell), 50_000):
            some = cell[i : i + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(held[some])], names=["cell", "n"])

    counted = docs.filter(~F.col("held_out")).select("text").mapInArrow(classes, "cell int, n long")
    # at most CLASSES^3 rows
    grams = counted.groupBy("cell").agg(F.sum("n").alias("n")).orderBy("cell").toPandas()
    table = fit(grams["cell"].to_numpy(np.int64), grams["n"].to_numpy(np.float64)) / np.log(10)
    model = spark.sparkContext.broadcast(table.astype(np.float32))
    unseen = min(max(once / total, 1 / (total + 1)), 0.5) if total else 1.0

    def rate(group: pa.Table, known: pa.Table) -> pa.Table:
        vocabulary = known["h"].to_numpy().view(np.uint64)
        order = np.argsort(vocabulary)
        vocabulary, c_of = vocabulary[order], known["c"].to_numpy()[order]
        table, cols = model.value.reshape(-1), [[], [], [], []]
        for text in group["text"].to_pylist():
            h, suffix = tokens(text)
            c = np.zeros(len(h))
            if len(vocabulary):
                at = np.minimum(np.searchsorted(vocabulary, h), len(vocabulary) - 1)
                c = np.where(vocabulary[at] == h, c_of[at], 0).astype(np.float64)
            kind = kinds.of(h, suffix)
            seen = c > 0
            own = np.where(kind > TOP, c / np.maximum(shares[kind], 1), 1.0)
            p = np.full(len(h), np.log10(unseen))
            if seen.any():
                p[seen] = (table[trigrams(kind)[seen]] + np.log10(own[seen])) + np.log10(1 - unseen)
            base = np.log10((c + 0.5) / (total + 0.5 * (distinct + 1)))
            for col, v in zip(cols, (len(h), int(seen.sum()), float(base.sum()), float(p.sum()))):
                col.append(v)
        n = len(group)
        return pa.table({
            "doc_id": group["doc_id"], "held_out": group["held_out"], "n_tokens": pa.array(cols[0], pa.int64()),
            "n_known": pa.array(cols[1], pa.int64()), "train_tokens": pa.array([total] * n, pa.int64()),
            "base_score": pa.array(cols[2], pa.float64()), "score": pa.array(cols[3], pa.float64()),
        })

    kind = docs.schema["doc_id"].dataType.simpleString()
    back = pairs.select("block", "h").join(vocabulary.select("h", "c"), "h")
    return blocked.groupBy("block").cogroup(back.groupBy("block")).applyInArrow(
        rate,
        f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )
