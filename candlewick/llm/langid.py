"""Language identification: averaged hashed subword embeddings and a linear
softmax, trained by stochastic gradient descent, with calibrated rejection.

A text's subwords are its runs of 2 to 4 UTF-8 bytes (lower-cased). Since the
classifier is linear in the average, each subword's embedding times the output
matrix is kept as one row of language scores.

A text is rejected for the share of its three-byte subwords that training never
saw, however many languages there are: a softmax over the known languages says
nothing of others.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from candlewick.llm.common import slices, thinned

BUCKETS, DIM, ORDERS = 1 << 15, 16, (2, 3, 4)
UNKNOWN = "und"
#: The order looked at for unseen subwords, and how many seen ones each text is
#: given besides, so that a word or two don't decide.
FAMILIAR, SPARE = ORDERS.index(3), 10
_LETTER = np.zeros(256, bool)
_LETTER[[9, 10, 13, 32, *range(97, 123), *range(128, 256)]] = True


@dataclass
class Model:
    langs: list[str]
    rows: np.ndarray  # (BUCKETS + 1, languages), the last row zero
    temperature: float
    seen: np.ndarray  # by bucket: whether training has it as a subword of order FAMILIAR
    strange: np.ndarray  # by language: largest share of unseen subwords of accepted texts


def subwords(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each subword of each order, (orders, positions), and where each
    text's positions begin. Texts are padded, so none reaches into the next;
    runs into the padding count as the zero bucket's."""
    pad = b"\0" * ORDERS[-1]
    buf = np.frombuffer(pad.join(texts) + pad, np.uint8)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + len(pad)
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    n = len(buf) - ORDERS[-1] + 1
    wide = buf.astype(np.uint32)
    h = np.zeros(n, np.uint32)
    out = np.empty((len(ORDERS), n), np.int32)
    for k in range(ORDERS[-1]):
        h = (h + wide[k : k + n] + np.uint32(1)) * np.uint32(0x01000193) + np.uint32(k)
        if k + 1 in ORDERS:
            i = ORDERS.index(k + 1)
            out[i] = (h * np.uint32(0x9E3779B1)) >> np.uint32(17)
            out[i][(buf[:n] == 0) | (buf[k : k + n] == 0)] = BUCKETS
    return out, starts


def _size(texts: list[bytes]) -> np.ndarray:
    """Subwords of each text, as a column."""
    return len(ORDERS) * np.maximum(np.fromiter(map(len, texts), np.float64, len(texts)), 1)[:, None]


def _bytes(text: str | None) -> bytes:
    return (text or "").lower().encode("utf-8", "surrogatepass").replace(b"\0", b" ")


def train(
    samples: list[tuple[str, str]], chunk: int = 240, max_chunks: int = 16_000, epochs: int = 3, seed: int = 11
) -> Model:
    """Fit on (text, language) pairs: whole texts in chunks of ``chunk`` bytes,
    ``max_chunks`` of them drawn evenly by language; a fifth of the texts sets
    the temperature. Each fifth in turn is held back for the rejection
    threshold: the share of subwords unseen in the other four that one in 200
    of a language's texts exceeds."""
    rng = np.random.default_rng(seed)
    langs = sorted({lang for _, lang in samples})
    if not langs:
        return Model([], np.zeros((BUCKETS + 1, 0), np.float32), 1.0, np.zeros(BUCKETS + 1, bool), np.zeros(0))
    kept, held = [], []
    for text, lang in samples:
        raw = _bytes(text)
        parts = [(raw[i : i + chunk], langs.index(lang)) for i in range(0, len(raw), chunk)]
        (held if rng.random() < 0.2 and len(samples) > 50 else kept).append(parts)
    fitted = []
    for i in range(len(langs)):
        own = [p for parts in kept for p in parts if p[1] == i]
        fitted += [own[j] for j in rng.permutation(len(own))[: max_chunks // len(langs)]]
    e = rng.normal(0, 0.1, (BUCKETS + 1, DIM))
    e[-1] = 0
    w = np.zeros((DIM, len(langs)))
    steps, step = epochs * max(1, -(-len(fitted) // 32)), 0
    for _ in range(epochs):
        order = rng.permutation(len(fitted))
        for at in range(0, len(order), 32):
            some = [fitted[j] for j in order[at : at + 32]]
            ids, starts = subwords([p for p, _ in some])
            lengths = np.diff(np.append(starts, ids.shape[1]))
            which = np.repeat(np.arange(len(some)), lengths)
            n = _size([p for p, _ in some])
            mean = sum(np.add.reduceat(e[row], starts) for row in ids) / n
            z = mean @ w
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(some)), [y for _, y in some]] -= 1
            rate = 4.0 * (1 - step / steps)
            back = (p @ w.T / n * rate)[which]
            w -= rate * mean.T @ p / len(some)
            for row in ids:
                np.add.at(e, row, -back)
            e[-1] = 0
            step += 1
    model = Model(langs, (e @ w).astype(np.float32), 1.0, *_familiar(samples, langs))
    test = [(b"".join(p for p, _ in parts), parts[0][1]) for parts in (held or kept) if parts]
    if test:
        z = logits(model, [t for t, _ in test])
        y = np.array([y for _, y in test])
        grid = np.geomspace(0.05, 5, 40)
        loss = [-np.log(np.maximum(_softmax(z / t)[np.arange(len(y)), y], 1e-12)).mean() for t in grid]
        model.temperature = float(grid[int(np.argmin(loss))])
    return model


def _lettered(texts: list[bytes], row: np.ndarray) -> np.ndarray:
    """Whether each position's subword of order FAMILIAR has letters and space
    only, so that numbers, keys and signs count neither way."""
    pad, n = b"\0" * ORDERS[-1], len(row)
    ok = _LETTER[np.frombuffer(pad.join(texts) + pad, np.uint8)]
    return ok[:n] & ok[1 : n + 1] & ok[2 : n + 2] & (row < BUCKETS)


def _familiar(samples: list[tuple[str, str]], langs: list[str], folds: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Buckets seen in training, and the threshold of each language."""
    counts, own = np.zeros((folds, BUCKETS + 1), np.int64), []
    for i, (text, _) in enumerate(samples):
        row = subwords([_bytes(text)])[0][FAMILIAR]
        own.append(row[_lettered([_bytes(text)], row)].astype(np.uint16))
        counts[i % folds, own[-1]] += 1
    every = counts.sum(0)
    new = every - counts == 0  # by fold: unseen in the others
    share = np.array([new[i % folds, row].sum() / (len(row) + SPARE) for i, row in enumerate(own)])
    of = np.array([langs.index(lang) for _, lang in samples])
    return every > 0, np.array([np.quantile(share[of == k], 0.995) for k in range(len(langs))])


def _softmax(z: np.ndarray) -> np.ndarray:
    p = np.exp(z - z.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def logits(model: Model, texts: list[bytes]) -> np.ndarray:
    return _look(model, texts)[0]


def _look(model: Model, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Language scores of each text, and its share of unseen subwords."""
    ids, starts = subwords(texts)
    row = ids[FAMILIAR]
    ok = _lettered(texts, row)
    n = np.add.reduceat(ok, starts, dtype=np.int64)
    new = np.add.reduceat(ok & ~model.seen[row], starts, dtype=np.int64)
    z = sum(np.add.reduceat(model.rows[row], starts, dtype=np.float64) for row in ids) / _size(texts)
    return z, new / (n + SPARE)


def predict(model: Model, texts: list[str | None]) -> list[tuple[str, float, bool]]:
    """(language, score, accepted) of each text; texts without a letter are
    unknown, with score 0, and rejected; others are rejected if more of their
    subwords are unseen than the threshold of the best language allows. A model without languages knows none and
    accepts every text with a letter."""
    out = [(UNKNOWN, 0.0, False)] * len(texts)
    some = [i for i, t in enumerate(texts) if t and any(map(str.isalpha, t))]
    if not model.langs:  # nothing was learned, so nothing can be rejected
        for i in some:
            out[i] = (UNKNOWN, 0.0, True)
        return out
    at = 0
    while at < len(some):
        # about half a MB at a time: its subwords take some 50 times that
        end, size, raws = at, 0, []
        while end < len(some) and size < 1 << 19:
            raws.append(_bytes(texts[some[end]]))
            size += len(raws[-1])
            end += 1
        z, strange = _look(model, raws)
        p = _softmax(z / model.temperature)
        best = p.argmax(1)
        for i, k, row, new in zip(some[at:end], best, p, strange):
            out[i] = (model.langs[k], float(row[k]), bool(new <= model.strange[k]))
        at = end
    return out


def fit(spark: SparkSession, docs: DataFrame, per_language: int = 300, max_bytes: int = 20_000, languages: int = 200) -> Model:
    """Learn from ``docs(doc_id, text, lang)``: for each of the ``languages`` most
    frequent non-null languages, ``per_language`` texts with a letter and of at
    most ``max_bytes`` bytes, in the order of their ids' hashes. Those bounds
    hold at every size, and keep what reaches the driver below their product."""
    usable = docs.filter(
        F.col("lang").isNotNull() & (F.octet_length("text") <= max_bytes) & F.col("text").rlike(r"\p{L}")
    ).select("doc_id", "text", "lang")
    common = usable.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(languages)
    sizes = {r["lang"]: r["count"] for r in common.collect()}
    if not sizes:
        return train([])
    by_hash = Window.partitionBy("lang").orderBy("__share", "text")
    rows = thinned(usable, "lang", "doc_id", sizes, dict.fromkeys(sizes, per_language)).withColumn(
        "rank", F.row_number().over(by_hash)
    ).filter(F.col("rank") <= per_language)
    return train(sorted((r["text"], r["lang"]) for r in rows.select("text", "lang").collect()))


def identify(spark: SparkSession, docs: DataFrame, model: Model) -> DataFrame:
    """All columns of ``docs`` plus ``lang_pred``, ``score``, ``accepted``
    (columns of those names are replaced); only ``text`` is looked at. Null and
    empty texts and those without a letter are ``und``, 0.0, not accepted.
    Rows stay one by one, an empty table gives none."""
    held = spark.sparkContext.broadcast(model)

    def look(batches):
        for batch in slices(batches):
            found = predict(held.value, batch.column("text").to_pylist())
            cols = [pa.array([f[i] for f in found], t) for i, t in enumerate((pa.string(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *cols], names=[*batch.schema.names, *names])

    names = ["lang_pred", "score", "accepted"]
    rest = docs.drop(*names)
    return rest.mapInArrow(
        look, rest.withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0), "accepted": F.lit(True)}).schema
    )
