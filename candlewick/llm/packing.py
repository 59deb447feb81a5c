"""Packing token pieces into as few fixed-capacity sequences as possible.

Everything is decided on the histogram of piece lengths, which has at most
``capacity`` entries however large the corpus is. A configuration is a multiset
of lengths that fits in one sequence. The configuration linear program (as few
configurations as cover every length's count) is solved by multiplicative
weights: each length's weight falls as its coverage grows, and a knapsack
dynamic program finds the configurations worth most at the present weights.
Whole multiples are taken, the rest of the histogram is solved again, and what
no longer fills a whole configuration is placed best-fit decreasing.

The plan is a list of runs over (length, rank); pieces are numbered within
their length and each finds its sequence and offset by binary search.
"""

from __future__ import annotations

import bisect

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.llm.common import number_rows, partitions, place_runs, release, slices, stage
from candlewick.llm.tokens import encoder

#: (lengths in placing order with copies, number of sequences of this kind)
Plan = list[tuple[list[tuple[int, int]], int]]


def pieces(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """``docs(doc_id, text)`` -> ``(doc_id, piece, start, length, ids)``; ``ids``
    are little-endian unsigned 32-bit. Null and empty texts have the end id
    alone. Only documents longer than ``capacity`` are cut. Repeated rows give
    repeated pieces; other columns of ``docs`` are left out."""

    def cut(batches):
        release(encoder.cache_clear)
        for batch in slices(batches):
            doc, piece, start, length, ids = [], [], [], [], []
            keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for at in range(0, len(texts), 256):
                for key, raw in zip(keys[at : at + 256], encoder(tokenizer).encode(texts[at : at + 256])):
                    raw += end_id.to_bytes(4, "little")
                    for k, i in enumerate(range(0, len(raw), 4 * capacity)):
                        part = raw[i : i + 4 * capacity]
                        doc.append(key)
                        piece.append(k)
                        start.append(i // 4)
                        length.append(len(part) // 4)
                        ids.append(part)
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc, batch.schema.types[0]), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(ids, pa.binary())],
                names=["doc_id", "piece", "start", "length", "ids"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        cut, f"doc_id {kind}, piece int, start long, length long, ids binary"
    )


def _price(sizes: np.ndarray, value: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Unbounded knapsack: best value and last size used, for each capacity.
    ``sizes`` ascend."""
    best = np.zeros(capacity + 1)
    last = np.full(capacity + 1, -1, np.int64)
    fits = np.searchsorted(sizes, np.arange(capacity + 1), side="right")
    for c in range(int(sizes[0]), capacity + 1):
        k = fits[c]
        worth = value[:k] + best[c - sizes[:k]]
        i = int(worth.argmax())
        if worth[i] > best[c - 1]:
            best[c], last[c] = worth[i], i
        else:
            best[c], last[c] = best[c - 1], -1
    return best, last


def _configuration(first: int, sizes: np.ndarray, last: np.ndarray, capacity: int) -> tuple[tuple[int, int], ...]:
    """Size ``first`` and the best filling of what it leaves, as (size index, copies)."""
    copies = {first: 1}
    c = capacity - int(sizes[first])
    while c > 0:
        i = int(last[c])
        if i < 0:
            c -= 1
            continue
        copies[i] = copies.get(i, 0) + 1
        c -= int(sizes[i])
    return tuple(sorted(copies.items()))


def configuration_lp(sizes: np.ndarray, counts: np.ndarray, capacity: int, rounds: int = 60, slack: float = 0.05):
    """Fractional covering by multiplicative weights: {configuration: amount}.

    Each round prices all configurations at the present weights; those within
    ``slack`` of the best value join, each by an amount that covers at most a
    fixed share of any length."""
    weight, covered = np.ones(len(sizes)), np.zeros(len(sizes))
    amounts: dict[tuple, float] = {}
    for _ in range(rounds):
        value = weight / counts
        best, last = _price(sizes, value, capacity)
        worth = value + best[capacity - sizes]
        chosen = {_configuration(int(i), sizes, last, capacity) for i in np.flatnonzero(worth >= (1 - slack) * best[-1])}
        gained = np.zeros(len(sizes))
        for conf in chosen:
            at = np.fromiter((i for i, _ in conf), np.int64)
            n = np.fromiter((a for _, a in conf), np.float64)
            amount = float((counts[at] / n).min()) * 2 / rounds
            amounts[conf] = amounts.get(conf, 0.0) + amount
            gained[at] += n * amount / counts[at]
        covered += gained
        if covered.min() >= 1:
            break
        weight *= np.exp(-8 * np.minimum(gained, 1.0))
        weight /= weight.max()
    over = np.maximum(covered, 1.0)
    return {conf: x / max(over[i] for i, _ in conf) for conf, x in amounts.items()}


def best_fit(lengths: dict[int, int], capacity: int) -> Plan:
    """Best-fit decreasing on a histogram; bins alike are kept as one entry."""
    room: dict[int, list[list]] = {}
    keys: list[int] = []

    def put(left: int, content: list, n: int) -> None:
        if left not in room:
            bisect.insort(keys, left)
            room[left] = []
        room[left].append([content, n])

    for size in sorted(lengths, reverse=True):
        n = lengths[size]
        while n:
            at = bisect.bisect_left(keys, size)
            if at == len(keys):
                put(capacity, [], -(-n // max(1, capacity // size)))
                continue
            left = keys[at]
            content, bins = room[left].pop()
            if not room[left]:
                del room[left]
                keys.pop(at)
            each = min(left // size, n)
            used = min(bins, n // each)
            if bins > used:
                put(left, content, bins - used)
            put(left - each * size, [*content, (size, each)], used)
            n -= each * used
    return [(content, n) for some in room.values() for content, n in some if content]


def plan(lengths: dict[int, int], capacity: int, passes: int = 4) -> Plan:
    """Configurations with their numbers of sequences, covering the histogram.

    Each pass solves the program for what is left and takes whole multiples; the rest is
    placed best-fit decreasing. Of the plans after each pass (and of none, which is
    best fit alone) the one with the fewest sequences is kept, of equal ones the one
    that the program went furthest with."""
    left = {s: n for s, n in lengths.items() if n}
    alone: Plan = []
    smallest = min(left, default=0)
    for s in [s for s in left if s + smallest > capacity]:
        alone.append(([(s, 1)], left.pop(s)))
    made: Plan = []
    best = best_fit(left, capacity)
    fewest = sum(n for _, n in best)
    for _ in range(passes):
        if not left:
            break
        sizes = np.array(sorted(left), np.int64)
        counts = np.array([left[int(s)] for s in sizes], np.float64)
        amounts = configuration_lp(sizes, counts, capacity)
        taken = 0
        # the fullest configurations first: their sequences waste least
        for conf in sorted(amounts, key=lambda c: (-sum(int(sizes[i]) * a for i, a in c), -amounts[c], c)):
            n = min(int(amounts[conf] + 0.5), *(left.get(int(sizes[i]), 0) // a for i, a in conf))
            if n:
                made.append(([(int(sizes[i]), a) for i, a in conf], n))
                for i, a in conf:
                    left[int(sizes[i])] -= a * n
                taken += n
        left = {s: n for s, n in left.items() if n}
        if not taken:
            break
        whole = made + best_fit(left, capacity)
        if (total := sum(n for _, n in whole)) <= fewest:
            best, fewest = whole, total
    return alone + best


def pack(spark: SparkSession, items: DataFrame, capacity: int = 2048, order: tuple[str, ...] = ("doc_id", "piece")) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to rows with a ``length`` of 1 to
    ``capacity``. ``items`` is read twice: give a stored table."""
    hist = {int(r["length"]): int(r["n"]) for r in items.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    if any(not 0 < s <= capacity for s in hist):
        raise ValueError(f"lengths must be 1 to {capacity}")
    rows, used, base = [], dict.fromkeys(hist, 0), 0
    for content, n in plan(hist, capacity):
        offset = 0
        for size, copies in content:
            rows.append((size << 40 | used[size], base, n, offset, size))
            used[size] += copies * n
            offset += copies * size
        base += n
    assert used == hist
    table = np.array(sorted(rows) or [(0, 0, 1, 0, 0)], np.int64)

    def place(run, k):
        n = table[run, 2]
        return {"sequence_id": table[run, 1] + k % n, "offset": table[run, 3] + k // n * table[run, 4]}

    ranked = number_rows(items, ["length"], "__rank", list(order), partitions(spark))
    return place_runs(ranked, table[:, 0], place, "sequence_id long, offset long", ("length", "__rank")).drop("__rank")


def pack_documents(spark: SparkSession, docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """Tokenize, cut and pack; one row per piece with a digest of its ids. The
    ids themselves are those of :func:`pieces`."""
    cut = pieces(docs, tokenizer, capacity, end_id).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return pack(spark, stage(spark, cut, "pieces"), capacity, ("doc_id", "piece", "ids_crc32"))
