"""Token-id files compressed by Re-Pair grammars.

A file is a Parquet table of blocks ``(shard, block, doc_ids, n_tokens, data)``.
``data`` holds, little-endian: the magic ``RPR1``, four unsigned 32-bit counts
(documents, rules, symbols in the sequence, first nonterminal), the documents'
lengths, each rule's pair of symbols, each rule's expansion length, and the
sequence in 16 or 32 bits a symbol. A rule only names symbols before it.
Expansion lengths place every symbol of the sequence in the ids, so one
document is decoded without the rest of its block.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from candlewick.llm.common import segments
from candlewick.llm.tokens import encoder

MAGIC = b"RPR1"
_SLOTS = 17


def _slot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    mixed = a.astype(np.uint32) * np.uint32(0x9E3779B1) + b.astype(np.uint32) * np.uint32(0x85EBCA6B)
    return (mixed >> np.uint32(32 - _SLOTS)).astype(np.int32)


def grammar(
    ids: np.ndarray, alphabet: int, least: int = 8, per_round: int = 4096, rounds: int = 12, gain: float = 0.01
) -> tuple[np.ndarray, np.ndarray]:
    """Re-Pair in rounds: (sequence, rules).

    A round counts adjacent pairs, makes nonterminals for the ``per_round`` most
    frequent (``least`` times or more) and replaces their places left to right;
    of pairs that overlap the first is replaced. It ends when a round shortens
    the sequence by less than ``gain`` or symbols no longer fit in 16 bits (32
    if the alphabet doesn't). Counting goes through a table of hashed pairs
    first, so that only pairs of full slots are sorted.
    """
    seq = ids.astype(np.int32)
    rules: list[np.ndarray] = []
    top = alphabet
    limit = 1 << (16 if alphabet < 1 << 16 else 31)
    for _ in range(rounds):
        room = min(per_round, limit - top)
        if len(seq) < 2 * least or room <= 0:
            break
        a, b = seq[:-1], seq[1:]
        slot = _slot(a, b)
        counts = np.bincount(slot, minlength=1 << _SLOTS)
        full = counts[counts >= least]
        if not len(full):
            break
        # slots that can hold one of the most frequent pairs
        floor = least if len(full) <= room else int(np.partition(full, -room)[-room])
        at = np.flatnonzero(counts[slot] >= floor)
        pairs, n = np.unique(a[at].astype(np.int64) << 32 | b[at], return_counts=True)
        pairs, n = pairs[n >= least], n[n >= least]
        order = np.argsort(-n, kind="stable")[:room]
        pairs = pairs[order]
        left, right = (pairs >> 32).astype(np.int32), (pairs & 0xFFFFFFFF).astype(np.int32)
        # one pair for each slot, the most frequent
        own = np.unique(_slot(left, right), return_index=True)[1]
        own.sort()
        left, right = left[own], right[own]
        which = np.full(1 << _SLOTS, -1, np.int32)
        which[_slot(left, right)] = np.arange(len(left))
        rule = which[slot[at]]
        ok = rule >= 0
        at, rule = at[ok], rule[ok]
        ok = (a[at] == left[rule]) & (b[at] == right[rule])
        at, rule = at[ok], rule[ok]
        if not len(at):
            break
        # runs of overlapping places keep every second one
        new_run = np.diff(at, prepend=at[0] - 2) != 1
        run_start = at[np.flatnonzero(new_run)][np.cumsum(new_run) - 1]
        ok = (at - run_start) % 2 == 0
        at, rule = at[ok], rule[ok]
        if len(at) < gain * len(seq):
            break
        keep = np.ones(len(seq), bool)
        keep[at + 1] = False
        seq = seq.copy()
        seq[at] = top + rule
        seq = seq[keep]
        rules.append(np.stack([left, right], 1))
        top += len(left)
    return seq, np.concatenate(rules) if rules else np.empty((0, 2), np.int32)


def expansion_lengths(rules: np.ndarray, alphabet: int) -> np.ndarray:
    out = np.ones(len(rules), np.int64)
    todo = np.arange(len(rules))
    done = np.zeros(len(rules), bool)
    while len(todo):
        kids = rules[todo] - alphabet
        ready = np.all((kids < 0) | done[np.maximum(kids, 0)], 1)
        now = todo[ready]
        kids = rules[now] - alphabet
        out[now] = np.where(kids < 0, 1, out[np.maximum(kids, 0)]).sum(1)
        done[now] = True
        todo = todo[~ready]
    return out


def write_block(ids: np.ndarray, lengths: np.ndarray, alphabet: int, **how) -> bytes:
    seq, rules = grammar(ids, alphabet, **how)
    wide = "<u2" if alphabet + len(rules) <= 1 << 16 else "<u4"
    return b"".join((
        MAGIC,
        struct.pack("<4I", len(lengths), len(rules), len(seq), alphabet),
        lengths.astype("<u4").tobytes(),
        rules.astype("<u4").tobytes(),
        expansion_lengths(rules, alphabet).astype("<u4").tobytes(),
        seq.astype(wide).tobytes(),
    ))


class Block:
    """A block's bytes, decoded whole or by document."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a grammar block")
        docs, n_rules, n_seq, self.alphabet = struct.unpack_from("<4I", data, 4)
        at = 20
        self.lengths = np.frombuffer(data, "<u4", docs, at).astype(np.int64)
        at += 4 * docs
        self.rules = np.frombuffer(data, "<u4", 2 * n_rules, at).reshape(-1, 2).astype(np.int64)
        at += 8 * n_rules
        self.sizes = np.frombuffer(data, "<u4", n_rules, at).astype(np.int64)
        at += 4 * n_rules
        self.seq = np.frombuffer(data, "<u2" if self.alphabet + n_rules <= 1 << 16 else "<u4", n_seq, at).astype(np.int64)

    def _size(self, symbols: np.ndarray) -> np.ndarray:
        rule = symbols - self.alphabet
        return np.where(rule < 0, 1, self.sizes[np.maximum(rule, 0)]) if len(self.sizes) else np.ones(len(symbols), np.int64)

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        """Replace nonterminals by their pairs until none is left."""
        while len(symbols) and (deep := symbols >= self.alphabet).any():
            where = np.arange(len(symbols)) + segments(deep.astype(np.int64))
            out = np.empty(len(symbols) + int(deep.sum()), np.int64)
            out[where[~deep]] = symbols[~deep]
            pair = self.rules[symbols[deep] - self.alphabet]
            out[where[deep]] = pair[:, 0]
            out[where[deep] + 1] = pair[:, 1]
            symbols = out
        return symbols

    def all(self) -> np.ndarray:
        """All ids; each rule is expanded once, then copied to its places."""
        if not len(self.rules):
            return self.seq
        starts = segments(self.sizes)
        flat = self.expand(np.arange(len(self.rules)) + self.alphabet)
        # terminals stand after the rules' expansions in one table
        table = np.concatenate([flat, np.arange(self.alphabet)])
        rule = self.seq - self.alphabet
        begin = np.where(rule < 0, len(flat) + self.seq, starts[np.maximum(rule, 0)])
        size = self._size(self.seq)
        return table[np.repeat(begin - segments(size), size) + np.arange(int(size.sum()))]

    def document(self, i: int) -> np.ndarray:
        """One document's ids, from the symbols that cover them."""
        first = int(self.lengths[:i].sum())
        end = first + int(self.lengths[i])
        stops = np.cumsum(self._size(self.seq))
        a, b = np.searchsorted(stops, first, "right"), np.searchsorted(stops, end, "left") + 1
        before = int(stops[a - 1]) if a else 0
        return self.expand(self.seq[a:b])[first - before : end - before]


def write(
    spark: SparkSession, docs: DataFrame, path: str, tokenizer: str, end_id: int = 1, block_tokens: int = 1 << 20,
    shards: int | None = None,
) -> None:
    """Write ``docs(doc_id, text)`` as grammar blocks in ascending doc_id order.

    Shards are ranges of doc_id (null first; rows of one id by the text's hash;
    repeated rows in any order), about ``shards`` of them (the session's shuffle
    width). A block closes at ``block_tokens`` ids; a longer document is one
    block. Null and empty texts have the end id alone. Other columns are left
    out; an empty table writes no rows.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    width = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def blocks(batches):
        from pyspark import TaskContext

        enc, shard = encoder(tokenizer), TaskContext.get().partitionId()
        end = end_id.to_bytes(4, "little")
        alphabet = max(enc.tok.get_vocab_size(), end_id + 1)
        names = ["shard", "block", "doc_ids", "n_tokens", "data"]
        number, keys, raws, size = 0, [], [], 0

        def close(of):
            ids = np.frombuffer(b"".join(raws), "<u4")
            lengths = np.fromiter((len(r) // 4 for r in raws), np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([number], pa.int32()), pa.array([keys], pa.list_(of)),
                 pa.array([len(ids)], pa.int64()), pa.array([write_block(ids, lengths, alphabet)], pa.binary())],
                names=names,
            )

        of = None
        for batch in batches:
            of = batch.schema.types[0]
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for at in range(0, len(texts), 256):
                for key, raw in zip(ids[at : at + 256], enc.encode(texts[at : at + 256])):
                    keys.append(key)
                    raws.append(raw + end)
                    size += len(raw) // 4 + 1
                    if size >= block_tokens:
                        yield close(of)
                        number, keys, raws, size = number + 1, [], [], 0
        if keys:
            yield close(of)

    rows = docs.select("doc_id", "text")
    (
        rows.withColumn("__h", F.xxhash64("text"))
        .repartitionByRange(width, "doc_id", "__h").sortWithinPartitions("doc_id", "__h").drop("__h")
        .mapInArrow(blocks, f"shard int, block int, doc_ids array<{kind}>, n_tokens long, data binary")
        .write.parquet(path)
    )


def read(spark: SparkSession, path: str, columns: dict | None = None) -> DataFrame:
    """The documents of a file: ``(doc_id, start, n_tokens, ids)``. ``start`` is
    the number of ids before the document in the whole file. ``columns`` are
    made from ``ids`` as blocks are decoded, and replace it."""
    stored = spark.read.parquet(path)
    kind = stored.schema["doc_ids"].dataType.elementType.simpleString()
    sizes = stored.select("shard", "block", "n_tokens")
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    # one row a shard: a few thousand at most
    shards = sizes.groupBy("shard").agg(F.sum("n_tokens").alias("__n"))
    shards = shards.select("shard", F.coalesce(F.sum("__n").over(before(Window.orderBy("shard"))), F.lit(0)).alias("__a"))
    inside = F.coalesce(F.sum("n_tokens").over(before(Window.partitionBy("shard").orderBy("block"))), F.lit(0))
    bases = sizes.withColumn("__b", inside).join(shards, "shard").select(
        "shard", "block", (F.col("__a") + F.col("__b")).alias("base")
    )

    def decode(batches):
        for batch in batches:
            for shard, block, keys, data in zip(*(batch.column(i) for i in range(4))):
                held = Block(data.as_py())
                ids = held.all().astype("<u4")
                cuts = np.append(segments(held.lengths), len(ids))
                for i in range(0, len(cuts) - 1, 2000):
                    part = cuts[i : i + 2001]
                    n = len(part) - 1
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([shard.as_py()] * n, pa.int32()), pa.array([block.as_py()] * n, pa.int32()),
                         keys.values[i : i + n], pa.array(part[:-1]), pa.array(np.diff(part)),
                         pa.array([ids[a:b].tobytes() for a, b in zip(part[:-1], part[1:])], pa.binary())],
                        names=["shard", "block", "doc_id", "start", "n_tokens", "ids"],
                    )

    rows = stored.select("shard", "block", "doc_ids", "data").mapInArrow(
        decode, f"shard int, block int, doc_id {kind}, start long, n_tokens long, ids binary"
    )
    made = columns or {"ids": F.col("ids")}
    rows = rows.select("shard", "block", "doc_id", "start", "n_tokens", *[c.alias(n) for n, c in made.items()])
    return rows.join(bases, ["shard", "block"]).select(
        "doc_id", (F.col("base") + F.col("start")).alias("start"), "n_tokens", *made
    )
