"""Benchmark decontamination with one Aho-Corasick automaton.

Every window of consecutive item words is a pattern over words: each word of the
items is one symbol, so the automaton has at most ``window`` nodes for a window. A
document is normalised and scanned once, and matches are mapped back to word
positions and to character offsets of the original text.
"""

from __future__ import annotations

import itertools
import re
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.llm.common import release, slices, stage
from candlewick.session import staged_run

#: Bytes of UTF-8 text -> the same with A-Z lowered and every separator a
#: space. Words are digits, letters a-z and all bytes of other code points.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
HIT = "array<struct<item_id:{item},word:int,words:int,char_start:int,char_end:int>>"


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


def item_windows(items: DataFrame, window: int) -> DataFrame:
    """``items(item_id, text)`` -> (words, item_ids): every different window, its words
    joined by spaces, with the ids of its items; an item of fewer words is one."""
    kind = items.schema["item_id"].dataType

    def cut(batches):
        for batch in slices(batches):
            lines, at = [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                ws = words(text)
                k = min(window, len(ws))
                some = {b" ".join(ws[j : j + k]) for j in range(len(ws) - k + 1 if k else 0)}
                lines += some
                at += [i] * len(some)
            ids = batch.column("item_id").take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(lines, pa.binary()), ids], names=["words", "item_id"])

    found = items.select("item_id", "text").mapInArrow(cut, f"words binary, item_id {kind.simpleString()}")
    # a struct, as a list would leave out a null id
    return found.groupBy("words").agg(F.collect_set(F.struct("item_id")).alias("item_ids"))


class Windows:
    """An automaton over some windows (words, item ids)."""

    #: Symbols of words that are in no window; those of others count up from 1.
    OTHER = "\0"

    def __init__(self, windows: list[tuple[bytes, list]]):
        import ahocorasick

        self.symbols: dict[bytes, str] = {}
        self.found = ahocorasick.Automaton() if windows else None
        #: Runs of known words that are long enough for a window.
        shortest = min((line.count(b" ") + 1 for line, _ in windows), default=1)
        self.runs = re.compile(f"[^{self.OTHER}]{{{shortest},}}", re.S)
        for line, ids in windows:
            ws = line.split(b" ")
            for w in ws:
                if w not in self.symbols:
                    n = len(self.symbols) + 1
                    self.symbols[w] = chr(n if n < 0xD800 else n + 0x800)
            self.found.add_word("".join(self.symbols[w] for w in ws), (len(ws), ids))
        if windows:
            self.found.make_automaton()

    def matches(self, ws: list[bytes]) -> list[tuple[int, int, list]]:
        """(last word, words, item ids) of every window among the words."""
        if self.found is None:
            return []
        line = "".join(map(self.symbols.get, ws, itertools.repeat(self.OTHER)))
        return [
            (run.start() + end, k, ids) for run in self.runs.finditer(line) for end, (k, ids) in self.found.iter(run[0])
        ]


def scan(automata: list[Windows], text: str | None) -> tuple[int, list[tuple]]:
    """(words, [(item id, first word, words, first char, end char)])."""
    ws = words(text)
    hits: list[tuple] = []
    matches = [m for windows in automata for m in windows.matches(ws)] if ws else []
    if matches:
        raw = text.encode("utf-8", "surrogatepass").translate(_FOLD)
        spans = [m.span() for m in re.finditer(rb"[^ ]+", raw)]
        chars = np.cumsum(np.frombuffer(raw, np.uint8) & 0xC0 != 0x80)  # code points begun so far
        for last, k, ids in sorted(matches, key=lambda m: m[:2]):
            first = last - k + 1
            at = int(chars[spans[first][0]]) - 1, int(chars[spans[last][1] - 1])
            hits += [(i, first, k, *at) for i in ids]
    return len(ws), hits


#: The automata of the pass at work, kept by each worker from task to task.
_HELD: dict[str, list[Windows]] = {}


def _automata(name: str, blocks: list) -> list[Windows]:
    if name not in _HELD:
        _HELD.clear()
        _HELD[name] = [Windows(b.value) for b in blocks]
    return _HELD[name]


def find_hits(
    spark: SparkSession, docs: DataFrame, items: DataFrame, window: int = 10, max_windows: int = 100_000, a_pass: int = 4
) -> DataFrame:
    """All columns of ``docs`` plus ``n_words`` and ``hits``, one entry for each
    place where a window of an item stands (columns of those names are replaced).

    Null and empty texts have no words; items without words are never found; a
    null item id is kept as null. Items repeated under one id count once. Documents are
    kept row by row, so repeated rows and null ids need no care.

    One automaton holds about ``max_windows`` different windows, dealt by hash (some
    60 MB; at most as many different words as there are symbols). One pass over the
    documents goes through up to ``a_pass`` automata, built once in each worker; more
    windows take further passes, each over what the one before has staged.
    """
    kind = items.schema["item_id"].dataType.simpleString()
    out = docs.drop("n_words", "hits").withColumn("n_words", F.lit(0).cast("long")).withColumn(
        "hits", F.array().cast(HIT.format(item=kind))
    )
    with staged_run(spark):
        windows = stage(spark, item_windows(items, window), "benchmark-windows")
        n = -(-windows.count() // max_windows) or 1
        blocks = []
        for b in range(n):
            # about max_windows rows
            some = windows.filter(F.pmod(F.xxhash64("words"), F.lit(n)) == b).collect()
            blocks.append(spark.sparkContext.broadcast([(bytes(r["words"]), [i["item_id"] for i in r["item_ids"]]) for r in some]))
    for at in range(0, n, a_pass):
        held, name = blocks[at : at + a_pass], uuid.uuid4().hex

        def look(batches, held=held, name=name):
            release()
            automata = _automata(name, held)
            for batch in slices(batches):
                n, hits = [], []
                for text, old in zip(batch.column("text").to_pylist(), batch.column("hits").to_pylist()):
                    k, new = scan(automata, text)
                    n.append(k)
                    hits.append([tuple(h.values()) for h in old] + new)
                names = batch.schema.names
                arrays = [
                    pa.array(n, pa.int64()) if c == "n_words"
                    else pa.array(hits, batch.schema.field("hits").type) if c == "hits" else batch.column(c)
                    for c in names
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

        out = out.mapInArrow(look, out.schema)
        if at + a_pass < n:
            out = stage(spark, out, "hits")
    return out


def report(hits: DataFrame) -> DataFrame:
    """``(doc_id, n_words, n_hit, n_items, items_sha256, contaminated)`` of rows
    with ``hits``; a word under several windows is hit once. Rows without hits (null and
    empty texts among them) have 0, 0 and the hash of nothing; a null item id isn't
    among the hashed ids. Rows stay one by one, other columns are left out."""
    places = F.flatten(F.transform("hits", lambda h: F.sequence(h["word"], h["word"] + h["words"] - 1)))
    ids = F.array_sort(F.array_distinct(F.transform("hits", lambda h: h["item_id"].cast("string"))))
    n_hit = F.size(F.array_distinct(places)).cast("long")
    return hits.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", ids).cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )
