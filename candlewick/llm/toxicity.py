"""Toxicity by a subsequence string-kernel support vector machine.

The kernel of two words compares their subsequences of three letters, each gap
of skipped characters (up to two between neighbours) costing a factor, so
insults with gaps or inserted characters stay close to the plain ones. Words of
labelled texts are the instances; a sample of them are the landmarks of a
Nyström approximation, in which a linear support vector machine is trained. It starts
from words that are in surprisingly many toxic texts, and disguised forms of
these, against words of clean texts; then rounds add the words that it calls toxic and
that toxic texts favour, and, as counterexamples, those of clean texts that come near.

What a text's score rests on is the machine's verdict on its words. Words with a
positive decision value are grouped by the toxic landmark that the kernel finds
nearest (landmarks alike form one group). A text's probability is a logistic
function of its highest value, the number and share of toxic words, and how far each
group's share of the text's distinct words exceeds that in clean texts that
have any: some words are toxic only by how often they come.

The decision function is a sum over landmarks of kernel values; the kernel
counts letter triples, so the sum is kept as one weight for each triple.

Words are counted, looked up and scored on the executors; what reaches the driver is
bounded by the arguments of ``fit``: candidate words, a sample of clean words, and some
numbers for each text of the sample.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from candlewick.llm.common import partitions, release, slices, stage, thinned
from candlewick.session import staged_run

GAP, DECAY, LONGEST = 2, 0.5, 24
TRIPLES = 1 << 15
#: Decision values are cut below this: such words are as good as clean.
FLOOR = -1.0
#: Digits and signs that stand for letters (fixed values).
_LEET = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}
#: Stands for a word's start and end, which count as letters.
EDGE = "\1"
_OUTER = "!\"#%&'()*+,-./:;<=>?[\\]^_`{|}~"
#: Three or more single characters in a row.
_SPELLED = re.compile(r"(?<!\S)\S(?:\s\S(?!\S)){2,}")


def _letters() -> np.ndarray:
    """Code point -> 1 to 26 for a to z in either case and what stands for them,
    27 to 30 for other letters, 31 for EDGE, 0 for anything else."""
    out = np.zeros(0x10000, np.uint8)
    for cp in range(0x10000):
        ch = chr(cp)
        base = _LEET.get(ch, ch.lower()[:1])
        if "a" <= base <= "z":
            out[cp] = ord(base) - 96
        elif ch.isalpha():
            out[cp] = 27 + ord(base) % 4
    out[ord(EDGE)] = 31
    return out


LETTERS = _letters()


def split(text: str | None) -> list[str]:
    """Words at white space; spelled-out words are joined as well; words beyond
    LONGEST also in overlapping pieces, so that all of a text is seen."""
    if not text:
        return []
    out = text.split()
    for run in _SPELLED.findall(text):
        out.append("".join(run.split()))
    if max(map(len, out), default=0) > LONGEST:
        out = [w[i : i + LONGEST] for w in out for i in range(0, max(1, len(w) - LONGEST // 2), LONGEST // 2)]
    return out


_GAPS = [(1 + i, 2 + i + j, DECAY ** (i + j)) for i in range(GAP + 1) for j in range(GAP + 1)]
_PAD = 2 * GAP + 2


def _occurrences(words: list[str]):
    """For each gap pattern: (triple at each character, weight), and where each
    word's characters begin. Triples with a character that is no letter are 0."""
    words = [EDGE + w.replace(EDGE, "").strip(_OUTER) + EDGE for w in words]
    text = ("\0" * _PAD).join(words) + "\0" * _PAD
    cp = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    x = LETTERS[np.where(cp < 0x10000, cp, 0)].astype(np.int32)
    n = len(x) - _PAD
    starts = np.concatenate([[0], np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + _PAD)[:-1]])
    parts = []
    for a, b, weight in _GAPS:
        one, two, three = x[:n], x[a : a + n], x[b : b + n]
        parts.append((np.where((one > 0) & (two > 0) & (three > 0), one * 1024 + two * 32 + three, 0), weight))
    return parts, starts


def triples(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words' explicit kernel features: (word, triple, weight), weights of
    one triple added up, each word scaled to length 1."""
    if not words:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    parts, starts = _occurrences(words)
    word = np.searchsorted(starts, np.arange(len(parts[0][0])), side="right") - 1
    keys, weights = [], []
    for t, weight in parts:
        at = np.flatnonzero(t)
        keys.append(word[at] * TRIPLES + t[at])
        weights.append(np.full(len(at), weight))
    key, back = np.unique(np.concatenate(keys), return_inverse=True)
    value = np.bincount(back, np.concatenate(weights), len(key))
    word, triple = key // TRIPLES, key % TRIPLES
    norm = np.sqrt(np.bincount(word, value**2, len(words)))
    return word, triple, value / norm[word]


def kernel(words: list[str], landmarks: np.ndarray) -> np.ndarray:
    """(words, landmarks) kernel values in 0 to 1; ``landmarks`` is (TRIPLES, m)."""
    out = np.zeros((len(words), landmarks.shape[1]))
    step = max(1, 128_000 // max(1, landmarks.shape[1]))
    for i in range(0, len(words), step):
        word, triple, value = triples(words[i : i + step])
        np.add.at(out[i : i + step], word, landmarks[triple] * value[:, None])
    return out


def _dense(words: list[str]) -> np.ndarray:
    word, triple, value = triples(words)
    out = np.zeros((TRIPLES, len(words)), np.float32)
    out[triple, word] = value
    return out


@dataclass
class Model:
    weights: np.ndarray  # one for each triple
    bias: float
    curve: np.ndarray  # of the logistic function of a text's features, constant last
    landmarks: list[str]  # the toxic ones
    kind: np.ndarray  # group of each
    usual: np.ndarray  # share of words by group in clean texts with any

    def decide(self, words: list[str]) -> np.ndarray:
        """Decision value of each word, not below FLOOR."""
        out = np.full(len(words), FLOOR)
        for i in range(0, len(words), 20_000):
            some = words[i : i + 20_000]
            parts, starts = _occurrences(some)
            top, square = np.zeros(len(parts[0][0])), np.zeros(len(parts[0][0]))
            for t, weight in parts:
                top += self.weights[t] * weight
                square += (t > 0) * weight**2
            top, square = np.add.reduceat(top, starts), np.add.reduceat(square, starts)
            # a word's length is at least that of its triples taken one by one
            near = np.flatnonzero((top > 0) & (top / np.sqrt(np.maximum(square, 1e-12)) + self.bias > FLOOR))
            if len(near):
                word, triple, value = triples([some[j] for j in near])
                exact = np.bincount(word, value * self.weights[triple], len(near)) + self.bias
                out[i + near] = np.maximum(exact, FLOOR)
        return out

    @cached_property
    def _dense_landmarks(self) -> np.ndarray:
        return _dense(self.landmarks)

    def group(self, words: list[str], values: np.ndarray) -> np.ndarray:
        """Group of each word with a decision value above 0, that of its nearest toxic
        landmark; else -1."""
        out = np.full(len(words), -1)
        at = np.flatnonzero(values > 0)
        if len(at):
            near = kernel([words[i] for i in at], self._dense_landmarks)
            out[at] = self.kind[near.argmax(1)]
        return out

    def features(self, e: Evidence) -> list[float]:
        """A text's features: the highest value, how many words are toxic, their share,
        and the excess of the groups over their usual shares."""
        k = np.zeros(len(self.usual))
        for g, n in e.groups.items():
            k[g] = n
        usual = e.distinct * self.usual
        over = np.where(k > usual, k * np.log(np.maximum(k, 1e-9) / np.maximum(usual, 1e-12)) - (k - usual), 0.0)
        times = np.where(k > usual, np.log((k + 1) / (usual + 1)), 0.0)
        return [
            e.top, float(np.log1p(e.hits)), float(np.log((e.hits + 0.1) / (e.words + 20))),
            float(np.log1p(over.sum())), float(times.sum()), 1.0,
        ]

    def probability(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(features @ self.curve, -500, 500)))


def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-4, epochs: int = 40, seed: int = 3):
    """Hinge-loss linear machine by averaged stochastic subgradients."""
    rng = np.random.default_rng(seed)
    w, b = np.zeros(x.shape[1]), 0.0
    mean_w, mean_b, steps, t = np.zeros_like(w), 0.0, epochs * -(-len(y) // 256), 0
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for at in range(0, len(y), 256):
            i = order[at : at + 256]
            bad = weight[i] * (y[i] * (x[i] @ w + b) < 1) * y[i]
            rate = 2.0 / (1 + t / 200)
            w = w * (1 - rate * ridge) + rate * x[i].T @ bad / len(i)
            b += rate * bad.mean()
            t += 1
            if t > steps // 2:
                mean_w += w
                mean_b += b
    n = max(1, steps - steps // 2)
    return mean_w / n, mean_b / n


#: Hashes that near copies are told by.
SKETCH = 8


def _sketch(text: str | None) -> list[int]:
    """A few smallest word hashes of a text."""
    bag = {w.encode("utf-8", "surrogatepass") for w in split(text)}
    return [min(zlib.crc32(w, k) for w in bag) if bag else -1 for k in range(SKETCH)]


def _distinct(sketches: np.ndarray) -> list[int]:
    """One text of each group of near copies: texts that agree in half of their
    hashes count as copies of the first."""
    kept: list[int] = []
    for i, row in enumerate(sketches):
        if not kept or ((sketches[kept] == row).sum(1) < sketches.shape[1] // 2).all():
            kept.append(i)
    return kept


def _letters_in(word: str) -> int:
    return sum(LETTERS[min(ord(c), 0xFFFF)] > 0 for c in word)


def _surprise(n1: np.ndarray, n0: np.ndarray, of1: int, of0: int) -> np.ndarray:
    """Log-likelihood ratio of words being in ``n1`` of ``of1`` toxic and ``n0`` of
    ``of0`` clean texts; 0 unless over four times as common in toxic ones."""
    p = np.maximum(n1 + n0, 1) / (of1 + of0)
    in_1 = n1 * np.log(np.maximum(n1, 1) / of1 / p)
    in_0 = n0 * np.log(np.maximum(n0, 1) / of0 / p)
    return np.where(n1 / of1 > 4 * n0 / of0, 2 * (in_1 + in_0), 0.0)


def _disguised(word: str) -> list[str]:
    """A word with characters put between its letters, doubled or masked."""
    m = len(word) // 2
    return [".".join(word), "-".join(word), word[:m] + "-" + word[m:], word[:m] + word[m] + word[m:], word[:m] + "*" + word[m:]]


#: How surprising a word must be to be a candidate; how many texts a word that a
#: round adds must be in; decision value from which a clean word is a counterexample.
SURPRISE, ROUND_TEXTS, NEAR = 12.0, 3, -0.9
#: Kernel values: landmarks more alike than this are one; in one group.
ALIKE, LINKED = 0.9, 0.5


def _candidate(words: list[str], n1: np.ndarray, n0: np.ndarray, of1: int, of0: int) -> np.ndarray:
    """Surprise of words with three letters or more, 0 where it is too little."""
    gain = _surprise(n1, n0, of1, of0)
    spelled = np.fromiter((_letters_in(w) > 2 for w in words), bool, len(words))
    return np.where(spelled & (gain > SURPRISE), gain, 0.0)


def _verdicts(model: Model, words: list[str], n1: np.ndarray, n0: np.ndarray, of1: int, of0: int):
    """Decision values, and 1 for words that a round adds as toxic, 0 for
    counterexamples, -1 for others."""
    value = model.decide(words)
    spelled = np.fromiter((_letters_in(w) > 2 for w in words), bool, len(words))
    toxic = (value > 0) & spelled & (n1 >= ROUND_TEXTS) & (n1 / of1 > 4 * n0 / of0)
    return value, np.where(toxic, 1, np.where((value > NEAR) & (n0 / of0 >= n1 / of1), 0, -1))


class _Texts:
    """A labelled sample in memory: (text, 0 or 1). Near copies count once."""

    def __init__(self, texts: list[tuple[str, int]]):
        texts = sorted({(t or "", label) for t, label in texts})
        sketches = np.array([_sketch(t) for t, _ in texts]).reshape(len(texts), SKETCH)
        self.texts = [texts[i] for i in _distinct(sketches)]
        self.of1 = sum(label for _, label in self.texts)
        self.of0 = len(self.texts) - self.of1
        counts = _count(self.texts)
        self.words = sorted(counts)
        self.n1 = np.array([counts[w][1] for w in self.words])
        self.n0 = np.array([counts[w][0] for w in self.words])

    def candidates(self, most: int) -> list[tuple[str, int]]:
        """The most surprising words and the number of clean texts they are in."""
        gain = _candidate(self.words, self.n1, self.n0, self.of1, self.of0)
        order = [i for i in np.lexsort((np.arange(len(gain)), -gain))[:most] if gain[i] > 0]
        return [(self.words[i], int(self.n0[i])) for i in order]

    def members(self, words: list[str]) -> list[list[int]]:
        """For each toxic text with any, which of ``words`` it holds."""
        return [at for t, label in self.texts if label and (at := _inside(t, {w: i for i, w in enumerate(words)}))]

    def clean(self, most: int) -> list[str]:
        """A sample of the words of clean texts."""
        few = [w for w, n in zip(self.words, self.n0) if n]
        return sorted(few, key=lambda w: (zlib.crc32(w.encode("utf-8", "surrogatepass")), w))[:most]

    def verdicts(self, model: Model, most: int) -> tuple[list[str], list[str]]:
        """Words that a round adds as toxic, and counterexamples, the highest first."""
        value, kind = _verdicts(model, self.words, self.n1, self.n0, self.of1, self.of0)
        order = np.argsort(-value, kind="stable")
        return tuple([self.words[i] for i in order if kind[i] == k][:most] for k in (1, 0))

    def evidence(self, model: Model) -> list[tuple[int, Evidence]]:
        scorer = _Scorer(model)
        return [(label, e) for (_, label), e in zip(self.texts, scorer.evidence([t for t, _ in self.texts]))]


def _count(texts: list[tuple[str, int]]) -> dict[str, list[int]]:
    """Word -> in how many clean and toxic texts it is."""
    out: dict[str, list[int]] = {}
    for text, label in texts:
        for w in set(split(text)):
            out.setdefault(w, [0, 0])[label] += 1
    return out


def _inside(text: str, number: dict[str, int]) -> list[int]:
    return sorted({number[w] for w in split(text) if w in number})


class _StoredTexts:
    """The same over ``rows(__id, text, __toxic)`` of a staged sample: texts and word
    counts stay on the executors."""

    def __init__(self, spark: SparkSession, rows: DataFrame):
        self.spark = spark

        def sketch(batches):
            release()
            for batch in slices(batches):
                got = [_sketch(t) for t in batch.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("__id"), batch.column("__toxic"), pa.array(got, pa.list_(pa.int64()))],
                    names=["__id", "__toxic", "sketch"],
                )

        # one row of a few numbers for each text of the sample
        seen = rows.mapInArrow(sketch, "__id long, __toxic int, sketch array<long>").orderBy("__id").collect()
        kept = [seen[i] for i in _distinct(np.array([r["sketch"] for r in seen]).reshape(len(seen), SKETCH))]
        self.of1 = sum(r["__toxic"] for r in kept)
        self.of0 = len(kept) - self.of1
        ids = spark.createDataFrame([(r["__id"],) for r in kept], "__id long")
        self.rows = rows.join(F.broadcast(ids), "__id")

        def count(batches):
            for batch in slices(batches):
                got = _count(list(zip(batch.column("text").to_pylist(), batch.column("__toxic").to_pylist())))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(got), pa.string()), *(pa.array([n[k] for n in got.values()], pa.int64()) for k in (1, 0))],
                    names=["word", "n1", "n0"],
                )

        counts = self.rows.mapInArrow(count, "word string, n1 long, n0 long")
        self.counts = stage(
            spark, counts.groupBy("word").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0")), "toxicity-words"
        )

    def _look(self, judge) -> DataFrame:
        """(word, n0, value, kind) of the words that ``judge`` gives a kind above -1."""
        def look(batches):
            for batch in batches:
                words = batch.column("word").to_pylist()
                n1, n0 = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("n1", "n0"))
                value, kind = judge(words, n1, n0)
                at = pa.array(np.flatnonzero(kind >= 0))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("word").take(at), batch.column("n0").take(at),
                     pa.array(value, pa.float64()).take(at), pa.array(kind, pa.int32()).take(at)],
                    names=["word", "n0", "value", "kind"],
                )

        return self.counts.mapInArrow(look, "word string, n0 long, value double, kind int")

    def candidates(self, most: int) -> list[tuple[str, int]]:
        of1, of0 = self.of1, self.of0

        def judge(words, n1, n0):
            gain = _candidate(words, n1, n0, of1, of0)
            return gain, np.where(gain > 0, 0, -1)

        best = self._look(judge).orderBy(F.desc("value"), "word").limit(most).collect()
        return [(r["word"], r["n0"]) for r in best]

    def members(self, words: list[str]) -> list[list[int]]:
        number = {w: i for i, w in enumerate(words)}

        def look(batches):
            for batch in slices(batches):
                got = [at for t in batch.column("text").to_pylist() if (at := _inside(t, number))]
                yield pa.RecordBatch.from_arrays([pa.array(got, pa.list_(pa.int64()))], names=["words"])

        return [r["words"] for r in self.rows.filter("__toxic = 1").mapInArrow(look, "words array<long>").collect()]

    def clean(self, most: int) -> list[str]:
        few = self.counts.filter("n0 > 0").orderBy(F.crc32(F.col("word").cast("binary")), "word").limit(most)
        return [r["word"] for r in few.select("word").collect()]

    def verdicts(self, model: Model, most: int) -> tuple[list[str], list[str]]:
        held, of1, of0 = self.spark.sparkContext.broadcast(model), self.of1, self.of0
        judged = self._look(lambda words, n1, n0: _verdicts(held.value, words, n1, n0, of1, of0))
        judged = stage(self.spark, judged, "toxicity-verdicts")
        best = lambda k: judged.filter(F.col("kind") == k).orderBy(F.desc("value"), "word").limit(most).collect()
        return tuple([r["word"] for r in best(k)] for k in (1, 0))

    def evidence(self, model: Model) -> list[tuple[int, Evidence]]:
        held = self.spark.sparkContext.broadcast(model)

        def look(batches):
            scorer = _Scorer(held.value)
            for batch in slices(batches):
                got = scorer.evidence(batch.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("__toxic"), pa.array([e.top for e in got], pa.float64()),
                     *(pa.array([getattr(e, c) for e in got], pa.int64()) for c in ("hits", "words", "distinct")),
                     pa.array([list(e.groups.items()) for e in got], pa.map_(pa.int64(), pa.int64()))],
                    names=["__toxic", "top", "hits", "words", "distinct", "groups"],
                )

        schema = "__toxic int, top double, hits long, words long, distinct long, groups map<long, long>"
        return [
            (r["__toxic"], Evidence(r["top"], r["hits"], r["words"], r["distinct"], r["groups"]))
            for r in self.rows.mapInArrow(look, schema).collect()
        ]


def learn(
    texts: _Texts | _StoredTexts, share: float | None = None, landmarks: int = 256, clean_words: int = 15_000,
    candidates: int = 5_000, added: int = 10_000, rounds: int = 3,
) -> Model:
    """Train on a sample. ``share``: the toxic share of the population, if the sample's
    differs. Without texts of both kinds, or without a telling word, a constant."""
    of1, of0 = texts.of1, texts.of0
    prior = share if share is not None else of1 / max(1, of1 + of0)
    prior = min(max(prior, 1e-3), 1 - 1e-3)
    # a constant model calls nothing toxic
    flat = min(prior, 0.49)
    constant = Model(np.zeros(TRIPLES), FLOOR, np.array([0.0] * 5 + [np.log(flat / (1 - flat))]), [], np.zeros(0, int), np.ones(1))
    if not of1 or not of0:
        return constant
    good = _cover(texts, of1, of0, candidates)
    if not good:
        return constant
    # landmarks: toxic words that differ from those before, and the clean words most like
    # one of them
    close, taken = kernel(good, _dense(good)), []
    for i in range(len(good)):
        if len(taken) < 2 * landmarks // 3 and (close[i, taken] < ALIKE).all():
            taken.append(i)
    toxic = [good[i] for i in taken]
    clean = texts.clean(clean_words)
    against = kernel(clean, _dense(toxic)).max(1, initial=0.0)
    marks = toxic + [clean[i] for i in np.argsort(-against, kind="stable")[: landmarks - len(toxic)]]
    dense = _dense(marks)
    values, vectors = np.linalg.eigh(dense.T @ dense)
    keep = values > 1e-6
    project = vectors[:, keep] / np.sqrt(values[keep])
    kind = _linked(close[np.ix_(taken, taken)])
    hidden = sorted({v for w in good[:60] for v in _disguised(w.strip(_OUTER))} - set(clean))
    x0 = kernel(clean, dense) @ project
    positive, hard = list(good), []
    model = constant
    for _ in range(rounds):
        x1, xh = kernel(positive + hidden, dense) @ project, kernel(hard, dense) @ project
        x = np.concatenate([x1, x0, xh])
        label = np.concatenate([np.ones(len(x1)), -np.ones(len(x0) + len(xh))])
        cost = np.where(label > 0, len(label) / (2 * len(x1)), len(label) / (2 * (len(x0) + len(xh))))
        w, b = _svm(x, label, cost)
        del x
        model = Model(dense @ (project @ w), float(b), np.zeros(6), toxic, kind, np.ones(int(kind.max()) + 1))
        more, against = texts.verdicts(model, added)
        positive = sorted(set(more) | set(good))
        hard = sorted((set(hard) | set(against)) - set(good))
    return _fit_curve(model, texts.evidence(model), prior)


def _cover(texts: _Texts | _StoredTexts, of1: int, of0: int, candidates: int, most: int = 400) -> list[str]:
    """The most surprising word accounts for the toxic texts it is in; a text that two
    words account for no longer counts, nor do words that stand beside them."""
    known = texts.candidates(candidates)
    words, n0 = [w for w, _ in known], np.array([n for _, n in known])
    open_ = [(set(at), 2) for at in texts.members(words)] if words else []
    left = np.zeros(len(words))
    for at, _ in open_:
        left[list(at)] += 1
    picks: list[int] = []
    while len(picks) < most and len(words):
        gain = _surprise(left, n0, of1, of0)
        gain[picks] = 0
        best = int(gain.argmax())
        if gain[best] <= SURPRISE:
            break
        picks.append(best)
        still = []
        for at, need in open_:
            need -= best in at
            if need:
                still.append((at, need))
            else:
                left[list(at)] -= 1
        open_ = still
    return [words[i] for i in picks]


def _linked(close: np.ndarray) -> np.ndarray:
    """Group of each landmark: those that a chain of pairs more alike than LINKED joins."""
    group = np.arange(len(close))
    for i, j in zip(*np.nonzero(close > LINKED)):
        if i > j:
            group[group == group[i]] = group[j]
    return np.unique(group, return_inverse=True)[1]


def _fit_curve(model: Model, seen: list[tuple[int, Evidence]], prior: float) -> Model:
    """Usual shares of the groups, and a logistic function of the texts' features,
    weighted to the population."""
    y = np.array([label for label, _ in seen])
    held, of = np.zeros(len(model.usual)), np.zeros(len(model.usual))
    for label, e in seen:
        if not label:
            for g, k in e.groups.items():
                held[g] += k
                of[g] += e.distinct
    model.usual = (held + 0.5) / (of + 5_000)
    x = np.array([model.features(e) for _, e in seen])
    n1, n0 = int(y.sum()), int(len(y) - y.sum())
    weight = np.where(y == 1, prior / y.mean(), (1 - prior) / (1 - y.mean()))
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    ridge = np.diag([1e-2] * 5 + [0])
    for _ in range(100):
        p = model.probability(x)
        hess = (x * (np.maximum(weight * p * (1 - p), 1e-9))[:, None]).T @ x + ridge + 1e-9 * np.eye(6)
        move = np.linalg.solve(hess, (weight * (p - target)) @ x + ridge @ model.curve)
        move *= min(1.0, 1.0 / max(np.abs(move).max(), 1e-12))
        model.curve = model.curve - move
        if np.abs(move).max() < 1e-6:
            break
    return model


def train(texts: list[tuple[str, int]], share: float | None = None, **options) -> Model:
    """Train on (text, 0 or 1) in memory; options as those of ``learn``."""
    return learn(_Texts(texts), share, **options)


def fit(
    spark: SparkSession, docs: DataFrame, labels: DataFrame, toxic: int = 1500, clean: int = 3000,
    max_bytes: int = 20_000, **options,
) -> Model:
    """Learn from ``docs(doc_id, text)`` with ``labels(doc_id, toxic)``: at most
    ``toxic`` and ``clean`` texts of at most ``max_bytes`` bytes, in the order of
    their ids' hashes; near copies among them count once. Options, as those of
    ``learn``, bound the rest: ``landmarks`` of the kernel machine, ``candidates`` and
    ``clean_words`` that training starts from, words ``added`` by each of the
    ``rounds``. The bounds hold at every size, and so does what reaches the driver.
    Rows without id, text or label are left out; an id with several labels counts as toxic
    if one says so, one with several texts as the least of them."""
    known = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("__toxic"))
    size = docs.filter(F.octet_length("text") <= max_bytes).select("doc_id")
    ids = known.join(size.distinct(), "doc_id")
    ids = ids.withColumn("__toxic", (F.col("__toxic") == 1).cast("int"))
    sizes = {r["__toxic"]: r["count"] for r in ids.groupBy("__toxic").count().collect()}
    if not sizes:
        return train([])
    few = thinned(ids, "__toxic", "doc_id", sizes, {1: toxic, 0: clean})
    first = lambda label, n: few.filter(F.col("__toxic") == label).orderBy("__share", "doc_id").limit(n)
    chosen = first(1, toxic).union(first(0, clean)).select("doc_id", "__toxic")
    with staged_run(spark):
        # at most toxic + clean rows
        rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").filter(
            F.octet_length("text") <= max_bytes
        ).groupBy("doc_id").agg(F.min("text").alias("text"), F.max("__toxic").alias("__toxic"))
        numbered = rows.withColumn("__id", F.row_number().over(Window.orderBy("doc_id")).cast("long"))
        sample = stage(spark, numbered.select("__id", "text", "__toxic"), "toxicity-sample")
        return learn(
            _StoredTexts(spark, sample.repartition(partitions(spark), "__id")), sizes.get(1, 0) / sum(sizes.values()), **options
        )


@dataclass
class Evidence:
    """What the machine's verdicts say about a text: its highest decision value,
    how many of its ``words`` are toxic, how many words are ``distinct``, and how
    many of these are in each group."""

    top: float
    hits: int
    words: int
    distinct: int
    groups: dict[int, int]


class _Scorer:
    """Decision values of words, kept in a bounded table in each worker."""

    def __init__(self, model: Model, max_words: int = 100_000):
        self.model, self.max_words, self.seen = model, max_words, {}

    def evidence(self, texts: list[str | None]) -> list[Evidence]:
        bags = [split(t) for t in texts]
        new = sorted({w for ws in bags for w in ws if w not in self.seen})
        values = self.model.decide(new)
        self.seen.update(zip(new, zip(values.tolist(), self.model.group(new, values).tolist())))
        out = []
        for ws in bags:
            distinct = set(ws)
            groups: dict[int, int] = {}
            for w in distinct:
                if (g := self.seen[w][1]) >= 0:
                    groups[g] = groups.get(g, 0) + 1
            values = [self.seen[w][0] for w in ws]
            out.append(Evidence(max(values, default=FLOOR), sum(v > 0 for v in values), len(ws), len(distinct), groups))
        if len(self.seen) > self.max_words:
            self.seen.clear()
        return out

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        x = [self.model.features(e) for e in self.evidence(texts)]
        return self.model.probability(np.array(x).reshape(-1, 6))


def rate(spark: SparkSession, docs: DataFrame, model: Model) -> DataFrame:
    """All columns of ``docs`` plus ``score`` and ``predicted`` (columns of those
    names are replaced); only ``text`` is looked at. Null, empty and wordless
    texts score as clean ones."""
    held = spark.sparkContext.broadcast(model)
    names = ["score", "predicted"]

    def look(batches):
        release()
        scorer = _Scorer(held.value)
        for batch in slices(batches):
            score = scorer(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(score, pa.float64()), pa.array((score >= 0.5).astype(np.int32))],
                names=[*batch.schema.names, *names],
            )

    rest = docs.drop(*names)
    return rest.mapInArrow(look, rest.withColumns({"score": F.lit(0.0), "predicted": F.lit(0)}).schema)
