from __future__ import annotations

import hashlib
import random
from statistics import mean

from candlewick.llm import spotsigs as sp
from candlewick.llm.queries import op10
from tests.conftest import SF001


def _order(docs):
    return sorted(((r.doc_id, r.text or "") for r in docs), key=lambda r: (r[0] is not None, r[0] or 0))


def test_op10_over_the_table(spark):
    docs = _order(spark.read.parquet(f"{SF001}/documents.parquet").collect())
    rows = {r.doc_id: r for r in op10(spark, SF001).collect()}
    assert len(rows) == len(docs)
    anchors = sp.Anchors()
    for (key, text), (_, after) in zip(docs, docs[1:] + docs[:1]):
        new = text[: len(text) - len(text) // 4] + after[: len(text) // 4]
        r = rows[key]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(new.encode()).hexdigest())
        own = sp.sections(text, anchors)
        assert r.fingerprint == sp.encode(own)
        assert r.edited_fingerprint == sp.encode(sp.sections(new, anchors))
        assert abs(r.near_next - sp.likeness(own, sp.sections(after, anchors))) < 1e-12
    assert mean(r.near_edited for r in rows.values()) > 0.5
    assert mean(r.near_next for r in rows.values()) < 0.1


def _plain_likeness(x, y):
    """Of two fingerprints as strings: by sets of their 8-digit signatures."""
    a, b = ({p[0]: {p[i : i + 8] for i in range(1, len(p), 8)} for p in f.split(";")} for f in (x, y))
    for k in "cas":
        if k in a and k in b and (a[k] or b[k]):
            return len(a[k] & b[k]) / len(a[k] | b[k])
    return float(x == y)


def test_op10_likeness_against_sets_of_digits(spark):
    rows = sorted(op10(spark, SF001).collect(), key=lambda r: r.doc_id)
    for r, after in zip(rows, rows[1:] + rows[:1]):
        assert abs(r.near_edited - _plain_likeness(r.fingerprint, r.edited_fingerprint)) < 1e-12
        assert abs(r.near_next - _plain_likeness(r.fingerprint, after.fingerprint)) < 1e-12


def test_signatures_against_plain_words():
    """A chain is an anchor and the next two words that are none."""
    anchors, text = sp.Anchors(), " ".join(f"the w{i} of x{i % 7} y{i % 5} and" for i in range(40))
    ws = text.split()
    chains = set()
    for i, w in enumerate(ws):
        rest = [v for v in ws[i + 1 :] if v not in sp.ANCHORS][:2]
        if w in sp.ANCHORS and len(rest) == 2:
            chains.add((w, *rest))
    assert len(sp.sections(text, anchors)["s"]) == len(chains)


def test_odd_rows(spark, odd_docs, no_docs):
    rows = sp.fingerprints(spark, odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert len({r.fingerprint for r in rows if r.doc_id == 7}) == 1
    assert all(0 <= x <= 1 for r in rows for x in (r.near_edited, r.near_next))
    assert sp.fingerprints(spark, no_docs).count() == 0
    (one,) = sp.fingerprints(spark, odd_docs.filter("doc_id = 11")).collect()
    assert one.near_next == 1.0


def test_a_hot_id_is_cut_by_hash_and_keeps_its_order(spark):
    keys = [None] * 300 + [5] * 300 + list(range(100, 400))
    docs = spark.createDataFrame([(k, f"the text {i} of number {i * 7}") for i, k in enumerate(keys)], "doc_id long, text string")
    rows = sp.with_next(spark, docs).withColumn("part", sp.F.spark_partition_id()).collect()
    for key in (None, 5):
        assert len({r.part for r in rows if r.doc_id == key and not r.halo}) > 1
    order = docs.orderBy(sp.F.col("doc_id").asc_nulls_first(), sp.F.xxhash64("text")).collect()
    after = {a.text: b.text for a, b in zip(order, order[1:] + order[:1])}
    seen = 0
    for one, two in zip(rows, rows[1:]):
        if not one.halo:
            assert (one.bucket, two.text) == (two.bucket, after[one.text])
            seen += 1
    assert seen == len(keys)


def test_chains_skip_anchors_and_strings_round_trip():
    anchors = sp.Anchors()
    a = sp.sections("the cat of the house " * 20 + "sat", anchors)["s"]
    assert set(sp.sections("the cat of the house the cat and house the cat house", anchors)["s"]) & set(a)
    for text in ("", "x", "the cat", "one two three " * 100):
        got = sp.decode(sp.encode(sp.sections(text, anchors)))
        assert sp.likeness(got, sp.sections(text, anchors)) == 1.0


def test_pruning_by_size_never_hides_a_similar_pair():
    import numpy as np

    rng = np.random.default_rng(0)
    for _ in range(300):
        a = np.unique(rng.integers(0, 60, rng.integers(1, 50))).astype(np.uint32)
        b = np.unique(rng.integers(0, 60, rng.integers(1, 50))).astype(np.uint32)
        full = len(set(a) & set(b)) / len(set(a) | set(b))
        assert sp.jaccard(a, b) == full
        assert sp.jaccard(a, b, 0.5) in (full, 0.0) and (full < 0.5 or sp.jaccard(a, b, 0.5) == full)


def _by_brute_force(prints, percent):
    """Smallest reachable id of each row, all pairs compared in full."""
    of = [sp.decode(p) for _, p in prints]
    up = list(range(len(prints)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if prints[i][1] == prints[j][1] or sp.likeness(of[i], of[j]) * 100 >= percent - 1e-9:
                up[top(i)] = top(j)
    low = {}
    for i, (key, _) in enumerate(prints):
        low[top(i)] = min(key, low.get(top(i), key))
    return {key: low[top(i)] for i, (key, _) in enumerate(prints)}


def _variants():
    """Texts of many lengths with near copies at all distances, and one big group."""
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)] + ["the", "of", "and", "to", "in"] * 40
    texts = ["", "", "x", "the the the", "short words here", "short words herf"]
    for n in (3, 10, 30, 70, 100, 180, 400):
        for _ in range(4):
            base = [rng.choice(vocabulary) for _ in range(n)]
            for share in (0, 0, 0.02, 0.05, 0.1, 0.2, 0.4):
                texts.append(" ".join(rng.choice(vocabulary) if rng.random() < share else w for w in base))
            texts.append(" ".join(base + base[: n // 5]) + " " + " ".join(rng.choice(vocabulary) for _ in range(n // 6)))
    base = [rng.choice(vocabulary) for _ in range(120)]
    for i in range(60):
        texts.append(" ".join([*base[:i], f"u{i}", *base[i + 1 :]]))
    return [(i, t) for i, t in enumerate(texts)]


def test_similar_loses_no_link(spark):
    docs = spark.createDataFrame(_variants(), "doc_id long, text string")
    prints = [(r.doc_id, r.fingerprint) for r in sp.fingerprints(spark, docs).collect()]
    frame = spark.createDataFrame(prints, "doc_id long, fingerprint string")
    first = {}
    for key, p in sorted(prints):
        first.setdefault(p, key)
    for percent, rounds, block in ((75, 2, 512), (75, 0, 7), (60, 1, 16)):
        rows = {r.doc_id: r for r in sp.similar(spark, frame, percent, rounds, block).collect()}
        assert {k: r.component_id for k, r in rows.items()} == _by_brute_force(prints, percent), (percent, rounds, block)
        assert all(rows[k].class_id == first[p] for k, p in prints)
    assert len({r.component_id for r in rows.values()}) < len({r.class_id for r in rows.values()})


def test_similar_on_odd_rows(spark, odd_docs, no_docs):
    out = sp.similar(spark, sp.fingerprints(spark, odd_docs)).collect()
    assert len(out) == odd_docs.count()
    assert {r.component_id for r in out if r.doc_id == 7} == {7}
    assert {r.class_id for r in out if r.doc_id in (3, 5)} == {3}  # empty texts are equal
    assert sp.similar(spark, sp.fingerprints(spark, no_docs)).count() == 0
    nulls = spark.createDataFrame([(1, None), (2, None)], "doc_id long, fingerprint string").withColumn("key", sp.F.lit(1))
    assert {tuple(r) for r in sp.similar(spark, nulls).collect()} == {(1, 1, 1), (2, 2, 2)}


def test_partners_are_in_the_next_length_partition_at_most():
    import numpy as np

    for percent in (50, 75, 90):
        bounds = sp.length_bounds(percent, 5000)
        for n in range(1, 2000):
            largest = n * 100 // percent
            own, far = np.searchsorted(bounds, [n, largest], side="right")
            assert far - own <= 1


def test_parity_bits_never_exceed_the_difference():
    import numpy as np

    rng = np.random.default_rng(1)
    for _ in range(200):
        a = np.unique(rng.integers(0, 500, rng.integers(1, 300))).astype(np.uint32)
        b = np.unique(rng.integers(0, 500, rng.integers(1, 300))).astype(np.uint32)
        x, y = (np.frombuffer(sp.parity("s", v), np.uint64) for v in (a, b))
        assert np.bitwise_count(x ^ y).sum() <= len(np.setxor1d(a, b))
