from __future__ import annotations

import random
from collections import Counter

import numpy as np

from candlewick.llm import neardup
from candlewick.llm.queries import op7
from tests.conftest import SF001


def _sets(texts):
    out = []
    for t in texts:
        ws = (t or "").encode().lower().split()
        k = min(5, len(ws))
        out.append({tuple(ws[i : i + k]) for i in range(len(ws) - k + 1)} if ws else set())
    return out


def _brute(docs):
    """{(doc_id, size, component)} with counts, over all pairs that share a shingle."""
    sets = _sets([t for _, t in docs])
    up = list(range(len(docs)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    holders: dict = {}
    for i, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(i)
    pairs = {(i, j) for h in holders.values() for i in h for j in h if i < j}
    for i, j in pairs:
        both = len(sets[i] & sets[j])
        if 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
            up[top(i)] = top(j)
    low: dict = {}
    for i, (d, _) in enumerate(docs):
        low[top(i)] = min((x for x in (low.get(top(i)), d) if x is not None), default=None)
    return Counter((d, len(sets[i]), low[top(i)]) for i, (d, _) in enumerate(docs))


def _got(rows):
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)
    return Counter((r.doc_id, r.n_shingles, r.component_id) for r in rows)


def test_op7_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    assert _got(op7(spark, SF001).collect()) == _brute(docs)


def test_groups_of_near_copies_and_shared_passages(spark):
    """Near copies about the threshold, chains, and many documents with one passage."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(4))
    base = [word() for _ in range(200)]
    docs = []
    for _ in range(120):
        ws = list(base)
        for i in rng.sample(range(200), rng.randint(0, 8)):
            ws[i] = word()
        docs.append(" ".join(ws))
    chain = [word() for _ in range(150)]
    for i in range(12):
        chain[i * 10 : i * 10 + 3] = [word() for _ in range(3)]
        docs.append(" ".join(chain))
    passage = [word() for _ in range(60)]
    docs += [" ".join(passage + [word() for _ in range(rng.randint(5, 90))]) for _ in range(120)]
    docs += ["a b", "A  b", "a b c", "a b c d e", "a b c d e f", ""]
    rng.shuffle(docs)
    rows = list(enumerate(docs, 100))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for rounds in (0, 3):
        got = neardup.components(spark, df, rounds).collect()
        assert _got(got) == _brute(rows)
        assert sum(r.first for r in got) == len({r.component_id for r in got})


def test_odd_rows(spark, odd_docs, no_docs):
    rows = neardup.components(spark, odd_docs).collect()
    want = _brute([(r.doc_id, r.text) for r in odd_docs.collect()])
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in rows) == want
    assert neardup.components(spark, no_docs).count() == 0


def test_odd_sketches_are_precise_where_similarity_is_high():
    rng = np.random.default_rng(0)
    for share in (0.75, 0.9, 0.97):
        off = []
        for _ in range(60):
            n = 400
            common = rng.integers(0, 1 << 62, int(n * share), dtype=np.uint64)
            rest = rng.integers(0, 1 << 62, 2 * (n - len(common)) // 2, dtype=np.uint64)
            half = len(rest) // 2
            a, b = np.append(common, rest[:half]), np.append(common, rest[half:])
            true = len(common) / (len(common) + len(rest))
            s = neardup.odd_sketches(neardup.minhashes([np.unique(a), np.unique(b)]))
            off.append(float(neardup.estimates(s[0], s[1])) - true)
        assert abs(np.mean(off)) < 0.03 and np.std(off) < 0.08


def test_only_the_result_stays_staged(spark, odd_docs):
    from candlewick import session

    folder = f"{session.ensure_checkpoint_dir(spark)}/staged"
    before = session.list_names(spark, folder)
    result = neardup.components(spark, odd_docs)
    left = set(session.list_names(spark, folder)) - set(before)
    assert len(left) == 1 and result.count() == odd_docs.count()
    kept = neardup.keep_one(spark, odd_docs.selectExpr("*", "1 AS __key", "2 AS __rank"))
    assert kept.columns[-2:] == ["__key", "__rank"] and kept.select("__key").distinct().count() == 1
    session.drop_lasting(spark)
    assert set(session.list_names(spark, folder)) <= set(before)
