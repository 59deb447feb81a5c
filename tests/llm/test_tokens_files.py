"""Token encoder, grammar files, packing: against the library used directly."""

from __future__ import annotations

import tempfile
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from candlewick.llm import packing, repair
from candlewick.llm.queries import op1, op2
from candlewick.llm.tokens import TextEncoder
from tests.conftest import SF001


@pytest.fixture(scope="module")
def enc(tokenizer_path):
    return TextEncoder(tokenizer_path, max_words=50)


@settings(max_examples=60, deadline=None)
@given(texts=st.lists(st.text(max_size=60), max_size=4))
def test_words_one_by_one_give_the_librarys_ids(tokenizer_path, texts):
    enc = _cached(tokenizer_path)
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    assert enc.encode(texts) == enc.direct(texts)


_held: dict = {}


def _cached(path):
    return _held.setdefault(path, TextEncoder(path, max_words=50))


def test_a_task_keeps_its_own_table_and_drops_the_others(tokenizer_path, monkeypatch):
    from candlewick.llm import common, tokens

    gone = []
    monkeypatch.setattr(common, "KEPT_TABLES", [tokens.encoder.cache_clear, lambda: gone.append(1)])
    mine = tokens.encoder(tokenizer_path)
    common.release(tokens.encoder.cache_clear)
    assert gone == [1] and tokens.encoder(tokenizer_path) is mine
    common.release()
    assert gone == [1, 1] and tokens.encoder(tokenizer_path) is not mine
    assert mine.max_words <= 500_000  # an executor's workers share its memory with the JVM


def _expected(enc, docs, end_id):
    rows = docs.select("doc_id", "text").collect()
    return [(r.doc_id, enc.direct([r.text or ""])[0] + end_id.to_bytes(4, "little")) for r in rows]


@settings(max_examples=40, deadline=None)
@given(ids=st.lists(st.integers(0, 5), max_size=300), cut=st.integers(0, 300))
def test_grammar_round_trip_and_random_access(ids, cut):
    cut = min(cut, len(ids))
    data = repair.write_block(np.array(ids, "<u4"), np.array([cut, len(ids) - cut]), 6, least=2, per_round=3)
    block = repair.Block(data)
    assert block.all().tolist() == ids
    assert block.document(0).tolist() == ids[:cut] and block.document(1).tolist() == ids[cut:]
    assert all((pair < 6 + i).all() for i, pair in enumerate(block.rules))


def test_grammar_shortens_repeats():
    seq, rules = repair.grammar(np.array([1, 2, 3, 4] * 500), 10)
    assert len(seq) < 100 and len(rules)


def test_token_file_equals_direct_encoding(spark, enc, odd_docs, tokenizer_path):
    path = tempfile.mkdtemp(prefix="candlewick-test-") + "/file"
    repair.write(spark, odd_docs, path, tokenizer_path, end_id=1, block_tokens=100, shards=3)
    rows = repair.read(spark, path).orderBy("start").collect()
    assert [r.doc_id for r in rows] == sorted((r.doc_id for r in rows), key=lambda i: (i is not None, i))
    at = 0
    for r in rows:
        assert (r.start, r.n_tokens) == (at, len(r.ids) // 4)
        at += r.n_tokens
    assert Counter((r.doc_id, bytes(r.ids)) for r in rows) == Counter(_expected(enc, odd_docs, 1))


def test_token_file_of_no_rows(spark, no_docs, tokenizer_path):
    path = tempfile.mkdtemp(prefix="candlewick-test-") + "/file"
    repair.write(spark, no_docs, path, tokenizer_path)
    assert repair.read(spark, path).count() == 0


def test_op1_over_the_table(spark, enc):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    want, at = {}, 0
    for key, raw in sorted(_expected(enc, docs, 1)):
        want[key] = (at, len(raw) // 4, zlib.crc32(raw))
        at += len(raw) // 4
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in op1(spark, SF001).collect()}
    assert got == want


def _check_packing(rows, capacity):
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_packing_odd_rows(spark, enc, odd_docs, no_docs, tokenizer_path):
    rows = packing.pack_documents(spark, odd_docs, tokenizer_path, capacity=64).collect()
    _check_packing(rows, 64)
    want = Counter()
    for key, raw in _expected(enc, odd_docs, 0):
        for i in range(0, len(raw), 256):
            want[key, i // 256, i // 4, len(raw[i : i + 256]) // 4, zlib.crc32(raw[i : i + 256])] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    assert packing.pack_documents(spark, no_docs, tokenizer_path).count() == 0


def test_op2_near_the_lower_bound(spark):
    rows = op2(spark, SF001).collect()
    n = _check_packing(rows, 2048)
    bound = -(-sum(r.length for r in rows) // 2048)
    assert n <= bound * 1.01 + 1


@settings(max_examples=30, deadline=None)
@given(hist=st.dictionaries(st.integers(1, 40), st.integers(1, 400), max_size=25))
def test_plan_covers_the_histogram(hist):
    used = Counter()
    for content, n in packing.plan(hist, 40):
        assert sum(s * a for s, a in content) <= 40
        for s, a in content:
            used[s] += a * n
    assert used == Counter(hist)


def _sequences(plan):
    return sum(n for _, n in plan)


@settings(max_examples=40, deadline=None)
@given(hist=st.dictionaries(st.integers(1, 60), st.integers(1, 30), max_size=20))
def test_plan_is_never_worse_than_best_fit(hist):
    assert _sequences(packing.plan(hist, 60)) <= _sequences(packing.best_fit(hist, 60))


def test_the_program_runs_at_every_size(monkeypatch):
    """A few pieces are enough, and where best fit wastes room, it saves sequences."""
    rng = np.random.default_rng(1)
    for n in (12, 500, 60_000):
        lengths = np.clip(np.exp(rng.normal(5.5, 1, n)).astype(int), 1, 2047)
        hist = dict(zip(*(x.tolist() for x in np.unique(lengths, return_counts=True))))
        seen = []
        real = packing.configuration_lp
        with monkeypatch.context() as m:
            m.setattr(packing, "configuration_lp", lambda *a: seen.append(1) or real(*a))
            total = _sequences(packing.plan(hist, 2048))
        assert seen and total <= min(_sequences(packing.best_fit(hist, 2048)), -(-int(lengths.sum()) // 2048) * 1.002 + 1)
    # 50 sequences could be filled to the last token
    hist = {44: 30, 30: 30, 26: 30, 51: 20, 27: 20, 22: 20}
    assert 50 <= _sequences(packing.plan(hist, 100)) <= 51 < _sequences(packing.best_fit(hist, 100))
