"""Line dedup: filters, the index against brute force under inserts and deletes."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from candlewick import session
from candlewick.llm.lines import CuckooFilter, LineIndex, line_key
from candlewick.llm.queries import op11
from tests.conftest import SF001

SCHEMA = "doc_id long, text string"


def test_filters_never_undercount():
    rng = np.random.default_rng(0)
    hashes = rng.integers(0, 2**63, 20_000).astype(np.uint64)
    copies = rng.integers(1, 5, len(hashes))
    f = CuckooFilter.sized(int(copies.sum()))
    f.insert(np.repeat(hashes, copies))
    assert (f.count(hashes) >= copies).all() and (f.count(hashes) > copies).mean() < 0.001
    more = rng.integers(0, 2**63, 60_000).astype(np.uint64)
    assert (f.count(more) > 0).mean() < 0.001
    f.insert(more)  # beyond its size: further segments
    assert len(f.segments) > 1 and (f.count(more) > 0).all() and (f.count(hashes) >= copies).all()
    f.delete(np.repeat(hashes[::2], copies[::2]))
    assert (f.count(hashes[1::2]) >= copies[1::2]).all() and (f.count(more) > 0).all()
    assert (f.count(hashes[::2]) > 0).mean() < 0.001
    f.delete(more)
    f.delete(np.repeat(hashes[1::2], copies[1::2]))
    assert sum(np.count_nonzero(t) for t in f.segments) == 0
    with pytest.raises(ValueError):
        f.delete(hashes[:1])


def test_look_alikes_survive_each_others_deletion():
    """Few fingerprints and buckets, so that many keys look alike in some segment."""
    rng = np.random.default_rng(1)
    f = CuckooFilter.sized(8)
    held: list[int] = []
    for step in range(300):
        if held and rng.random() < 0.45:
            gone = [held.pop(rng.integers(len(held))) for _ in range(min(len(held), 3))]
            f.delete(np.array(gone, np.uint64))
        else:
            new = [int(x) * 65535 + int(rng.integers(0, 3)) for x in rng.integers(0, 2**20, 5)]
            held += new
            f.insert(np.array(new, np.uint64))
        if held:
            assert (f.count(np.array(held, np.uint64)) > 0).all()
    f.delete(np.array(held, np.uint64))
    assert sum(np.count_nonzero(t) for t in f.segments) == 0


def _key(line: str) -> str | None:
    bare = line.strip(" \t\n\x0b\x0c\r")
    bare = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in bare)
    return bare if len(bare) >= 20 else None


def _brute(docs):
    """(doc_id, n_lines, n_dropped, kept) of (doc_id, text) rows."""
    rank = lambda i: (i is not None, i or 0)
    held: dict[str, set] = {}
    for i, text in docs:
        for line in (text or "").split("\n"):
            if (k := _key(line)) is not None:
                held.setdefault(k, set()).add(i)
    out = []
    for i, text in docs:
        lines = (text or "").split("\n")
        keep = [x for x in lines if (k := _key(x)) is None or len(held[k]) < 3 or i == max(held[k], key=rank)]
        out.append((i, len(lines), len(lines) - len(keep), "\n".join(keep)))
    return sorted(out, key=str)


def _rows(index, docs, spark):
    df = spark.createDataFrame(docs, SCHEMA)
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in index.apply(df).collect()), key=str)


def test_inserts_and_deletes_equal_an_index_of_what_is_left(spark, tmp_root):
    rng = random.Random(4)
    lines = [f"a line that repeats, number {i}" for i in range(12)] + ["short", "", "  A Line That Repeats, Number 1 "]
    make = lambda i: (i, "\n".join(rng.choice(lines) for _ in range(rng.randint(0, 6))) + f"\nonly in document number {i}")
    index = LineIndex(spark, f"{tmp_root}/index", shards=4)
    state = {i: make(i) for i in range(12)}
    index.insert(spark.createDataFrame(list(state.values()), SCHEMA))
    assert _rows(index, list(state.values()), spark) == _brute(list(state.values()))
    for step in range(3):
        batch = [make(i) for i in range(10 + 5 * step, 17 + 5 * step)]  # known ids among them
        state |= {i: (i, t) for i, t in batch}
        index.insert(spark.createDataFrame(batch, SCHEMA))
        gone = rng.sample(sorted(state), 4)
        for i in gone:
            del state[i]
        index.delete(spark.createDataFrame([(i,) for i in [*gone, 999]], "id long"))
    docs = list(state.values())
    assert _rows(index, docs, spark) == _brute(docs)
    # filters hold what the exact table says, a key at most `least` times
    counts = {r.key: r.n for r in index.references().groupBy("key").agg({"doc": "count"}).toDF("key", "n").collect()}
    held = sum(int(np.count_nonzero(np.frombuffer(s, "<u2"))) for r in index.filters.read().collect() for s in r.segments)
    assert held == sum(min(n, 3) for n in counts.values())
    index.compact()
    assert len(index.refs.commit().parts) == 1 and _rows(index, docs, spark) == _brute(docs)
    # everything away: nothing repeats
    index.delete(spark.createDataFrame([(i,) for i in state], "id long"))
    assert index.references().count() == 0 and index.drops().count() == 0


def test_an_interrupted_run_is_made_good(spark, tmp_root, monkeypatch):
    docs = [(i, "the very same line in all of them\nand another one that is the same") for i in range(5)]
    index = LineIndex(spark, f"{tmp_root}/index", shards=2)
    index.insert(spark.createDataFrame(docs[:2], SCHEMA))
    with monkeypatch.context() as m:
        m.setattr(LineIndex, "_store", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            index.insert(spark.createDataFrame(docs[2:], SCHEMA))
    again = LineIndex(spark, f"{tmp_root}/index")
    assert _rows(again, docs, spark) == _brute(docs)


def test_op11_odd_rows(spark, odd_docs, no_docs, tmp_root):
    same = "This line stands in many documents."
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    rows += [(20 + i, f"{same}\n\t{same.upper()}  \r\nx{i}") for i in range(4)] + [(None, same), (None, None)]
    rows += [(40, "\n".join(f"line {i} of one very long document" for i in range(5000))), (41, "été " * 5 + "\n" + "é" * 19),
             (42, "été " * 5), (43, "ÉTÉ " * 5), (44, " été été été été été")]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS n_lines", "'k' AS kept", "'z' AS key", "2 AS doc", "3 AS shard")
    df.write.parquet(f"{tmp_root}/documents.parquet")
    got = sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in op11(spark, tmp_root).collect()), key=str)
    want = [(i, n, d, hashlib.sha256(kept.encode()).hexdigest()) for i, n, d, kept in _brute(rows)]
    assert got == sorted(want, key=str)
    index = LineIndex(spark, f"{tmp_root}/empty")
    index.delete(spark.createDataFrame([(1,)], "id long"))
    index.insert(no_docs)
    assert index.apply(no_docs).count() == 0
    index.insert(spark.createDataFrame([(1, same)], SCHEMA))
    assert index.references().count() == 1


def test_staged_folders_of_the_index_are_dropped(spark, tmp_root):
    folder = f"{session.ensure_checkpoint_dir(spark)}/staged"
    before = session.list_names(spark, folder)
    index = LineIndex(spark, f"{tmp_root}/index")
    for _ in range(2):
        index.insert(spark.read.parquet(f"{SF001}/documents.parquet"))
    assert session.list_names(spark, folder) == before


def test_line_keys():
    assert line_key(b"  Twenty Code Points!!\t\r", 20) == hashlib.md5(b"twenty code points!!").digest()
    assert line_key("é".encode() * 19, 20) is None and line_key("É".encode() * 20, 20) == hashlib.md5("É".encode() * 20).digest()
