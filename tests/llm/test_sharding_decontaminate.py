from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as E
from candlewick.llm import decontaminate as dec
from candlewick.llm import sharding
from candlewick.llm.queries import op5, op8
from tests.conftest import SF001


def _check_shards(rows, docs):
    want = Counter()
    for r in docs:
        raw = (r.text or "").encode()
        want[r.doc_id, len(raw) + 1, zlib.crc32(raw)] += 1
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == want
    groups, slots = defaultdict(set), defaultdict(list)
    for r in rows:
        groups[r.size, r.text_crc32].add(r.shard)
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return groups


def test_op5_sizes_are_near_equal_and_groups_whole(spark):
    rows = op5(spark, SF001).collect()
    groups = _check_shards(rows, spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect())
    assert all(len(s) == 1 for s in groups.values())
    load = Counter()
    for r in rows:
        load[r.shard] += r.size
    assert len(load) == 8 and max(load.values()) <= 1.02 * min(load.values())


def test_shards_of_odd_rows(spark, odd_docs, no_docs):
    _check_shards(sharding.shard(spark, odd_docs, 3).collect(), odd_docs.select("doc_id", "text").collect())
    assert sharding.shard(spark, no_docs, 3).count() == 0
    assert sharding.shard(spark, odd_docs, capacity=1000).count() == odd_docs.count()


def test_a_capacity_is_never_exceeded(spark):
    # 65536 to 65539 bytes are one size class; by their mean, four would fit
    sizes = [65536, 65536, 65536, 65536, 65539, 65539, 65539, 65539]
    docs = spark.createDataFrame([(i, chr(97 + i) * (n - 1)) for i, n in enumerate(sizes)], "doc_id long, text string")
    capacity, load = 4 * 65536 + 7, Counter()
    for r in sharding.shard(spark, docs, capacity=capacity).collect():
        load[r.shard] += r.size
    assert max(load.values()) <= capacity


def test_a_group_above_the_mean_gets_its_own_shard():
    runs = sharding.balance([(90, 90.0, 1), (10, 10.0, 8), (5, 5.0, 4)], 4)
    load = Counter()
    for cls, _, n, b in runs:
        load[b] += cls * n
    assert load[0] == 90 and sorted(load[b] for b in (1, 2, 3))[0] >= 30


@settings(max_examples=50, deadline=None)
@given(sizes=st.lists(st.integers(1, 50), min_size=1, max_size=60))
def test_best_fit_decreasing_is_the_item_by_item_rule(sizes):
    runs, opened = sharding.best_fit_decreasing([(s, float(s), n) for s, n in sorted(Counter(sizes).items(), reverse=True)], 50)
    left: list[int] = []
    for s in sorted(sizes, reverse=True):
        fits = [i for i, r in enumerate(left) if r >= s]
        if fits:
            left[min(fits, key=lambda i: left[i])] -= s
        else:
            left.append(50 - s)
    load = Counter()
    for cls, _, n, b in runs:
        load[b] += cls * n
    assert opened == len(left) and max(load.values()) <= 50
    assert Counter(load.values()) == Counter(50 - r for r in left)


def _brute(docs, items, n=10):
    def words(t):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)

    wins = defaultdict(set)
    for i, t in items:
        ws = words(t)
        k = min(n, len(ws))
        for a in range(len(ws) - k + 1 if k else 0):
            wins[tuple(ws[a : a + k])].add(i)
    out = []
    for i, t in docs:
        ws, hit, ids = words(t), set(), set()
        for k in {len(w) for w in wins}:
            for a in range(len(ws) - k + 1):
                found = wins.get(tuple(ws[a : a + k]))
                if found:
                    hit.update(range(a, a + k))
                    ids |= found
        out.append((i, len(ws), len(hit), len(ids)))
    return Counter(out)


def test_hits_equal_brute_force(spark, odd_docs, no_docs):
    items = [(1, "cat SAT on"), (2, "here 123"), (3, None), (4, "--"), (5, "où la ñ"), (None, "long words here long"),
             (2, "here 123"), (6, "words here long")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = _brute([(r.doc_id, r.text) for r in odd_docs.collect()], items, 4)
    # one automaton, several in one pass, several passes
    for bounds in ({}, {"max_windows": 2}, {"max_windows": 1, "a_pass": 2}):
        hits = dec.find_hits(spark, odd_docs, bench, 4, **bounds)
        got = Counter((r.doc_id, r.n_words, r.n_hit, r.n_items) for r in dec.report(hits).collect())
        # a null id is an item, but not part of the list of ids
        assert {k[:3] for k in got} == {k[:3] for k in want}
        assert sum(got.values()) == sum(want.values())
    assert dec.report(dec.find_hits(spark, no_docs, bench)).count() == 0
    assert not any(r.contaminated for r in dec.report(dec.find_hits(spark, odd_docs, bench.limit(0))).collect())


def test_offsets_point_into_the_original():
    of = lambda text: [dec.Windows([(b" ".join(dec.words(text)), [1])])]
    found = of("Été OÙ la")
    text = "¡¡ x: été...où -- LA fin"
    n, hits = dec.scan(found, text)
    assert (n, hits) == (6, [])  # only A-Z are lowered, so É and Ù stay apart from é and ù
    ((_, first, k, a, b),) = dec.scan(of("été où la"), text)[1]
    assert (first, k, text[a:b]) == (2, 3, "été...où -- LA")


def test_many_windows_stay_small():
    """100,000 windows of different words, in a process of its own: the automaton takes
    tens of megabytes, where one of characters took some 400 for 1 MB of text."""
    import subprocess
    import sys

    code = """
import resource, random
from candlewick.llm.decontaminate import Windows, scan
ws = [b"%x" % random.getrandbits(24) for _ in range(100_009)]
lines = [(b" ".join(ws[i : i + 10]), [i]) for i in range(100_000)]
size = lambda: resource.getrusage(resource.RUSAGE_SELF).ru_maxrss / 1024
before = size()
found = Windows(lines)
grown = size() - before
n, hits = scan([found], b" ".join(ws[500:530]).decode())
assert n == 30 and len(hits) >= 21, len(hits)
print(grown)
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, timeout=120)
    assert float(out.stdout) < 200


def test_op8_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    rows = op8(spark, SF001).collect()
    assert Counter((r.doc_id, r.n_words, r.n_hit, r.n_items) for r in rows) == _brute(docs, items)
    assert any(r.contaminated for r in rows) and "op8_decontamination" in E.oracle_sql()
