"""Operators that learn: held-out accuracy, exact counts, normalisation."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest
import xxhash

from candlewick.llm import langid, lm, toxicity
from candlewick.llm.queries import op3, op6, op9
from tests.conftest import SF01, SF001
from tests.llm.conftest import crc_mod


def _phi(w):
    """Weights of a word's triples, by loops."""
    x = toxicity.LETTERS[[ord(c) for c in toxicity.EDGE + w + toxicity.EDGE]].tolist()
    out = Counter()
    for i in range(len(x)):
        for j in range(i + 1, min(i + 2 + toxicity.GAP, len(x))):
            for k in range(j + 1, min(j + 2 + toxicity.GAP, len(x))):
                if x[i] and x[j] and x[k]:
                    out[x[i], x[j], x[k]] += toxicity.DECAY ** (j - i - 1 + k - j - 1)
    return out


def _words(text):
    return (text or "").encode().lower().split()


def test_op3_counts_and_base_score(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    counts = Counter()
    for d, t in docs:
        if crc_mod(d, 5) != 1:
            counts.update([*_words(t), b""])
    n, v = sum(counts.values()), len(counts)
    rows = {r.doc_id: r for r in op3(spark, SF001).collect()}
    assert len(rows) == len(docs)
    for d, t in docs:
        r, ws = rows[d], [*_words(t), b""]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (crc_mod(d, 5) == 1, len(ws), n)
        assert r.n_known == sum(counts[w] > 0 for w in ws)
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws)
        assert abs(r.base_score - base) < 1e-6 * max(1, abs(base))
    held = [r for r in rows.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_the_model_is_normalised_and_learns():
    rng = np.random.default_rng(0)
    cells = np.unique(rng.integers(0, lm.CLASSES**3, 500))
    table = np.exp(lm.fit(cells, np.ones(len(cells)), steps=50))
    assert np.allclose(table.sum(1), 1)
    # a class that always follows two others
    cell = lm.trigrams(np.array([3, 5, 9] * 50))
    cells, n = np.unique(cell, return_counts=True)
    table = np.exp(lm.fit(cells, n.astype(float), steps=400))
    assert table[3 * lm.CLASSES + 5, 9] > 0.8
    assert np.allclose(np.exp(lm.fit(np.empty(0, np.int64), np.empty(0))).sum(1), 1)


def test_the_fit_counts_every_trigram():
    """The probabilities of contexts that are one in 100,000 are learnt as well: no draw
    of so many trigrams would meet them often enough."""
    rng, k = np.random.default_rng(1), 6
    want = rng.normal(0, 1, (k, 1, k)) + rng.normal(0, 1, (1, k, k))
    want -= np.log(np.exp(want).sum(2, keepdims=True))
    contexts = np.ones((k, k, 1))
    contexts[-1] = 1e-5
    i, j, to = np.indices((k, k, k)).reshape(3, -1)
    context = i * lm.CLASSES + j
    table = lm.fit(context * lm.CLASSES + to, (1e9 * contexts * np.exp(want)).reshape(-1))
    off = np.abs(table[context, to].reshape(k, k, k) - want)
    assert off[:-1].max() < 0.4 and off[-1].max() < 0.5


def _naive_model(training):
    """P(word | two words before) by plain loops over the training texts."""
    counts = Counter(w for t in training for w in [*_words(t), b""])
    signed = {w: h - (1 << 64) if h >> 63 else h for w in counts for h in [xxhash.xxh3_64_intdigest(w)]}
    top = sorted((w for w in counts if w), key=lambda w: (-counts[w], signed[w]))[: lm.TOP]
    # single words are numbered by their place among the most frequent
    ranks = {w: i + 1 for i, w in enumerate(top)}

    def kind(w):
        if not w:
            return 0
        if w in ranks:
            return ranks[w]
        return 1 + lm.TOP + (w[-1] * 53 + (w[-2] if len(w) > 1 else 0) * 11) % lm.SUFFIXES

    cells = Counter()
    for t in training:
        before = (0, 0)
        for k in map(kind, [*_words(t), b""]):
            cells[(before[0] * lm.CLASSES + before[1]) * lm.CLASSES + k] += 1
            before = (before[1], k)
    at = sorted(cells)
    table = np.exp(lm.fit(np.array(at), np.array([cells[c] for c in at], float)))
    shares = Counter()
    for w, c in counts.items():
        shares[kind(w)] += c
    n, once = sum(counts.values()), sum(c == 1 for c in counts.values())
    unseen = min(max(once / n, 1 / (n + 1)), 0.5)

    def p(w, before):
        if w not in counts:
            return unseen
        own = counts[w] / shares[kind(w)] if kind(w) > lm.TOP else 1.0
        return (1 - unseen) * table[before[0] * lm.CLASSES + before[1], kind(w)] * own

    return counts, kind, shares, unseen, table, p


def test_op3_score_against_plain_loops(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    counts, kind, shares, unseen, table, p = _naive_model([t for d, t in docs if crc_mod(d, 5) != 1])
    rows = {r.doc_id: r for r in op3(spark, SF001).collect()}
    for d, t in docs:
        before, total = (0, 0), 0.0
        for w in [*_words(t), b""]:
            total += math.log10(p(w, before))
            before = (before[1], kind(w))
        assert abs(rows[d].score - total) < 1e-4 * max(1, abs(total)), d
    # after any words, all known words, the end and what is unseen share one,
    # but for what the smoothing leaves to classes without a word
    empty = [k for k in range(lm.CLASSES) if not shares[k]]
    rng = np.random.default_rng(3)
    for before in rng.integers(0, lm.CLASSES, (20, 2)):
        spare = (1 - unseen) * table[before[0] * lm.CLASSES + before[1], empty].sum()
        assert abs(sum(p(w, before) for w in counts) + unseen + spare - 1) < 1e-9
        assert spare < 0.02


def test_op3_odd_rows(spark, odd_docs, no_docs):
    rows = lm.score(spark, odd_docs.selectExpr("*", "doc_id > 8 AS held_out").fillna({"held_out": False})).collect()
    assert len(rows) == odd_docs.count()
    assert all(r.n_tokens == 1 for r in rows if r.doc_id in (3, 5, 6))
    assert all(math.isfinite(r.score) and math.isfinite(r.base_score) for r in rows)
    assert lm.score(spark, no_docs.selectExpr("*", "false AS held_out")).count() == 0
    assert lm.score(spark, odd_docs.selectExpr("*", "true AS held_out")).filter("n_known > 0").count() == 0


def test_op6_held_out_accuracy(spark):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()}
    rows = op6(spark, SF01).collect()
    assert len(rows) == len(lang)
    held = [r for r in rows if r.held_out and r.lang_pred != "und"]
    assert all(r.held_out == (crc_mod(r.doc_id, 3) == 1) and 0 <= r.score <= 1 for r in rows)
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.95


def test_texts_of_other_languages_and_gibberish_are_rejected(spark):
    rows = spark.read.parquet(f"{SF01}/documents.parquet").filter("lang IS NOT NULL AND text IS NOT NULL").collect()
    rows = [r for r in rows if any(map(str.isalpha, r.text)) and len(r.text.encode()) <= 20_000]
    foreign = [
        "Kuningas istui vaihtelevassa metsässä ja katseli järvelle hiljaisena iltana kunnes aurinko laski",
        "Wszyscy ludzie rodza sie wolni i rowni pod wzgledem swej godnosci i swych praw",
        "Butun insanlar hur haysiyet ve haklar bakimindan esit dogarlar",
        "Всички хора се раждат свободни и равни по достойнство и права",
    ]
    rng = np.random.default_rng(4)
    letters = list("abcdefghijklmnopqrstuvwxyz")
    gibberish = [" ".join("".join(rng.choice(letters, rng.integers(3, 10))) for _ in range(50)) for _ in range(20)]
    for langs in ({"en"}, {"de", "fr"}, {"de", "en", "es", "fr"}):
        some = [r for r in rows if r.lang in langs]
        model = langid.train([(r.text, r.lang) for r in some if crc_mod(r.doc_id, 3) != 1])
        accepted = lambda texts: [a for _, _, a in langid.predict(model, texts)]
        assert not any(accepted(foreign + gibberish))
        assert np.mean(accepted([r.text for r in some if crc_mod(r.doc_id, 3) == 1])) > 0.96


def test_language_of_odd_rows(spark, odd_docs, no_docs):
    model = langid.train([("the cat and the dog", "en")] * 5 + [("der hund und die katze", "de")] * 5)
    rows = langid.identify(spark, odd_docs, model).collect()
    assert len(rows) == odd_docs.count()
    assert all((r.lang_pred, r.score, r.accepted) == ("und", 0.0, False) for r in rows if r.doc_id in (3, 5, 6, 13))
    assert {r.lang_pred for r in rows if r.doc_id == 7} == {"en"}
    assert langid.identify(spark, no_docs, model).count() == 0
    empty = langid.fit(spark, no_docs)
    assert {r.lang_pred for r in langid.identify(spark, odd_docs, empty).collect()} == {"und"}


def test_a_text_is_scored_alike_in_any_batch():
    model = langid.train([("the cat and the dog", "en")] * 5 + [("der hund und die katze", "de")] * 5)
    texts = ["the dog", "die katze", "x", "und der"]
    assert langid.predict(model, texts) == [langid.predict(model, [t])[0] for t in texts]


def test_op9_held_out_accuracy_in_every_language(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    docs = {r.doc_id: (r.lang, r.text.lower()) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op9(spark, sf).collect()
    assert len(rows) == len(docs)
    assert all(r.held_out == (crc_mod(r.doc_id, 5) == 0) and 0 <= r.score <= 1 for r in rows)
    assert all(r.predicted == (r.score >= 0.5) for r in rows)
    held = [(r, *docs[r.doc_id], labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    toxic = [(r.predicted, lang, text) for r, lang, text, t in held if t]
    assert np.mean([p for p, *_ in toxic]) > 0.9
    assert np.mean([r.predicted for r, _, _, t in held if not t]) < 0.005
    # 6 of the 97 are repeated or broken lines without a toxic word
    marks = "trash pathetic idiot disgusting worthless stupid clown loser scum moron r\xe9eux achlich bomente".split()
    assert np.mean([p for p, _, text in toxic if any(m in text for m in marks)]) > 0.95
    for lang in ("fr", "de", "es"):
        assert np.mean([p for p, of, _ in toxic if of == lang]) > 0.75


def test_stored_and_local_samples_train_the_same_model(spark):
    sf = spark.read.parquet(f"{SF01}/documents.parquet"), spark.read.parquet(f"{SF01}/labels.parquet")
    stored = toxicity.fit(spark, *sf, landmarks=64, clean_words=2000)
    labels = {r.doc_id: r.toxic for r in sf[1].collect()}
    texts = [(r.text, labels[r.doc_id]) for r in sf[0].orderBy("doc_id").collect() if r.doc_id in labels and len(r.text.encode()) <= 20_000]
    # the stored sample is in the order of ids, which decides which near copy stays
    local = toxicity.train(texts, sum(t for _, t in texts) / len(texts), landmarks=64, clean_words=2000)
    assert len(set(stored.landmarks) & set(local.landmarks)) >= 0.8 * len(local.landmarks) > 0
    words = ["idiot", "i.d.i.o.t", "trash", "the", "eauouon"]
    assert ((stored.decide(words) > 0) == (local.decide(words) > 0)).all()


def test_decision_equals_a_naive_kernel_machine():
    """Every word against every triple's weight by loops, and the group by the naive kernel."""
    rng = np.random.default_rng(0)
    words = ["".join(rng.choice(list("aeioulnrstm"), 6)) for _ in range(200)]
    texts = [(" ".join([*rng.choice(words, 8), w]), 1) for w in ("idiot", "idiots", "moronic", "moron") * 8]
    model = toxicity.train(texts + [(" ".join(rng.choice(words, 12)), 0) for _ in range(80)], landmarks=24)
    assert len(set(model.kind)) >= 2
    phi = [_phi(w.strip(toxicity._OUTER)) for w in model.landmarks]
    for word in ["idiot", "i-d-iot", "idioot", "moronic", *words[:20]]:
        a = _phi(word)
        norm = math.sqrt(sum(v * v for v in a.values()))
        value = sum(v * model.weights[x * 1024 + y * 32 + z] for (x, y, z), v in a.items()) / norm + model.bias
        got = model.decide([word])
        assert abs(got[0] - max(value, toxicity.FLOOR)) < 1e-5
        near = [sum(a[t] * b[t] for t in a) / norm / math.sqrt(sum(v * v for v in b.values())) for b in phi]
        group = model.group([word], got)[0]
        assert group == (model.kind[int(np.argmax(near))] if got[0] > 0 else -1)
    assert (model.decide(["idiot", "i.d.i.o.t", "idioot", "moron"]) > 0).all()


def test_toxicity_of_odd_rows(spark, odd_docs, no_docs):
    rng = np.random.default_rng(0)
    words = ["".join(rng.choice(list("aeioulnrstm"), 5)) for _ in range(400)]
    clean = [(" ".join(rng.choice(words, 12)), 0) for _ in range(80)] + [("the quiet house on the mat and it's fine", 0)]
    model = toxicity.train([(" ".join([*rng.choice(words, 8), "idiot", *rng.choice(words, 3)]), 1) for _ in range(40)] + clean)
    rows = toxicity.rate(spark, odd_docs, model).collect()
    assert len(rows) == odd_docs.count() and not any(r.predicted for r in rows)
    assert toxicity.rate(spark, no_docs, model).count() == 0
    score = toxicity._Scorer(model)
    assert (score(["such an idiot", "i d i o t", "an i.d.i.o.t here"]) > score(["a quiet house"])[0]).all()
    constant = toxicity.fit(spark, no_docs, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert not any(r.predicted for r in toxicity.rate(spark, odd_docs, constant).collect())


@pytest.mark.parametrize("word,landmark", [("idiot", "idiot"), ("i.d.iot", "idiot"), ("house", "idiot"), ("aaaa", "aaa")])
def test_kernel_equals_the_sum_over_subsequences(word, landmark):
    a, b = _phi(word), _phi(landmark)
    norm = math.sqrt(sum(v * v for v in a.values()) * sum(v * v for v in b.values()))
    want = sum(a[t] * b[t] for t in a) / norm if norm else 0.0
    assert abs(toxicity.kernel([word], toxicity._dense([landmark]))[0, 0] - want) < 1e-6
