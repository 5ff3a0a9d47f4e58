"""Word vectors beside a dense decomposition, and words planted in the places of others."""

import random
from collections import Counter

import numpy as np

from quillframe.corpus import skipgram, vectors, weights

KIND = "doc_id long, text string"


def dense(texts, window, shift):
    n = Counter()
    for t in texts:
        w = (t or "").split()
        n.update((w[i], w[j]) for i in range(len(w)) for j in range(max(0, i - window), min(len(w), i + window + 1)) if i != j)
    total, sums = sum(n.values()), Counter()
    for (a, _), c in n.items():
        sums[a] += c
    value = {(a, b): np.log(c * total / (sums[a] * sums[b])) - np.log(shift) for (a, b), c in n.items()}
    return {k: v for k, v in value.items() if v > 0}


def corpus(seed, count=300):
    r = random.Random(seed)
    topics = [[f"t{k}w{i}" for i in range(8)] for k in range(5)]
    names = {"oak": 0, "elm": 0, "tin": 1, "lead": 1, "sun": 2, "moon": 2}
    texts = []
    for _ in range(count):
        k = r.randrange(5)
        words = [r.choice(topics[k]) for _ in range(12)]
        own = [n for n, topic in names.items() if topic == k]
        if own:
            words[r.randrange(2, 10)] = r.choice(own)  # one of two, never both, so they share contexts but do not meet
        texts.append(" ".join(words))
    return texts


def test_pmi_beside_counts(spark):
    texts = [*corpus(1, 60), None, "", "alone", "twice twice"]
    df = spark.createDataFrame(list(enumerate(texts)), KIND).repartition(5)
    got = {(r["word"], r["context"]): r["value"] for r in vectors.shifted_pmi(df, "doc_id", "text", 3, 1, 1.5).collect()}
    want = dense(texts, 3, 1.5)
    assert got.keys() == want.keys() and all(abs(got[k] - v) < 1e-9 for k, v in want.items())


def test_vectors_beside_dense_decomposition(spark):
    texts = corpus(2)
    df = spark.createDataFrame(list(enumerate(texts)), KIND).repartition(7)
    value = dense(texts, 3, 1.0)
    words = sorted({a for a, _ in value})
    m = np.zeros((len(words), len(words)))
    for (a, b), v in value.items():
        m[words.index(a), words.index(b)] = v
    found = {r["word"]: r["vector"] for r in vectors.pmi_vectors(df, "doc_id", "text", size=4, window=3, rounds=12, seed=3).collect()}
    assert sorted(found) == words and {len(v) for v in found.values()} == {4}
    x = np.array([found[w] for w in words])
    values = np.linalg.eigvalsh(m)
    leading = values[np.argsort(-np.abs(values))[:4]]
    assert np.allclose(np.sort(np.linalg.norm(x, axis=0) ** 2), np.sort(np.abs(leading)), rtol=1e-3)
    assert np.allclose(x.T @ x, np.diag(np.diag(x.T @ x)), atol=1e-6 * np.abs(leading).max())


def test_planted_words_are_neighbours(spark):
    df = spark.createDataFrame(list(enumerate(corpus(4, 600))), KIND)
    found = {r["word"]: np.array(r["vector"]) for r in vectors.pmi_vectors(df, "doc_id", "text", size=6, window=4, seed=5).collect()}
    unit = {w: v / np.linalg.norm(v) for w, v in found.items()}
    for a, b in (("oak", "elm"), ("tin", "lead"), ("sun", "moon")):
        assert unit[a] @ unit[b] > 0.9
        assert all(unit[a] @ unit[b] > unit[a] @ unit[c] for c in ("oak", "elm", "tin", "lead", "sun", "moon") if c not in (a, b))


def test_nothing_to_learn(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "alone")], KIND)
    assert vectors.pmi_vectors(df, "doc_id", "text", size=3, window=2).collect() == []
    assert vectors.pmi_vectors(df.limit(0), "doc_id", "text", size=3, window=2).collect() == []


def test_skip_gram_vectors_do_not_follow_the_tasks(spark):
    df = spark.createDataFrame([*enumerate(corpus(6, 400)), (-1, None), (-2, "")], KIND)
    some, more = ({r["word"]: r["vector"] for r in weights.word_vectors(df.repartition(n), "text", size=5, window=3, min_count=2, seed=2).collect()} for n in (2, 7))
    assert some.keys() == more.keys() and all(np.allclose(v, more[w], rtol=1e-5, atol=1e-7) for w, v in some.items())


def test_skip_grams_of_planted_words_are_neighbours(spark):
    df = spark.createDataFrame(list(enumerate(corpus(4, 12_000))), KIND).repartition(4)
    found = {r["word"]: np.array(r["vector"]) for r in weights.word_vectors(df, "text", size=6, window=4, seed=5).collect()}
    unit = {w: v / np.linalg.norm(v) for w, v in found.items()}
    for a, b in (("oak", "elm"), ("tin", "lead"), ("sun", "moon")):
        assert unit[a] @ unit[b] > 0.9
        assert all(unit[a] @ unit[b] > unit[a] @ unit[c] for c in ("oak", "elm", "tin", "lead", "sun", "moon") if c not in (a, b))


def test_slices_count_words_together(spark):
    texts = corpus(7, 200) + ["rare words", "alone", "alone", "alone", "common alone", None, "", "same text"] + ["same text"] * 30
    df = spark.createDataFrame(list(enumerate(texts)), KIND).repartition(3)
    cut = skipgram.slices(df, "text", seed=3, slice_words=300)
    counts = skipgram.word_counts(cut)
    n = Counter(w for t in texts for w in (t or "").split())
    assert {r["word"]: r["n"] for r in counts.groupBy("word").sum("n").withColumnRenamed("sum(n)", "n").collect()} == n
    assert counts.select("slice").distinct().count() > 3
    found = {r["word"]: r["vector"] for r in skipgram.learned(cut, counts, 4, 3, 4, seed=3).collect()}
    assert found.keys() == {w for w, k in n.items() if k >= 4} and "alone" in found
    assert all(len(v) == 4 and np.isfinite(v).all() for v in found.values())
    assert skipgram.learned(cut, counts, 4, 3, 10_000).collect() == []


def test_frequent_words_stay_finite():
    rng = np.random.default_rng(1)
    ids = np.where(rng.random(60_000) < 0.6, 0, rng.integers(0, 50, 60_000))
    vectors_ = skipgram.start(np.arange(50), 8)
    skipgram.skip_grams(ids, np.arange(len(ids)) // 200, vectors_, np.bincount(ids), 5, rng)
    assert np.isfinite(vectors_).all() and np.linalg.norm(vectors_, axis=1).max() < 20


def test_no_words_to_learn_from(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "alone")], KIND)
    assert weights.word_vectors(df, "text", size=3, window=2, min_count=2).collect() == []
    assert weights.word_vectors(df.limit(0), "text", size=3, window=2).collect() == []
