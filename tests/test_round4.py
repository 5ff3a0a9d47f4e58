"""Steps that failed at size or after other queries of the same session."""

from pyspark.ml.classification import LinearSVC, LogisticRegression, RandomForestClassifier
from pyspark.sql import functions as F

from quillframe.models import features, fit
from quillframe.plans.quantiles import quantiles


def test_models_score_in_a_session_that_took_quantiles(spark):
    """Binary models hold their session, so nothing may stay in it that can't go to the tasks."""
    df = features.assemble(spark.range(60).select("id", F.col("id").cast("double").alias("x"), (F.col("id") % 3 == 0).cast("double").alias("label")), ["x"])
    assert quantiles(df, [], "x", {"m": 0.5}).first()["m"] == 29.5
    for model in (LogisticRegression().fit(df), RandomForestClassifier(numTrees=2, seed=1).fit(df), LinearSVC(maxIter=2).fit(df)):
        assert len(fit.score(model, df, ["id"]).collect()) == 60


def test_pairs_of_words_are_counted_once_for_both_directions(spark):
    from collections import Counter

    from quillframe.corpus import tokens as tok

    texts = ["a b a a c", "b b", "c", "", None, "a a a a a a a"] * 3
    df = spark.createDataFrame(list(enumerate(texts)), "doc long, text string").repartition(4)
    want = Counter()
    for words in ((x or "").split() for x in texts):
        want.update((words[i], words[j]) for i in range(len(words)) for j in range(len(words)) if 0 < abs(i - j) <= 2)
    got = tok.both_ways(tok.directed(tok.pair_counts(df, "text", 2)), "n").collect()
    assert len(got) == len(want) and {(r["center"], r["context"]): r["n"] for r in got} == want
    sums = {r["word"]: r["n_word"] for r in tok.places(df, "text", 2).collect()}
    assert sums == {w: sum(n for (a, _), n in want.items() if a == w) for w in "abc"}


def test_windows_are_counted_without_a_row_for_each(spark):
    import random

    from quillframe.corpus import tokens as tok

    r = random.Random(3)
    texts = ["".join(r.choice("ab é𝄞") for _ in range(r.randrange(60))) for _ in range(60)] + ["x" * 500, None, "", "y" * 20, "y" * 21] * 3
    df = spark.createDataFrame(list(enumerate(texts)), "doc long, text string").repartition(5)
    windows = tok.char_windows(df, "doc", "text", 20).groupBy("next").agg(F.count("*").alias("n"), F.count_distinct("window").alias("distinct_windows"))
    counted = tok.window_counts(df, "text", 20, chars=300)
    assert sorted(windows.collect()) == sorted(counted.select(*windows.columns).collect())
    # One column apart from the texts' pieces goes through the exchange, not the windows.
    assert "explode" not in counted._jdf.queryExecution().optimizedPlan().toString()


def test_close_vectors_by_products_are_those_by_differences():
    import numpy as np

    from quillframe.operators.neighbours import _closest, _distances

    r = np.random.default_rng(2)
    right = np.vstack([r.normal(size=(300, 7)), np.full((1, 7), 1e9), np.full((1, 7), 1e200), np.full((1, 7), np.nan)])
    right = np.vstack([right, right[:40], right[:40] + 1e-12])
    left = right[:60]
    for k in (1, 3, 500):
        d = _distances(left, right, "l2")
        d[np.arange(60), np.arange(60)] = np.inf
        order = np.argsort(d, axis=1, kind="stable")[:, :k]
        want = [(i, j, d[i, j]) for i in range(60) for j in order[i].tolist() if np.isfinite(d[i, j])]
        row, column, got = _closest(left, right, np.eye(60, len(right), dtype=bool), k, "l2", np.inf)
        assert [(i, j) for i, j, _ in want] == list(zip(row.tolist(), column.tolist())) and np.allclose([x for *_, x in want], got, rtol=1e-12)


def test_buckets_grow_with_the_table(spark):
    from quillframe.sources import sinks

    assert [sinks.buckets_for(spark.range(n), 8, 1000) for n in (0, 8000, 8001, 100_000)] == [8, 8, 9, 100]


def test_padded_texts_are_the_joined_padded_arrays(spark):
    from quillframe.corpus import tokens as tok

    df = spark.createDataFrame([(1, ["a", "b", "c"]), (2, ["a"]), (3, []), (4, None)], "i int, t array<string>")
    want = tok.pad_to_longest(df, "t").select("i", F.array_join("t", " ").alias("p"))
    assert sorted(want.collect()) == sorted(tok.padded_text(df, "t", "p").select("i", "p").collect())
