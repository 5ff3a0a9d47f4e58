"""Near duplicates across splits, the special functions, wrapped lines, sampled contexts and the sweep over k, beside plain versions."""

import hashlib
import math
import pathlib
import random
import re
import textwrap
import time
from collections import Counter
from statistics import NormalDist

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quillframe.corpus import tokens as tok
from quillframe.corpus import weights
from quillframe.functions import arrays, numeric, text
from quillframe.operators import neighbours, overlap
from quillframe.session import scratch_path, shared_dir
from quillframe.streaming import state

PARTS = ["train", "valid", "test"]


def column(spark, values, kind):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}").orderBy("i")


def runs(s):
    w = [x for x in re.split("[^a-z0-9]+", s.lower()) if x]
    return {" ".join(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def counted(rows, close):
    found = Counter()
    for part, value in rows:
        for other in {p for p, v in rows if p not in (part, None) and close(value, v)}:
            if part is not None:
                found[part, other] += 1
    return dict(found)


def as_dict(df):
    return {(r["part"], r["other"]): r["rows"] for r in df.collect()}


def test_near_texts(spark):
    rng = random.Random(4)
    words = [f"w{k}" for k in range(400)]
    rows = []
    for _ in range(30):
        base = [rng.choice(words) for _ in range(rng.choice([3, 5, 12, 60, 200]))]
        for _ in range(rng.choice([1, 2, 4])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 6])):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append((rng.choice(PARTS), rng.choice([" ", ", ", "\n"]).join(copy).title()))
    rows += [("train", "one two"), ("test", "One, two!"), ("test", "one two"), ("valid", ""), ("train", "..."), ("train", None), (None, "one two")]
    df = spark.createDataFrame([(p, t, 1) for p, t in rows], "part string, text string, key int")
    sets = [(p, runs(t or "")) for p, t in rows]
    want = counted(sets, lambda a, b: bool(a) and bool(b) and 5 * len(a & b) >= 4 * len(a | b))
    assert len(want) >= 5 and as_dict(overlap.near_texts(df, "part", "text")) == want
    assert overlap.near_texts(df.limit(0), "part", "text").count() == 0


def test_near_texts_that_the_hub_is_too_far_from(spark):
    """A chain of texts in shared buckets: ends far from the hub still find their own partner."""
    words = [f"x{k}" for k in range(120)]
    rows = [(PARTS[k % 3], " ".join(words[4 * k:4 * k + 60])) for k in range(15)]
    rows += [(PARTS[(k + 1) % 3], " ".join(words[4 * k:4 * k + 58])) for k in range(15)]
    sets = [(p, runs(t)) for p, t in rows]
    want = counted(sets, lambda a, b: 5 * len(a & b) >= 4 * len(a | b))
    assert as_dict(overlap.near_texts(spark.createDataFrame(rows, "part string, text string"), "part", "text")) == want


def test_a_large_family_of_copies_is_compared_once_per_member(spark):
    base = [f"c{k}" for k in range(80)]
    rows = [(PARTS[k % 3], " ".join([*base, f"end{k}"])) for k in range(600)] + [("train", " ".join(base))] * 300
    got = as_dict(overlap.near_texts(spark.createDataFrame(rows, "part string, text string"), "part", "text"))
    sizes = Counter(p for p, _ in rows)
    assert got == {(p, o): sizes[p] for p in PARTS for o in PARTS if p != o}


def test_near_texts_keeps_no_sets_of_texts_without_a_candidate(spark):
    """What is written is a sketch per text and the few sets that share a band; all sets would be larger than the texts."""
    rng = random.Random(8)
    rows = [(PARTS[k % 3], " ".join(f"{rng.randrange(36 ** 4):x}" for _ in range(1500))) for k in range(240)]
    rows += [("test", rows[0][1] + " end"), ("valid", rows[0][1])]
    folder = pathlib.Path(shared_dir(spark)) / "scratch"
    before = set(folder.rglob("*.parquet"))
    got = as_dict(overlap.near_texts(spark.createDataFrame(rows, "part string, text string").repartition(4), "part", "text"))
    assert got == {(p, o): 1 for p in PARTS for o in PARTS if p != o}
    written = sum(f.stat().st_size for f in set(folder.rglob("*.parquet")) - before if f.is_file())
    assert 0 < written < sum(len(t) for _, t in rows) / 4


def test_near_vectors(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(20, 6))
    rows = [(PARTS[rng.integers(3)], list(map(float, (base[k % 20] + rng.normal(size=6) * 0.15) * rng.uniform(0.5, 3)))) for k in range(200)]
    rows += [("train", rows[0][1])] * 50 + [("test", rows[0][1])] * 50
    odd = [("train", None), ("test", [0.0] * 6), ("valid", [float("nan")] + [1.0] * 5), (None, rows[0][1]), ("test", [float("inf")] * 6), ("test", [None] + [1.0] * 5)]
    df = spark.createDataFrame(rows + odd, "part string, e array<double>")

    def close(a, b):
        return np.dot(a, b) / np.linalg.norm(a) / np.linalg.norm(b) >= 0.98

    want = counted(rows, close)
    assert want and as_dict(overlap.near_vectors(df, "part", "e", PARTS, rows=16)) == want
    assert overlap.near_vectors(df.limit(0), "part", "e", PARTS).count() == 0


def test_search_within_a_distance_asks_few_cells(spark):
    rng = np.random.default_rng(5)
    middle = rng.normal(size=(40, 6)) * 50
    rows = [(i, [float(x) for x in middle[i % 40] + rng.normal(size=6)]) for i in range(1600)]
    df = spark.createDataFrame(rows, "id bigint, v array<double>")
    index = neighbours.build_index(df, "id", "v", rows=40)
    found = neighbours.search_index(index, df, "id", "v", 3, rows=40, within=2.0).collect()
    v = np.array([x for _, x in rows])
    want = set()
    for i in range(len(v)):
        d = np.sqrt(((v - v[i]) ** 2).sum(1))
        want |= {(i, int(j)) for j in sorted((j for j in range(len(v)) if j != i and d[j] <= 2.0), key=lambda j: (d[j], j))[:3]}
    assert want and {(r["id"], r["neighbour"]) for r in found} == want
    assert np.mean([r["visited"] for r in found]) < 10


def test_error_functions(spark):
    xs = [k / 16 for k in range(-96, 97)] + [1e-300, 25.0, float("inf"), float("-inf")]
    d = column(spark, xs, "double")
    np.testing.assert_allclose([r[0] for r in d.select(numeric.erf(F.col("v"))).collect()], [math.erf(x) for x in xs], rtol=1e-14)
    np.testing.assert_allclose([r[0] for r in d.select(numeric.erfc(F.col("v"))).collect()], [math.erfc(x) for x in xs], rtol=1e-12)
    ps = [k / 500 for k in range(1, 500)] + [1e-12, 1e-200, 1 - 1e-12]
    got = [r[0] for r in column(spark, ps, "double").select(numeric.normal_quantile(F.col("v"))).collect()]
    np.testing.assert_allclose(got, [NormalDist().inv_cdf(p) for p in ps], rtol=1e-13, atol=1e-15)
    got = [r[0] for r in column(spark, [0.0, 1.0, None, 1.5], "double").select(numeric.normal_quantile(F.col("v"))).collect()]
    assert math.isnan(got[0]) and math.isnan(got[1]) and got[2] is None and math.isnan(got[3])
    got = [r[0] for r in column(spark, [1.0, -1.0, None, -1.5, 1e-9], "double").select(numeric.erfinv(F.col("v"))).collect()]
    assert got[:3] == [math.inf, -math.inf, None] and math.isnan(got[3]) and got[4] == pytest.approx(1e-9 * math.sqrt(math.pi) / 2, rel=1e-14)


@pytest.mark.parametrize("width", [1, 7, 20, 60])
def test_wrap(spark, width):
    values = ["", "one", "some two-part names and much longer-than-that ones " * 3, "q" * 150, "ab " + "q" * 130 + " cd", "gap  of   blanks    ends ",
              "a\tb\tlong column\n\tindented\r\nlast", "ü-ber große Straßen-Bahn " * 4, "- -- a--b c-", None]
    if width < 20:  # a long word with a hyphen is cut at the edge here
        values = [v for v in values if v is None or "-" not in v]
    got = [r[0] for r in column(spark, values, "string").select(text.wrap(F.col("v"), width)).collect()]
    assert got == [None if v is None else "\n".join(textwrap.wrap(v, width)) for v in values]


def test_sampled_contexts(spark):
    d = spark.createDataFrame([(1, "a b c d e f g h"), (2, "a b c d e f g h"), (3, "lone"), (4, ""), (5, None)], "doc int, text string")
    rows = tok.sampled_skip_grams(d, "doc", "text", 3, 2, seed=9).collect()
    words = "abcdefgh"
    assert all(r["center"] == words[r["pos"]] and r["context"] == words[r["context_pos"]] and 0 < abs(r["pos"] - r["context_pos"]) <= 3 for r in rows)
    assert Counter((r["doc"], r["pos"]) for r in rows) == {(doc, p): 2 for doc in (1, 2) for p in range(8)}
    assert len({tuple(r) for r in rows}) == 32
    assert {tuple(r)[1:] for r in rows if r["doc"] == 1} != {tuple(r)[1:] for r in rows if r["doc"] == 2}
    again = tok.sampled_skip_grams(d.repartition(3), "doc", "text", 3, 2, seed=9).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, rows))
    whole = tok.sampled_skip_grams(d, "doc", "text", 2, 99, seed=9).select("doc", "center", "context").collect()
    assert Counter(map(tuple, whole)) == Counter(map(tuple, tok.skip_grams(d, "doc", "text", 2).select("doc", "center", "context").collect()))


def test_every_k_as_if_alone(spark):
    rng = np.random.default_rng(8)
    df = spark.createDataFrame([(i, [float(x) for x in rng.normal(size=3)], int(rng.integers(3))) for i in range(120)], "id bigint, v array<double>, label int")
    near = neighbours.nearest(df, df, "id", "v", 9)
    got = {}
    for r in neighbours.classify_each(near, df, "id", "label", [1, 4, 9]).collect():
        got.setdefault(r["k"], set()).add((r["id"], r["label"], r["votes"], r["share"]))
    for k in (1, 4, 9):
        alone = neighbours.classify(near.where(F.col("rank") <= k), df, "id", "label").collect()
        assert got[k] == {tuple(r) for r in alone}


def test_matrices_of_arrays(spark):
    rows = column(spark, [list(range(7)), [], None], "array<int>").select(arrays.matrix(F.col("v"), 3).alias("m"))
    assert [r[0] for r in rows.collect()] == [[[0, 1, 2], [3, 4, 5], [6]], [], None]
    assert rows.select(arrays.transposed(F.col("m"), 3)).first()[0] == [[0, 3, 6], [1, 4, None], [2, 5, None]]


def test_out_of_fold_rows_are_predicted_once(spark):
    from pyspark.ml.classification import LogisticRegression

    from quillframe.models import features, fit

    df = features.assemble(spark.createDataFrame([(i, float(i % 10), float(i % 10 > 4)) for i in range(300)], "id int, x double, label double"), ["x"])
    rows = fit.out_of_fold(LogisticRegression(), df, ["id"], 3, seed=1).collect()
    assert sorted(r["id"] for r in rows) == list(range(300)) and {r["fold"] for r in rows} == {0, 1, 2}
    assert sum(r["label"] == r["prediction"] for r in rows) == 300
    again = fit.out_of_fold(LogisticRegression(), df.repartition(5), ["id"], 3, seed=1).collect()
    assert sorted((r["id"], r["fold"]) for r in again) == sorted((r["id"], r["fold"]) for r in rows)


def test_wrap_grows_with_the_text(spark):
    # Twice 40,000 words in one text; a fold that copies its lines for every word needs minutes for it.
    value = " ".join(["word well-known tabbed\tend" + "x" * (i % 90) for i in range(20_000)])
    start = time.monotonic()
    got = column(spark, [value, value + "\n" + value], "string").select(text.wrap(F.col("v"), 60)).collect()
    took = time.monotonic() - start
    assert {r[0] for r in got} == {"\n".join(textwrap.wrap(v, 60)) for v in (value, value + "\n" + value)} and took < 20


def test_a_long_text_among_sampled_contexts(spark):
    # Carrying the text along with each of its words takes the square of its length.
    words = [f"w{i % 997}" for i in range(60_000)]
    start = time.monotonic()
    got = tok.sampled_pair_counts(spark.createDataFrame([(7, " ".join(words)), (None, "a b"), (8, None)], "doc bigint, text string"), "doc", "text", 4, 2, 11).collect()
    took = time.monotonic() - start
    want = Counter()
    for doc, w in ("-7", words), ("", ["a", "b"]):
        for i in range(len(w)):
            near = [j for j in range(max(i - 4, 0), min(i + 5, len(w))) if j != i]
            want.update((w[i], w[j]) for j in sorted(near, key=lambda j: hashlib.md5(f"11{doc}-{i}-{j}".encode()).hexdigest())[:2])
    assert {(r["center"], r["context"]): r["n"] for r in got} == want and took < 30


def test_tf_idf_counts_terms_once(spark, monkeypatch):
    # Null documents have no length to be scaled by; a document that comes twice is one. The terms are written once, then read.
    written = []
    monkeypatch.setattr(weights, "scratch_path", lambda session, label: written.append(label) or scratch_path(session, label), raising=False)
    d = spark.createDataFrame([(1, "Aa bb aa"), (1, "bb x"), (2, "aa cc"), (None, "aa"), (3, None)], "doc bigint, text string")
    got = {(r["doc"], r["term"]): round(r["weight"], 9) for r in weights.tf_idf(d, "doc", "text", 2).collect()}
    assert got == {(1, "aa"): 1.0, (2, "aa"): 1.0} and written == ["terms"]


def test_state_is_asked_for_once_a_key():
    asked = []

    class Value:
        def __init__(self):
            self.held = None

        def __getattr__(self, name):
            asked.append(name)
            return {"exists": lambda: self.held is not None, "get": lambda: self.held, "update": lambda v: setattr(self, "held", v)}[name]

    kept = state.Kept(state.running_total("v"), "n bigint, total double", ["k", "n", "total"], None, None)
    kept.value = Value()
    out = [next(iter(kept.handleInputRows((5,), iter([pd.DataFrame({"v": [1.5, 2.0]})]), None))) for _ in range(2)]
    assert [tuple(x.iloc[0]) for x in out] == [(5, 2, 3.5), (5, 4, 7.0)] and asked == ["get", "update"] * 2
