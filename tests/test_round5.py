"""Searches that ask for every row, top-k without a broadcast of its copies, pairs of words in compact blocks."""

from types import SimpleNamespace

import numpy as np
import pytest

from quillframe.registry import load_catalog

VECTORS = "vec_id long, embedding array<float>, label int"


def embeddings(spark, ids):
    r = np.random.default_rng(4)
    return SimpleNamespace(embeddings=spark.createDataFrame([(i, r.normal(size=5).tolist(), i % 3) for i in ids], VECTORS))


@pytest.mark.parametrize("name, k", [("J16_nearest_l2", 3), ("J16_nearest_l1", 1), ("C06_nearest_cosine", 8)])
def test_searches_ask_for_every_row(spark, name, k):
    q, ids = load_catalog()[name], list(range(95, 117))
    t = embeddings(spark, ids)
    v = {r["vec_id"]: np.array(r["embedding"], dtype=float) for r in t.embeddings.collect()}
    far = {"J16_nearest_l2": lambda a, b: np.linalg.norm(a - b), "J16_nearest_l1": lambda a, b: np.abs(a - b).sum(),
           "C06_nearest_cosine": lambda a, b: -(a @ b) / np.linalg.norm(a) / np.linalg.norm(b)}[name]
    want = {i: sorted((j for j in ids if j != i), key=lambda j: far(v[i], v[j]))[:k] for i in ids}
    got = {i: [] for i in ids}
    for r in q.build(t).orderBy("id", "rank").collect():
        got[r["id"]].append(r["neighbour"])
    assert got == want and "%" not in q.sql


def test_every_row_is_classified_by_its_neighbours(spark):
    ids = [i for i in range(95, 117) if i != 100]
    classify, sweep = (load_catalog()[n] for n in ("L16_knn_classify", "L16_knn_sweep"))
    assert sorted(r["id"] for r in classify.build(embeddings(spark, ids)).collect()) == ids and "%" not in classify.sql
    assert {r["n"] for r in sweep.build(embeddings(spark, ids)).collect()} == {len(ids)} and "%" not in sweep.sql


def test_copies_of_the_queries_are_not_broadcast(spark):
    from quillframe.llm import topk

    r = np.random.default_rng(5)
    rows = [(i, r.normal(size=4).tolist(), 0) for i in range(120)]
    found = topk.search(spark.createDataFrame(rows, VECTORS).repartition(3))
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
    x = {i: np.floor(256 * np.asarray(v, np.float32).astype(float)) for i, v, _ in rows}
    want = {(i, k + 1, j, int(x[i] @ x[j])) for i in (0, 50, 100) for k, j in enumerate(sorted((j for j in x if j != i), key=lambda j: (-(x[i] @ x[j]), j))[:5])}
    assert {tuple(r) for r in found.select("query_id", "rank", "vec_id", "score").collect()} == want


def test_packed_pairs_and_words_come_back():
    import pyarrow as pa

    from quillframe.corpus import grid

    r = np.random.default_rng(1)
    for most, wide, n in ((0, 9, 0), (1, 9, 1), (1000, 60, 1), (300, 2**31, 2**40)):
        key = np.unique(r.integers(0, 50, most) << 32 | r.integers(0, wide, most))
        want = key >> 32, key & 0xFFFFFFFF, r.integers(1, n + 1, len(key))
        assert all(np.array_equal(a, b) for a, b in zip(want, grid.unpack_pairs(grid.pack_pairs(*want))))
    for words in ([], [""], ["é", "", "𝄞 b", "c"]):
        assert grid.unpack_words(grid.pack_words(pa.array(words, pa.string()))).to_pylist() == words


def test_pairs_travel_as_blocks_of_cells(spark, monkeypatch):
    import random
    from collections import Counter

    from quillframe.corpus import grid

    monkeypatch.setattr(grid, "CELL", 64)
    r = random.Random(3)
    texts = [" ".join(r.choice("abcdefghijklmnopqrstuvwxyz") * r.randrange(1, 4) for _ in range(r.randrange(30))) for _ in range(120)] + [None, "", "alone", "a a a", "once upon"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    g = grid.Grid(df, "text", 3, 4)
    sums, want = Counter(), Counter()
    for w in ((t or "").split() for t in texts):
        for i in range(len(w)):
            sums[w[i]] += sum(1 for j in range(len(w)) if 0 < abs(i - j) <= 3)
            want.update(tuple(sorted((w[i], w[j]))) for j in range(i + 1, min(len(w), i + 4)))
    sums = {w: n for w, n in sums.items() if n >= 4}
    found = {}
    for row in g.vocabulary.collect():
        found |= dict(zip(grid.unpack_words(row["a"]).to_pylist(), grid.unpack(row["b"]).tolist()))
    assert found == sums and g.total == sum(sums.values()) and g.groups > 3

    def rows(cell, one, other, first, second, n):
        import pyarrow as pa

        yield pa.RecordBatch.from_arrays([one[0].take(pa.array(first)), other[0].take(pa.array(second)), pa.array(n)], names=["a", "b", "n"])

    got = [(*sorted((x["a"], x["b"])), x["n"]) for x in g.mapped(rows, "a string, b string, n bigint").collect()]
    want = {k: n for k, n in want.items() if k[0] in sums and k[1] in sums}
    assert len(got) == len(want) and {(a, b): n for a, b, n in got} == want
    # No row a pair goes through an exchange: a block a cell and chunk of texts does.
    assert g.blocks().count() <= g.heads.count() * len(g.cells) < len(want)


def test_products_of_vectors_are_not_dealt_out(spark, monkeypatch):
    from quillframe.corpus import grid, vectors

    r = np.random.default_rng(6)
    texts = [" ".join(f"w{int(x)}" for x in r.zipf(1.5, 25) % 60) for _ in range(80)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    whole = {x["word"]: x["vector"] for x in vectors.pmi_vectors(df, "doc_id", "text", size=3, window=2, min_count=2, seed=1).collect()}
    monkeypatch.setattr(grid, "CELL", 64)
    out = vectors.pmi_vectors(df, "doc_id", "text", size=3, window=2, min_count=2, seed=1)
    cut = {x["word"]: x["vector"] for x in out.collect()}
    assert cut.keys() == whole.keys() and len(cut) > 20
    a, b = (np.array([x[w] for w in sorted(whole)]) for x in (whole, cut))
    assert np.allclose(a @ a.T, b @ b.T, atol=1e-6) and "Exchange" not in out._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("dims", [1, 7, 600])
def test_l1_neighbours_by_whole_numbers_are_those_by_differences(dims):
    from quillframe.operators.neighbours import _closest, _distances

    r = np.random.default_rng(2)
    right = np.vstack([r.normal(size=(300, dims)), np.round(r.normal(size=(60, dims)), 1)])
    right = np.vstack([right, right[:40], right[:40] + 1e-12])
    for extra in (np.empty((0, dims)), np.full((1, dims), 1e9), np.full((1, dims), np.nan), np.full((2, dims), 1e308) * [[1], [-1]]):
        far = np.vstack([right, extra])
        left = far[:60]
        for k, limit in ((1, np.inf), (3, np.inf), (500, np.inf), (3, 0.5)):
            with np.errstate(invalid="ignore", over="ignore"):
                d = _distances(left, far, "l1")
                d[np.arange(60), np.arange(60)] = np.inf
                order = np.argsort(d, axis=1, kind="stable")[:, :k]
                want = [(i, j, d[i, j]) for i in range(60) for j in order[i].tolist() if np.isfinite(d[i, j]) and d[i, j] <= limit]
                row, column, got = _closest(left, far, np.eye(60, len(far), dtype=bool), k, "l1", limit)
            got = [x for x in zip(row.tolist(), column.tolist(), got.tolist()) if x[2] <= limit]
            assert got == want
    assert len(_closest(right[:5], right[:1], np.eye(5, 1, dtype=bool), 2, "l1", np.inf)[0]) == 4


def test_vectors_keep_one_block_on_disk(spark, monkeypatch, tmp_path):
    import os

    from quillframe.corpus import grid, vectors

    def folder(_, label, made=[]):
        made.append(label)
        return str(tmp_path / f"{label}-{len(made)}")

    monkeypatch.setattr(grid, "scratch_path", folder)
    monkeypatch.setattr(vectors, "scratch_path", folder)
    df = spark.createDataFrame([(i, f"a b c{i % 3} d") for i in range(9)], "doc_id long, text string")
    out = vectors.pmi_vectors(df, "doc_id", "text", size=2, window=2)
    assert len(os.listdir(tmp_path)) == 1 and os.listdir(tmp_path)[0].startswith("block") and out.count() > 0
