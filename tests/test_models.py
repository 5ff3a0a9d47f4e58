"""Fitted models beside closed forms: gradients of zero, least squares, nearest centres, eigenvectors, densities."""

import math

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.clustering import GaussianMixture, KMeans
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from quillframe.models import fit


def points(spark, x, y=None):
    rows = [(i, [float(v) for v in row], float(0 if y is None else y[i])) for i, row in enumerate(x)]
    return spark.createDataFrame(rows, "id long, a array<double>, label double").withColumn("features", array_to_vector("a")).repartition(4)


@pytest.fixture(scope="module")
def noisy(spark):
    r = np.random.default_rng(5)
    x = r.normal(size=(400, 3))
    y = (x @ [1.0, -2.0, 0.5] + r.logistic(size=400) > 0.3).astype(float)
    return x, y, points(spark, x, y)


def test_logistic_gradient_is_zero(noisy):
    x, y, df = noisy
    model = LogisticRegression(maxIter=200, tol=1e-10).fit(df)
    rows = {r["id"]: r for r in fit.score(model, df, ["id"]).collect()}
    p = np.array([rows[i]["probability"] for i in range(len(y))])
    assert np.allclose(x.T @ (p - y) / len(y), 0, atol=1e-6) and abs((p - y).mean()) < 1e-6
    assert all(rows[i]["prediction"] == (p[i] > 0.5) for i in range(len(y)))


def test_fold_scores_beside_their_rows(noisy):
    _, y, df = noisy
    found = fit.out_of_fold(LogisticRegression(), df, ["id"], 5, seed=2)
    rows = found.collect()
    assert sorted(r["id"] for r in rows) == list(range(len(y))) and all(r["label"] == y[r["id"]] for r in rows)
    scores = {r["fold"]: (r["n"], r["accuracy"]) for r in fit.cross_val_scores(found).collect()}
    for fold, (n, accuracy) in scores.items():
        own = [r for r in rows if r["fold"] == fold]
        assert n == len(own) and accuracy == pytest.approx(np.mean([r["label"] == r["prediction"] for r in own]))
    # The fold left out is the only one its model has not seen.
    parts = found.select("id", "fold").join(df, "id")
    model = LogisticRegression().fit(parts.filter("fold != 0"))
    again = {r["id"]: r["probability"] for r in fit.score(model, parts.filter("fold = 0"), ["id"]).collect()}
    assert again == pytest.approx({r["id"]: r["probability"] for r in rows if r["fold"] == 0}, abs=1e-3)


def test_trees_find_planted_rules(spark):
    r = np.random.default_rng(6)
    x = r.uniform(size=(600, 4))
    y = ((x[:, 2] > 0.4) & (x[:, 0] < 0.7)).astype(float)
    df = points(spark, x, y)
    for estimator in (DecisionTreeClassifier(maxDepth=3, maxBins=300), RandomForestClassifier(numTrees=30, maxDepth=6, featureSubsetStrategy="all", seed=1),
                      GBTClassifier(maxIter=5, maxDepth=3, seed=1)):
        model = estimator.fit(df)
        rows = fit.score(model, df, ["id"]).collect()
        assert np.mean([q["prediction"] == y[q["id"]] for q in rows]) > 0.97
        ranked = fit.importances(model, ["a", "b", "c", "d"])
        assert {n for n, _ in ranked[:2]} == {"a", "c"} and sum(v for _, v in ranked) == pytest.approx(1) and len(ranked) == 4
        assert fit.importances(model, ["a", "b", "c", "d"], 1) == ranked[:1]


def test_curves_beside_least_squares(spark):
    r = np.random.default_rng(7)
    x = r.uniform(-1, 1, size=500)
    y = 1 + x - 3 * x**2 + r.normal(scale=0.1, size=500)
    u = (np.arange(500) + 0.5) / 500
    df = spark.createDataFrame([tuple(map(float, row)) for row in zip(x, y, u)], "x double, label double, u double")
    train, test = df.filter("u < 0.8"), df.filter("u >= 0.8")

    def errors(keep, degree):
        c = np.polyfit(x[keep], y[keep], degree)
        return tuple(math.sqrt(np.mean((y[s] - np.polyval(c, x[s])) ** 2)) for s in (keep, u >= 0.8))

    for degree, inside, outside in fit.validation_curve(train, test, "x", "label", [1, 2, 4]):
        assert (inside, outside) == pytest.approx(errors(u < 0.8, degree), rel=1e-5)
    for share, inside, outside in fit.learning_curve(train, test, "x", "label", 2, "u", [0.1, 0.5, 0.8]):
        assert (inside, outside) == pytest.approx(errors(u < share, 2), rel=1e-5)


def test_rows_lie_with_their_nearest_centre(spark):
    r = np.random.default_rng(8)
    x = np.vstack([r.normal(c, 0.3, size=(80, 2)) for c in ((0, 0), (6, 0), (0, 6))])
    df = points(spark, x)
    named = {q["id"]: q["cluster"] for q in fit.clusters(df, 3, seed=1).collect()}
    centres = np.array([x[[i for i in named if named[i] == c]].mean(axis=0) for c in range(3)])
    assert all(np.argmin(((centres - x[i]) ** 2).sum(axis=1)) == c for i, c in named.items())
    assert all(len({named[i] for i in range(80 * k, 80 * k + 80)}) == 1 for k in range(3)) and len(set(named.values())) == 3
    fitted = np.array(KMeans(k=3, seed=1).fit(df).clusterCenters())
    assert np.allclose(sorted(map(tuple, fitted)), sorted(map(tuple, centres)), atol=1e-6)


def test_components_beside_eigenvectors(spark):
    r = np.random.default_rng(9)
    x = r.normal(size=(300, 5)) @ np.diag([5, 3, 1, 0.5, 0.1]) @ np.linalg.qr(r.normal(size=(5, 5)))[0] + 4
    df = points(spark, x)
    model, out, mean = fit.components(df, "features", k=2)
    assert np.allclose(mean, x.mean(axis=0))
    values, axes = np.linalg.eigh(np.cov(x.T))
    top = axes[:, ::-1][:, :2]
    pc = model.pc.toArray()
    assert np.allclose(np.abs(pc.T @ top), np.eye(2), atol=1e-6) and np.allclose(pc.T @ pc, np.eye(2), atol=1e-9)
    assert np.allclose(list(model.explainedVariance), (values[::-1] / values.sum())[:2])
    rows = {q["id"]: q for q in fit.restore(out, model, mean).select("id", "restored", vector_to_array("pcs").alias("p")).collect()}
    back = np.array([rows[i]["restored"] for i in range(300)])
    assert np.allclose(back, (x - x.mean(axis=0)) @ pc @ pc.T + x.mean(axis=0))
    assert ((back - x) ** 2).sum() == pytest.approx(values[:3].sum() * 299)
    wanted = int(np.searchsorted(np.cumsum(values[::-1]) / values.sum(), 0.97) + 1)
    assert len(fit.components(df, "features", variance=0.97)[0].explainedVariance) == wanted


def test_densities_beside_closed_forms(spark):
    r = np.random.default_rng(10)
    x = np.concatenate([r.normal(-4, 0.5, 300), r.normal(3, 1.0, 500)])[:, None]
    df = points(spark, x)
    sweep = {k: (ll, bic, aic) for k, ll, bic, aic in fit.mixture_sweep(df, [1, 2], dim=1, seed=1)}
    v, n = x.var(), len(x)
    assert sweep[1][0] == pytest.approx(-n / 2 * (math.log(2 * math.pi * v) + 1))
    assert sweep[1][1] == pytest.approx(2 * math.log(n) - 2 * sweep[1][0]) and sweep[2][2] == pytest.approx(10 - 2 * sweep[2][0])
    assert sweep[2][0] > sweep[1][0] + 100 and sweep[2][1] < sweep[1][1]
    model = GaussianMixture(k=2, seed=1, maxIter=100).fit(df)
    got = {q["id"]: q["log_density"] for q in fit.log_density(df.withColumn("v", F.col("a")[0]), model, "v").collect()}
    parts = [(w, g.mean[0], g.cov.toArray()[0, 0]) for w, g in zip(model.weights, model.gaussians)]
    for i in range(n):
        p = sum(w / math.sqrt(2 * math.pi * s) * math.exp(-((x[i, 0] - m) ** 2) / (2 * s)) for w, m, s in parts)
        assert got[i] == pytest.approx(math.log(p), rel=1e-9)
