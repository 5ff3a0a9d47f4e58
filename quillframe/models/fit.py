"""Fitting, cross-validation, clustering, components and mixtures with the Spark ML estimators."""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
from pyspark.ml.clustering import GaussianMixture, KMeans
from pyspark.ml.feature import PCA, PolynomialExpansion
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillframe.models.features import folds
from quillframe.session import reliable


def score(model, df: DataFrame, ids: list[str], label: str = "label") -> DataFrame:
    """(ids, label, prediction[, probability of class 1])."""
    out = model.transform(df)
    cols = [*ids, F.col(label).cast("double").alias("label"), "prediction"]
    if "probability" in out.columns:
        cols.append(vector_to_array("probability")[1].alias("probability"))
    return out.select(*cols)


def out_of_fold(estimator, df: DataFrame, ids: list[str], k: int = 5, seed: int = 0, label: str = "label") -> DataFrame:
    """Every row predicted once, by the model that did not see it; the rows are scored while the folds are still cached."""
    parts = folds(df, k, seed, *ids).persist()
    try:
        frames = [score(estimator.fit(parts.filter(F.col("fold") != i)), parts.filter(F.col("fold") == i), [*ids, "fold"], label)
                  for i in range(k)]
        return reliable(reduce(DataFrame.unionAll, frames))
    finally:
        parts.unpersist()


def cross_val_scores(predictions: DataFrame) -> DataFrame:
    """(fold, n, accuracy)."""
    return predictions.groupBy("fold").agg(F.count(F.lit(1)).alias("n"),
                                           F.avg((F.col("label") == F.col("prediction")).cast("double")).alias("accuracy"))


def polynomial(df: DataFrame, x: str, degree: int) -> DataFrame:
    base = df.withColumn("_x", array_to_vector(F.array(F.col(x).cast("double"))))
    return PolynomialExpansion(inputCol="_x", outputCol="features", degree=degree).transform(base).drop("_x")


def rms(df: DataFrame, y: str, yhat: str) -> float:
    return df.agg(F.sqrt(F.avg(F.pow(F.col(y) - F.col(yhat), 2)))).first()[0]


def validation_curve(train: DataFrame, test: DataFrame, x: str, y: str, degrees: list[int]) -> list[tuple[int, float, float]]:
    """(degree, training error, test error): root mean squares of polynomial fits."""
    out = []
    for d in degrees:
        tr, te = polynomial(train, x, d), polynomial(test, x, d)
        model = LinearRegression(labelCol=y).fit(tr)
        out.append((d, rms(model.transform(tr), y, "prediction"), rms(model.transform(te), y, "prediction")))
    return out


def learning_curve(train: DataFrame, test: DataFrame, x: str, y: str, degree: int, unit: str, shares: list[float]) -> list[tuple[float, float, float]]:
    """(share, training error, test error) over growing samples; ``unit`` is a column uniform in [0, 1)."""
    te, out = polynomial(test, x, degree), []
    for s in shares:
        tr = polynomial(train.filter(F.col(unit) < s), x, degree)
        model = LinearRegression(labelCol=y).fit(tr)
        out.append((s, rms(model.transform(tr), y, "prediction"), rms(model.transform(te), y, "prediction")))
    return out


def clusters(df: DataFrame, k: int, seed: int = 0, features: str = "features") -> DataFrame:
    return KMeans(k=k, seed=seed, featuresCol=features, predictionCol="cluster").fit(df).transform(df)


def components(df: DataFrame, features: str, k: int | None = None, variance: float | None = None):
    """(model, centred frame, explained shares): k components, or as many as reach the wanted variance."""
    mean = df.select(Summarizer.mean(F.col(features)).alias("m")).first()["m"]
    arr, m = vector_to_array(features), F.array(*[F.lit(float(v)) for v in mean])
    centred = df.withColumn("_centred", array_to_vector(F.zip_with(arr, m, lambda a, b: a - b)))
    model = PCA(k=len(mean) if variance is not None else k, inputCol="_centred", outputCol="pcs").fit(centred)
    if variance is not None:
        total, k = 0.0, 0
        for v in model.explainedVariance:
            k, total = k + 1, total + v
            if total >= variance:
                break
        model = PCA(k=k, inputCol="_centred", outputCol="pcs").fit(centred)
    return model, model.transform(centred), mean


def restore(df: DataFrame, model, mean, out: str = "restored") -> DataFrame:
    """Back from components to the original space."""
    pcs, pc = vector_to_array("pcs"), model.pc.toArray()
    cells = []
    for i, m in enumerate(mean):
        weights = F.array(*[F.lit(float(w)) for w in pc[i]])
        cells.append(F.aggregate(F.zip_with(pcs, weights, lambda a, b: a * b), F.lit(float(m)), lambda s, x: s + x))
    return df.withColumn(out, F.array(*cells))


def single_gaussian(df: DataFrame, dim: int, features: str = "features") -> float:
    """Log-likelihood of one Gaussian at its best fit, from the covariances alone."""
    arr = vector_to_array(features)
    cols = df.select(*[arr[i].alias(f"x{i}") for i in range(dim)])
    pairs = [(i, j) for i in range(dim) for j in range(i, dim)]
    r = cols.agg(F.count(F.lit(1)), *[F.covar_pop(f"x{i}", f"x{j}") for i, j in pairs]).first()
    cov = np.zeros((dim, dim))
    for (i, j), v in zip(pairs, r[1:]):
        cov[i, j] = cov[j, i] = v
    return float(-r[0] / 2 * (dim * math.log(2 * math.pi) + np.linalg.slogdet(cov)[1] + dim))


def mixture_sweep(df: DataFrame, sizes: list[int], dim: int, features: str = "features", seed: int = 0) -> list[tuple[int, float, float, float]]:
    """(components, log-likelihood, BIC, AIC)."""
    n, out = df.count(), []
    for k in sizes:
        ll = single_gaussian(df, dim, features) if k == 1 else GaussianMixture(k=k, seed=seed, featuresCol=features, maxIter=50).fit(df).summary.logLikelihood
        free = k * (dim + dim * (dim + 1) / 2) + k - 1
        out.append((k, ll, free * math.log(n) - 2 * ll, 2 * free - 2 * ll))
    return out


def log_density(df: DataFrame, model, col: str, out: str = "log_density") -> DataFrame:
    """Log density of a one-dimensional mixture at a column."""
    terms = []
    for w, g in zip(model.weights, model.gaussians):
        mu, var = float(g.mean[0]), float(g.cov.toArray()[0, 0])
        terms.append(F.lit(math.log(w) - 0.5 * math.log(2 * math.pi * var)) - F.pow(F.col(col) - mu, 2) / (2 * var))
    top = F.greatest(*terms) if len(terms) > 1 else terms[0]
    return df.withColumn(out, top + F.ln(sum((F.exp(x - top) for x in terms), F.lit(0.0))))


def importances(model, names: list[str], top: int | None = None) -> list[tuple[str, float]]:
    """Feature names with their own importance, best first, over all features."""
    pairs = [(n, float(v)) for n, v in zip(names, model.featureImportances.toArray())]
    return sorted(pairs, key=lambda p: (-p[1], p[0]))[:top]
