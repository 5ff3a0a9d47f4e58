"""Empirical distributions as tables: (value, p), (value, cum_p), (x, y, p), (hypothesis, p).

Everything starts from counts of distinct values, so a value held by a third of all rows costs one
row per task. Pair operations run over distinct values in blocks, never over rows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillframe.functions.numeric import erf, ln_gamma, normal_quantile
from quillframe.operators.binning import bracket_join
from quillframe.plans.blocks import block_pairs
from quillframe.plans.ordered import cumulative_counts, scan, with_group_stats
from quillframe.plans.seeded import uniform


def pmf(df: DataFrame, value: str, keys: list[str] = ()) -> DataFrame:
    """(keys, value, n, p): frequencies and their share, nulls left out."""
    keys = list(keys)
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))
    return with_group_stats(counts, keys, {"_N": F.sum("n")}).withColumn("p", F.col("n") / F.col("_N")).drop("_N")


def normalize(table: DataFrame, p: str = "p", keys: list[str] = ()) -> DataFrame:
    return with_group_stats(table, list(keys), {"_s": F.sum(p)}).withColumn(p, F.col(p) / F.col("_s")).drop("_s")


def pmf_summary(table: DataFrame, value: str, keys: list[str] = ()) -> DataFrame:
    """mean, var, std and mode (the larger value on ties) of a probability table."""
    keys, x, p = list(keys), F.col(value), F.col("p")
    mean = with_group_stats(table, keys, {"_m": F.sum(p * x)})
    return mean.groupBy(*keys).agg(
        F.max("_m").alias("mean"), F.sum(p * F.pow(x - F.col("_m"), 2)).alias("var"),
        F.sqrt(F.sum(p * F.pow(x - F.col("_m"), 2))).alias("std"), F.max_by(x, F.struct(p, x)).alias("mode"))


def cdf(df: DataFrame, value: str, keys: list[str] = ()) -> DataFrame:
    """(keys, value, n, cum, p, cum_p)."""
    keys = list(keys)
    cum = cumulative_counts(df.select(*keys, value), keys, value)
    return cum.select(*keys, value, "n", "cum", (F.col("n") / F.col("total")).alias("p"), (F.col("cum") / F.col("total")).alias("cum_p"))


def percentile_rank(df: DataFrame, value: str, x: float, keys: list[str] = ()) -> DataFrame:
    """Share of rows at or below x, in percent."""
    return df.filter(F.col(value).isNotNull()).groupBy(*keys).agg(
        (F.count_if(F.col(value) <= x) / F.count(F.lit(1)) * 100).alias("rank"))


def compare(df: DataFrame, value: str, side: Column) -> DataFrame:
    """P(A < B), P(A = B), P(A > B) for independent draws; ``side`` is true for A, false for B.

    One ordered scan of the distinct values replaces the product of the two tables.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(value).agg(
        F.count_if(side).cast("double").alias("a"), F.count_if(~side).cast("double").alias("b"))
    below = scan(counts, [], [value], {"b_cum": ("sum", "b")})
    t = below.agg(F.sum(F.col("a") * (F.col("b_cum") - F.col("b"))).alias("gt"), F.sum(F.col("a") * F.col("b")).alias("eq"),
                  (F.sum("a") * F.sum("b")).alias("all"))
    return t.select(((F.col("all") - F.col("gt") - F.col("eq")) / F.col("all")).alias("less"),
                    (F.col("eq") / F.col("all")).alias("equal"), (F.col("gt") / F.col("all")).alias("greater"))


OPERATIONS = {"add": np.add, "sub": np.subtract, "mul": np.multiply, "div": np.divide}


def convolve(a: DataFrame, b: DataFrame, value: str, op: str = "add", digits: int = 9) -> DataFrame:
    """(value, p): distribution of ``x op y`` for independent x and y, from two (value, n) tables.

    Block pairs of distinct values are combined and summed inside the task; only distinct results leave it.
    Results are matched after rounding to ``digits``.
    """
    f = OPERATIONS[op]

    def combine(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        with np.errstate(divide="ignore", invalid="ignore"):
            z = f.outer(x["v"].to_numpy(), y["v"].to_numpy()).ravel().round(digits) + 0.0
        w = np.multiply.outer(x["n"].to_numpy(), y["n"].to_numpy()).ravel()
        keep = np.isfinite(z)
        return pd.DataFrame({"z": z[keep], "w": w[keep]}).groupby("z", as_index=False)["w"].sum()

    def side(d: DataFrame) -> DataFrame:
        return d.select(F.col(value).cast("double").alias("v"), F.col("n").cast("double").alias("n"))

    parts = block_pairs(side(a), side(b), ["v"], ["v"], combine, "z double, w double", rows=1024)
    sums = parts.groupBy(F.col("z").alias(value)).agg(F.sum("w").alias("p"))
    return normalize(sums)


def maximum_of(table: DataFrame, value: str, k: int) -> DataFrame:
    """(value, p): distribution of the largest of k draws, from a table of :func:`cdf`."""
    before = F.col("cum_p") - F.col("p")
    return table.select(value, (F.pow("cum_p", F.lit(k)) - F.pow(before, F.lit(k))).alias("p"))


def mixture(table: DataFrame, key: str, value: str, weights: dict) -> DataFrame:
    """(value, p): the keyed distributions mixed with the given weights."""
    w = F.try_element_at(F.create_map(*[F.lit(x) for kv in weights.items() for x in kv]), F.col(key))
    return table.filter(w.isNotNull()).groupBy(value).agg(F.sum(w * F.col("p")).alias("p"))


def joint(df: DataFrame, x: str, y: str) -> DataFrame:
    """(x, y, p)."""
    counts = df.dropna(subset=[x, y]).groupBy(x, y).agg(F.count(F.lit(1)).alias("n"))
    return with_group_stats(counts, [], {"_N": F.sum("n")}).select(x, y, (F.col("n") / F.col("_N")).alias("p"))


def marginal(table: DataFrame, col: str) -> DataFrame:
    return table.groupBy(col).agg(F.sum("p").alias("p"))


def conditional(table: DataFrame, col: str, given: str, at) -> DataFrame:
    """Distribution of ``col`` where ``given`` equals ``at``."""
    return normalize(table.filter(F.col(given) == at).select(col, "p"))


def likeliest_interval(df: DataFrame, value: str, percentage: float = 90.0) -> DataFrame:
    """Values in order of falling probability (larger value first on ties) until they cover the percentage."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("n"))
    order = counts.withColumns({"_p": -F.col("n"), "_v": -F.col(value)})
    cum = scan(order, [], ["_p", "_v"], {"_c": ("sum", "n")})
    total = counts.agg(F.sum("n")).scalar()
    return cum.filter((F.col("_c") - F.col("n")) < total * (percentage / 100.0)).select(value, "n")


def bayes_update(data: DataFrame, hypotheses: list[float], log_likelihood, prior: list[float] | None = None) -> DataFrame:
    """(hypo, p): posterior over a grid of hypotheses.

    ``data`` holds distinct observations with a count ``n``; each is met by the grid as an array of fixed size
    and summed map-side. ``log_likelihood(hypo, row columns...)`` builds the term from columns.
    """
    prior = prior or [1.0] * len(hypotheses)
    grid = F.array(*[F.struct(F.lit(float(h)).alias("hypo"), F.lit(math.log(w)).alias("lp")) for h, w in zip(hypotheses, prior) if w > 0])
    terms = data.withColumn("_g", F.explode(grid)).select("*", F.col("_g.hypo").alias("hypo"), F.col("_g.lp").alias("_lp"))
    scores = terms.groupBy("hypo").agg((F.sum(F.col("n") * log_likelihood(F.col("hypo"))) + F.max("_lp")).alias("ll"))
    top = with_group_stats(scores, [], {"_top": F.max("ll")})
    return normalize(top.select("hypo", F.exp(F.col("ll") - F.col("_top")).alias("p")))


def odds(p: Column) -> Column:
    """p / (1 - p), infinite at one."""
    return F.when(p == 1, F.lit(float("inf"))).otherwise(p / (1 - p))


def probability(o: Column) -> Column:
    return o / (o + 1)


def probability_from_counts(yes: Column, no: Column) -> Column:
    return F.try_divide(yes, yes + no)


def draw(df: DataFrame, value: str, draws: DataFrame, seed: int) -> DataFrame:
    """(id, value): one draw from the distribution of ``df[value]`` per row of ``draws(id)``, by inverse CDF."""
    cum = cumulative_counts(df.select(value), [], value)
    brackets = cum.select((F.col("cum") - F.col("n")).cast("double").alias("lo"), value)
    total = df.agg(F.count(value)).scalar()
    u = draws.select("id", (uniform(seed, "id") * total).alias("u"))
    return bracket_join(u, "u", brackets, "lo").select("id", value)


def draw_rows(df: DataFrame, ids: str, weight: str, draws: DataFrame, seed: int) -> DataFrame:
    """(id, row): rows drawn with probability proportional to an integer weight column."""
    cum = scan(df.filter(F.col(weight) > 0).select(ids, weight), [], [ids], {"_c": ("sum", weight)})
    brackets = cum.select((F.col("_c") - F.col(weight)).cast("double").alias("lo"), F.col(ids).alias("row"))
    total = df.filter(F.col(weight) > 0).agg(F.sum(weight)).scalar()
    u = draws.select("id", (uniform(seed, "id") * total).alias("u"))
    return bracket_join(u, "u", brackets, "lo").select("id", "row")


def log_choose(n: Column, k: Column) -> Column:
    return ln_gamma(n + 1) - ln_gamma(k + 1) - ln_gamma(n - k + 1)


def density(kind: str, x: Column, **q: Column) -> Column:
    """Density (or probability) of a fitted family at x. Parameters are columns or numbers."""
    c = {k: v if isinstance(v, Column) else F.lit(float(v)) for k, v in q.items()}
    if kind == "normal":
        return F.exp(-0.5 * F.pow((x - c["mu"]) / c["sigma"], 2)) / (c["sigma"] * math.sqrt(2 * math.pi))
    if kind == "lognormal":
        return F.when(x > 0, density("normal", F.ln(F.when(x > 0, x)), **q) / x)
    if kind == "exponential":
        return F.when(x >= 0, c["rate"] * F.exp(-c["rate"] * x)).otherwise(0.0)
    if kind == "poisson":
        return F.exp(x * F.ln(c["mean"]) - c["mean"] - ln_gamma(x + 1))
    if kind == "binomial":
        return F.when(x <= c["n"], F.exp(log_choose(c["n"], x) + x * F.ln(c["p"]) + (c["n"] - x) * F.ln(1 - c["p"]))).otherwise(0.0)
    if kind == "hypergeometric":
        good = (x <= c["good"]) & (x <= c["drawn"]) & (c["drawn"] - x <= c["total"] - c["good"])
        term = log_choose(c["good"], x) + log_choose(c["total"] - c["good"], c["drawn"] - x) - log_choose(c["total"], c["drawn"])
        return F.when(good, F.exp(term)).otherwise(0.0)
    raise ValueError(f"unknown family {kind}")


def cumulative(kind: str, x: Column, **q: Column) -> Column:
    """Distribution function of the normal, lognormal and exponential families."""
    c = {k: v if isinstance(v, Column) else F.lit(float(v)) for k, v in q.items()}
    if kind == "normal":
        return (1 + erf((x - c["mu"]) / (c["sigma"] * math.sqrt(2)))) / 2
    if kind == "lognormal":
        return F.when(x > 0, cumulative("normal", F.ln(F.when(x > 0, x)), **q)).otherwise(0.0)
    if kind == "exponential":
        return F.when(x >= 0, 1 - F.exp(-c["rate"] * x)).otherwise(0.0)
    raise ValueError(f"unknown family {kind}")


def kernel_density(df: DataFrame, value: str, keys: list[str] = (), points: int = 101) -> DataFrame:
    """(keys, x, density): Gaussian kernel estimate with Scott's bandwidth on an even grid over the data's range.

    Each distinct value meets the grid as an array of fixed size; the kernels are summed map-side.
    """
    keys = list(keys)
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))
    n, v = F.sum("n"), F.col(value)
    mean = F.sum(F.col("n") * v) / n
    # Two passes over the counts keep the variance free of cancellation.
    first = with_group_stats(counts, keys, {"_N": n, "_m": mean, "_lo": F.min(v), "_hi": F.max(v)})
    second = with_group_stats(first, keys, {"_ss": F.sum(F.col("n") * F.pow(v - F.col("_m"), 2))})
    h = F.sqrt(F.col("_ss") / (F.col("_N") - 1)) * F.pow(F.col("_N"), F.lit(-0.2))
    steps = F.array(*[F.lit(i) for i in range(points)])
    at = F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("i") / (points - 1)
    kern = second.withColumn("_h", h).withColumn("i", F.explode(steps)).withColumn("x", at)
    term = F.col("n") * F.exp(-0.5 * F.pow((F.col("x") - v) / F.col("_h"), 2))
    return kern.groupBy(*keys, "i").agg(
        F.max("x").alias("x"),
        (F.sum(term) / (F.max("_N") * F.max("_h") * math.sqrt(2 * math.pi))).alias("density")).drop("i")


def normal_plot(df: DataFrame, value: str, ids: list[str]) -> DataFrame:
    """(score, value): sorted data against the quantiles of the standard normal distribution."""
    rows = scan(df.filter(F.col(value).isNotNull()).select(value, *ids), [], [value, *ids], {"_rn": ("row_number",)})
    total = df.agg(F.count(value)).scalar()
    return rows.select(normal_quantile(F.col("_rn") / (total + 1)).alias("score"), value)
