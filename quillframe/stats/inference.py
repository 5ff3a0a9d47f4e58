"""Moments, correlation, effect size and resampling tests."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillframe.operators.windows import ranks
from quillframe.plans.ordered import cumulative_counts, with_group_stats
from quillframe.plans.quantiles import quantiles

#: Rows of a leaf of the split tree, and the bits of a row's hash that the tree goes by at most.
LEAF_ROWS = 250_000
TREE_BITS = 16


def trimmed(df: DataFrame, keys: list[str], value: str, share: float) -> DataFrame:
    """Mean and population variance after dropping int(share * n) rows from each end; 0 drops none.

    Works on counts: the rows kept of each distinct value follow from its cumulative count.
    """
    rows = cumulative_counts(df.select(*keys, value), keys, value)
    cut = F.floor(F.lit(share) * F.col("total"))
    kept = F.greatest(F.least(F.col("cum"), F.col("total") - cut) - F.greatest(F.col("cum") - F.col("n"), cut), F.lit(0))
    w = rows.select(*keys, F.col(value).alias("_v"), kept.alias("_k"))
    m = with_group_stats(w, keys, {"_m": F.sum(F.col("_k") * F.col("_v")) / F.sum("_k")})
    return m.groupBy(*keys).agg(F.sum("_k").alias("n"), F.max("_m").alias("mean"),
                                (F.sum(F.col("_k") * F.pow(F.col("_v") - F.col("_m"), 2)) / F.sum("_k")).alias("var"))


def moments(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Raw (1-3), central (2, 3) and standardised (3) moments, and Pearson's median skewness."""
    x = F.col(value)
    base = df.filter(x.isNotNull()).select(*keys, x)
    c = with_group_stats(base, keys, {"_m": F.avg(x)})
    d = x - F.col("_m")
    out = c.groupBy(*keys).agg(
        F.max("_m").alias("raw1"), F.avg(F.pow(x, 2)).alias("raw2"), F.avg(F.pow(x, 3)).alias("raw3"),
        F.avg(F.pow(d, 2)).alias("central2"), F.avg(F.pow(d, 3)).alias("central3"))
    out = out.withColumn("skewness", F.col("central3") / F.pow(F.sqrt("central2"), 3))
    med = quantiles(base, keys, value, {"_med": 0.5}, kind="disc")
    both = out.join(med, keys) if keys else out.withColumn("_med", med.scalar())
    return both.withColumn("pearson_skewness", 3 * (F.col("raw1") - F.col("_med")) / F.sqrt("central2")).drop("_med")


def spearman(df: DataFrame, x: str, y: str) -> DataFrame:
    """Correlation of the average ranks."""
    r = ranks(ranks(df.select(x, y).dropna(), x, out="_rx"), y, out="_ry")
    return r.agg(F.corr("_rx", "_ry").alias("spearman"))


def least_squares(df: DataFrame, x: str, y: str, keys: list[str] = ()) -> DataFrame:
    """(keys, slope, intercept, r2)."""
    return df.groupBy(*keys).agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.regr_r2(y, x).alias("r2"))


def residuals(df: DataFrame, x: str, y: str, keys: list[str] = ()) -> DataFrame:
    """The rows with their fitted value and residual; a row with a null key has neither."""
    f = with_group_stats(df, list(keys), {"_b": F.regr_slope(y, x), "_a": F.regr_intercept(y, x)}, keep_null_keys=True)
    fit = F.col("_a") + F.col("_b") * F.col(x)
    return f.withColumn("fitted", fit).withColumn("residual", F.col(y) - fit).drop("_a", "_b")


def cohen_d(df: DataFrame, value: str, side: Column, sample: bool = False) -> DataFrame:
    """Difference of means over the pooled deviation, variances weighted by group size."""
    a, b = F.when(side, F.col(value)), F.when(~side, F.col(value))
    var = F.var_samp if sample else F.var_pop
    pooled = (F.count(a) * var(a) + F.count(b) * var(b)) / (F.count(a) + F.count(b))
    return df.agg(((F.avg(a) - F.avg(b)) / F.sqrt(pooled)).alias("d"))


def overlap_share(df: DataFrame, value: str, control: Column) -> DataFrame:
    """Share of the control above, plus share of the treatment below, the midpoint of the two means."""
    v = F.col(value)
    mid = df.agg(((F.avg(F.when(control, v)) + F.avg(F.when(~control, v))) / 2)).scalar()
    return df.select(v, control.alias("_c"), mid.alias("_m")).agg(
        (F.count_if(F.col("_c") & (v > F.col("_m"))) / F.count_if(F.col("_c"))
         + F.count_if(~F.col("_c") & (v < F.col("_m"))) / F.count_if(~F.col("_c"))).alias("overlap"))


@dataclass(frozen=True)
class Statistic:
    """A statistic of a resample that adds up over parts of it.

    ``parts(values, times)`` gives numbers for some values and how often each was drawn; ``whole(sums)`` makes the statistic
    from their sums over all parts.
    """

    name: str
    parts: Callable[[np.ndarray, np.ndarray], np.ndarray]
    whole: Callable[[np.ndarray], float]


def _moments(v: np.ndarray, t: np.ndarray) -> np.ndarray:
    return np.array([t.sum(), (v * t).sum(), (v * v * t).sum()], dtype="float64")


def _deviation(s: np.ndarray) -> float:
    return math.sqrt(max(s[2] / s[0] - (s[1] / s[0]) ** 2, 0.0)) if s[0] else math.nan


MEAN = Statistic("mean", _moments, lambda s: s[1] / s[0] if s[0] else math.nan)
STD = Statistic("std", _moments, _deviation)
CV = Statistic("cv", _moments, lambda s: _deviation(s) / (s[1] / s[0]) if s[0] and s[1] else math.nan)


def quantile_statistic(df: DataFrame, value: str, p: float, cells: int = 512, name: str | None = None) -> Statistic:
    """The p-quantile (first value x with F(x) >= p) of a resample, from counts between values of the data.

    Exact where the data have at most ``cells`` distinct values; otherwise the values are those of a sketch at ``cells`` even
    ranks, and the result is within about 1 / cells of the ranks.
    """
    x = df.select(F.col(value).cast("double").alias("_v")).filter("_v IS NOT NULL")
    found = [r[0] for r in x.distinct().limit(cells + 1).collect()]  # cells + 1 values at most
    if len(found) > cells:
        grid = ", ".join(f"{i / cells}D" for i in range(cells + 1))
        sketch = x.agg(F.kll_sketch_agg_double("_v", F.lit(4 * cells)).alias("s"))
        found = sketch.select(F.expr(f"kll_sketch_get_quantile_double(s, array({grid}))").alias("q")).first()["q"]
    edges = np.unique(np.array(found, dtype="float64"))

    def parts(v: np.ndarray, t: np.ndarray) -> np.ndarray:
        return np.bincount(np.searchsorted(edges, v), weights=t, minlength=len(edges) + 1)[: len(edges) + 1]

    def whole(s: np.ndarray) -> float:
        total = np.cumsum(s)
        return float(edges[min(int(np.searchsorted(total, max(p * total[-1], 1e-9))), len(edges) - 1)]) if len(edges) and total[-1] else math.nan

    return Statistic(name or f"q{p:g}", parts, whole)


class SplitTree:
    """Counts of rows by the leading bits of their hash, and draws that go down the tree to a leaf.

    How many of a node's draws fall to its left half is drawn from the node's own seed, so every leaf, in whatever task,
    sees the same split, and no table of draws exists anywhere.
    """

    def __init__(self, counts: dict[int, int]):
        level = np.zeros(1 << TREE_BITS, dtype="int64")
        for node, n in counts.items():
            level[node] = n
        self.levels = [level]
        while len(self.levels[0]) > 1:
            self.levels.insert(0, self.levels[0].reshape(-1, 2).sum(1))
        #: A leaf's rows fit a task; the rule is the same for every table.
        self.depth = next((d for d, x in enumerate(self.levels) if x.max() <= LEAF_ROWS), TREE_BITS)

    def drawn(self, leaf: int, k: int, seed: int, iteration: int, replace: bool) -> int:
        """How many of the ``k`` draws of all rows fall into a leaf."""
        for d in range(self.depth):
            node = leaf >> (self.depth - d)
            left, right = (int(x) for x in self.levels[d + 1][2 * node : 2 * node + 2])
            rng = np.random.default_rng([seed, iteration, d, node])
            first = _split(rng, left, right, k, replace)
            k = k - first if leaf >> (self.depth - d - 1) & 1 else first
        return k


def _split(rng: np.random.Generator, left: int, right: int, k: int, replace: bool) -> int:
    if not k or not left + right:
        return 0
    if replace:
        return int(rng.binomial(k, left / (left + right)))
    if left + right < 1_000_000_000:  # the generator's own bound; beyond it the limit law errs by less than one draw in its deviation
        return int(rng.hypergeometric(left, right, k))
    n = left + right
    sd = math.sqrt(k * (left / n) * (right / n) * ((n - k) / (n - 1)))
    return int(min(max(round(rng.normal(k * left / n, sd)), k - right, 0), left, k))


def resampled(df: DataFrame, value: str, ids: list[str], iterations: int, statistics: list[Statistic], seed: int = 0,
              side: Column | None = None) -> DataFrame:
    """(iter, statistic, first, rest) of seeded resamples.

    Without ``side`` each iteration from 1 is a bootstrap, a resample of full size with replacement: ``first`` is its statistic,
    ``rest`` null. With it the rows are split anew into groups of the sizes that ``side`` has, ``first`` and ``rest`` being
    the statistics of the two. Iteration 0 is the data as they are. Rows are told apart by ``ids``; null values take no part.
    Draws depend on ids and seed alone, not on partitions; a task holds one leaf of the split tree at a time.
    """
    group = F.lit(1) if side is None else side.cast("int")
    rows = df.select(F.col(value).cast("double").alias("_v"), group.alias("_g"), *ids).filter("_v IS NOT NULL AND _g IS NOT NULL")
    rows = rows.withColumn("_node", F.shiftrightunsigned(F.xxhash64(*ids), 64 - TREE_BITS))
    counted = rows.groupBy("_node").agg(F.count(F.lit(1)).alias("n"), F.sum("_g").alias("k")).collect()  # 2 ** TREE_BITS rows at most
    tree = SplitTree({r["_node"]: r["n"] for r in counted})
    wanted = sum(r["k"] for r in counted)
    replace = side is None

    def leaf(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        node, pdf = int(key[0]), pdf.sort_values(ids)
        v, own, out = pdf["_v"].to_numpy(), pdf["_g"].to_numpy(dtype="float64"), []
        for i in range(iterations + 1):
            if i:
                k = tree.drawn(node, wanted, seed, i, replace)
                rng = np.random.default_rng([seed, i, TREE_BITS + 1, node])
                if replace:
                    own = np.bincount(rng.integers(0, len(v), k), minlength=len(v)).astype("float64")
                else:
                    own = np.zeros(len(v))
                    own[rng.permutation(len(v))[:k]] = 1.0
            for s, stat in enumerate(statistics):
                for which, times in enumerate([own] if replace else [own, 1.0 - own]):
                    sums = stat.parts(v, times)
                    used = np.flatnonzero(sums)
                    out.append((i, s, which, [int(u) for u in used], [float(x) for x in sums[used]], len(sums)))
        return pd.DataFrame(out, columns=["iter", "stat", "which", "at", "sums", "size"])

    shift = TREE_BITS - tree.depth
    sums = (rows.withColumn("_leaf", F.shiftrightunsigned("_node", shift)).groupBy("_leaf")
            .applyInPandas(leaf, "iter int, stat int, which int, at array<int>, sums array<double>, size int"))
    cells = sums.select("iter", "stat", "which", "size", F.explode(F.arrays_zip("at", "sums")).alias("c")).select("iter", "stat", "which", "size", "c.at", "c.sums")
    added = cells.groupBy("iter", "stat", "which", "size", "at").agg(F.sum("sums").alias("s"))
    packed = added.groupBy("iter", "stat", "which", "size").agg(F.collect_list(F.struct("at", "s")).alias("cells"))  # a statistic's own parts

    def finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = []
            for stat, size, cells_ in zip(pdf["stat"], pdf["size"], pdf["cells"]):
                whole = np.zeros(size)
                for c in cells_:
                    whole[c["at"]] = c["s"]
                got.append(statistics[stat].whole(whole))
            yield pd.DataFrame({"iter": pdf["iter"], "statistic": [statistics[s].name for s in pdf["stat"]], "which": pdf["which"], "x": np.array(got, dtype="float64")})

    done = packed.mapInPandas(finish, "iter int, statistic string, which int, x double")
    return done.groupBy("iter", "statistic").agg(F.max(F.when(F.col("which") == 0, F.col("x"))).alias("first"), F.max(F.when(F.col("which") == 1, F.col("x"))).alias("rest"))


def permutation_shares(df: DataFrame, value: str, side: Column, ids: list[str], iterations: int, statistics: list[Statistic], seed: int = 0,
                       absolute: bool = True) -> DataFrame:
    """(statistic, difference, p): the observed difference of the two groups, and the share of re-splits at least as large."""
    diff = F.col("first") - F.col("rest")
    d = resampled(df, value, ids, iterations, statistics, seed, side).select("iter", "statistic", (F.abs(diff) if absolute else diff).alias("d"))
    seen = d.filter("iter = 0").select("statistic", F.col("d").alias("difference"))
    return (d.filter("iter > 0").join(seen, "statistic").groupBy("statistic")
            .agg(F.max("difference").alias("difference"), F.avg((F.col("d") >= F.col("difference")).cast("double")).alias("p")))


def permutation_test(df: DataFrame, value: str, side: Column, ids: list[str], iterations: int, seed: int = 0) -> DataFrame:
    """Observed difference in means (absolute) and in deviations, with the share of re-splits at least as large."""
    diff = F.col("first") - F.col("rest")
    d = (resampled(df, value, ids, iterations, [MEAN, STD], seed, side)
         .select("iter", "statistic", F.when(F.col("statistic") == "mean", F.abs(diff)).otherwise(diff).alias("d")))
    wide = d.groupBy("iter").pivot("statistic", ["mean", "std"]).agg(F.max("d"))
    seen = wide.filter("iter = 0").select(F.struct("mean", "std")).scalar()
    return wide.withColumns({"_m": seen["mean"], "_s": seen["std"]}).filter("iter > 0").agg(
        F.max("_m").alias("mean_diff"), F.avg((F.col("mean") >= F.col("_m")).cast("double")).alias("mean_p"),
        F.max("_s").alias("std_diff"), F.avg((F.col("std") >= F.col("_s")).cast("double")).alias("std_p"))


def bootstrap_stats(df: DataFrame, value: str, ids: list[str], iterations: int, seed: int = 0, statistics: list[Statistic] | None = None) -> DataFrame:
    """(iter, one column per statistic) of resamples of full size with replacement; mean, std and cv unless others are given."""
    stats = statistics or [MEAN, STD, CV]
    return (resampled(df, value, ids, iterations, stats, seed).filter("iter > 0")
            .groupBy("iter").pivot("statistic", [s.name for s in stats]).agg(F.max("first")))


def bootstrap_summary(stats: DataFrame, cols: list[str], percentage: float = 90.0) -> DataFrame:
    """(statistic, estimate, se, low, high) over the iterations, of which there are a few thousand at most."""
    tail = (100 - percentage) / 200
    long = stats.unpivot([], cols, "statistic", "v")
    return long.groupBy("statistic").agg(
        F.avg("v").alias("estimate"), F.stddev_pop("v").alias("se"), F.percentile("v", F.lit(tail)).alias("low"), F.percentile("v", F.lit(1 - tail)).alias("high"))
