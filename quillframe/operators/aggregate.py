"""Group aggregates, pivots, cross-tabulations, histograms."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillframe.operators.binning import even_edges, histogram_bin
from quillframe.plans.ordered import scan, with_group_stats
from quillframe.plans.quantiles import quantile_edges, quantiles


def describe(df: DataFrame, keys: list[str], col: str) -> DataFrame:
    """count, mean, std (n - 1), min, exact quartiles, max; per group when keys are given."""
    rows = df.dropna(subset=keys) if keys else df
    plain = rows.groupBy(*keys).agg(
        F.count(col).alias("count"), F.avg(col).alias("mean"), F.stddev_samp(col).alias("std"),
        F.min(col).alias("min"), F.max(col).alias("max"))
    quartiles = quantiles(df, keys, col, {"q25": 0.25, "q50": 0.5, "q75": 0.75})
    if keys:
        return plain.join(quartiles, keys)
    names = ["q25", "q50", "q75"]
    return plain.withColumn("_q", quartiles.select(F.struct(*names)).scalar()).select(*plain.columns, *[F.col("_q")[n].alias(n) for n in names])


def mean_absolute_deviation(df: DataFrame, col: str) -> DataFrame:
    mean = df.agg(F.avg(col)).scalar()
    return df.select(F.abs(F.col(col) - mean).alias("d")).agg(F.avg("d").alias("mad"))


def keep_groups(df: DataFrame, keys: list[str], agg: Column, test) -> DataFrame:
    """Rows of the groups whose aggregate passes; HAVING that keeps the rows."""
    good = df.groupBy(*keys).agg(agg.alias("_a")).filter(test(F.col("_a"))).select(*keys)
    return df.join(good, keys, "left_semi")


def transform_groups(df: DataFrame, keys: list[str], stats: dict[str, Column], outs: dict[str, Column]) -> DataFrame:
    """Columns computed from a row and the statistics of its group; a row with a null key stays, its group unknown."""
    return with_group_stats(df, keys, stats, keep_null_keys=True).withColumns(outs).drop(*stats)


def pivot(df: DataFrame, index: list[str], column: str, levels: list, aggs: dict[str, Column], fill=None) -> DataFrame:
    """Wide table; with one aggregate the columns are the levels, with several level_name."""
    exprs = [e.alias(n) for n, e in aggs.items()]
    out = df.dropna(subset=[*index, column]).groupBy(*index).pivot(column, levels).agg(*exprs)
    return out if fill is None else out.fillna(fill)


def pivot_margins(df: DataFrame, index: str, column: str, levels: list, agg: Column, total: str = "All") -> DataFrame:
    """Pivot with an ``All`` row and column taken from the raw rows."""
    cube = (df.dropna(subset=[index, column]).cube(index, column)
            .agg(agg.alias("_v"), F.grouping(index).alias("_gi"), F.grouping(column).alias("_gc")))
    cells = cube.select(
        F.when(F.col("_gi") == 1, total).otherwise(F.col(index).cast("string")).alias(index),
        F.when(F.col("_gc") == 1, total).otherwise(F.col(column).cast("string")).alias(column), "_v")
    return cells.groupBy(index).pivot(column, [*[str(x) for x in levels], total]).agg(F.first("_v"))


def crosstab(df: DataFrame, a: str, b: str, levels: list) -> DataFrame:
    return pivot(df, [a], b, levels, {"n": F.count(F.lit(1))}, fill=0)


def crosstab_shares(df: DataFrame, a: str, b: str) -> DataFrame:
    """(a, b, share): share of b within each a."""
    n = df.dropna(subset=[a, b]).groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))
    total = n.groupBy(a).agg(F.sum("n").alias("t"))
    return n.join(total, a).select(a, b, (F.col("n") / F.col("t")).alias("share"))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    return (df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), col))


def sigma_clip(df: DataFrame, col: str, width: float = 5.0) -> DataFrame:
    """Rows within median +- width * 0.74 * interquartile range."""
    q25, q50, q75 = quantile_edges(df, col, [0.25, 0.5, 0.75])
    if q50 is None:
        return df.limit(0)
    sigma = 0.74 * (q75 - q25)
    return df.filter((F.col(col) > q50 - width * sigma) & (F.col(col) < q50 + width * sigma))


def grouped_values(df: DataFrame, key: str, value: str, chunk: int = 10_000) -> DataFrame:
    """(key, chunk, n, values): the distinct values of each key in sorted order, in arrays of bounded size.

    A key with more than ``chunk`` values continues in further rows, so no group is held whole.
    """
    distinct = df.select(key, value).dropna().distinct()
    numbered = scan(distinct, [key], [value], {"_rn": ("row_number",)})
    part = F.floor((F.col("_rn") - 1) / chunk)
    return (numbered.groupBy(key, part.alias("chunk"))
            .agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list(value)).alias("values")))


def typed_counts(df: DataFrame, rules: list[tuple[str, Column]]) -> DataFrame:
    """One count per rule, the first matching rule taking the row."""
    taken, outs = F.lit(False), []
    for name, test in rules:
        hit = F.coalesce(test, F.lit(False))
        outs.append(F.count_if(hit & ~taken).alias(name))
        taken = taken | hit
    return df.agg(*outs)


def value_range(df: DataFrame, col: str) -> tuple[float, float]:
    r = df.agg(F.min(col), F.max(col)).first()
    return r[0], r[1]


def histogram(df: DataFrame, col: str, edges: list[float], keys: list[str] = ()) -> DataFrame:
    """(keys, bin, lo, hi, n) with empty bins kept; values outside the edges are not counted."""
    keys, spark = list(keys), df.sparkSession
    b = histogram_bin(F.col(col), edges).alias("bin")
    counts = df.groupBy(*keys, b).agg(F.count(F.lit(1)).alias("n")).filter("bin IS NOT NULL")
    frame = spark.range(len(edges) - 1).select(
        F.col("id").cast("int").alias("bin"),
        F.array(*[F.lit(float(e)) for e in edges])[F.col("id").cast("int")].alias("lo"),
        F.array(*[F.lit(float(e)) for e in edges])[F.col("id").cast("int") + 1].alias("hi"))
    if not keys:
        return frame.join(counts, "bin", "left").fillna({"n": 0})
    bins = F.array(*[F.lit(i) for i in range(len(edges) - 1)])
    grid = counts.select(*keys).distinct().withColumn("bin", F.explode(bins))
    return grid.join(frame, "bin").join(counts, [*keys, "bin"], "left").fillna({"n": 0})


def density(hist: DataFrame, keys: list[str] = ()) -> DataFrame:
    """n / (N * width), N per key (over all bins without keys)."""
    keys = list(keys)
    out = with_group_stats(hist, keys, {"_N": F.sum("n")})
    return out.withColumn("density", F.col("n") / (F.col("_N") * (F.col("hi") - F.col("lo")))).drop("_N")


def histogram_2d(df: DataFrame, x: str, y: str, xe: list[float], ye: list[float]) -> DataFrame:
    """(x_bin, y_bin, n) for the cells that hold rows."""
    return (df.groupBy(histogram_bin(F.col(x), xe).alias("x_bin"), histogram_bin(F.col(y), ye).alias("y_bin"))
            .agg(F.count(F.lit(1)).alias("n")).dropna())


def hexbin(df: DataFrame, x: str, y: str, gridsize: int, xr: tuple[float, float], yr: tuple[float, float]) -> DataFrame:
    """(hx, hy, n): counts on a hexagonal lattice of ``gridsize`` columns over the given ranges.

    Two rectangular lattices half a step apart; the nearer centre takes the point.
    """
    ny = int(gridsize / math.sqrt(3))
    u = (F.col(x) - xr[0]) * gridsize / (xr[1] - xr[0])
    v = (F.col(y) - yr[0]) * ny / (yr[1] - yr[0])
    p = df.dropna(subset=[x, y]).select(u.alias("u"), v.alias("v"))
    ax, ay, bx, by = F.floor(F.col("u") + 0.5), F.floor(F.col("v") + 0.5), F.floor("u"), F.floor("v")
    da = F.pow(F.col("u") - ax, 2) + 3 * F.pow(F.col("v") - ay, 2)
    db = F.pow(F.col("u") - bx - 0.5, 2) + 3 * F.pow(F.col("v") - by - 0.5, 2)
    first = da < db
    cell = p.select(F.when(first, ax.cast("double")).otherwise(bx + 0.5).alias("hx"),
                    F.when(first, ay.cast("double")).otherwise(by + 0.5).alias("hy"))
    return cell.groupBy("hx", "hy").agg(F.count(F.lit(1)).alias("n"))


def frequency_extremes(df: DataFrame, value: str, n: int) -> DataFrame:
    """(side, value, n): the n smallest and n largest values with their counts."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("n"))
    low = counts.orderBy(value).limit(n).select(F.lit("smallest").alias("side"), "*")
    return low.unionAll(counts.orderBy(F.desc(value)).limit(n).select(F.lit("largest").alias("side"), "*"))


def rate_model(train: DataFrame, keys: list[str], label: str, cutoff: float = 0.5) -> DataFrame:
    """(keys, prediction): 1 where the mean label of the cell reaches the cutoff."""
    return train.groupBy(*keys).agg((F.avg(label) >= cutoff).cast("int").alias("prediction"))


def apply_rate_model(rows: DataFrame, model: DataFrame, keys: list[str], default: int = 0) -> DataFrame:
    return rows.join(model, keys, "left").fillna({"prediction": default})


def five_numbers(df: DataFrame, keys: list[str], col: str) -> DataFrame:
    return quantiles(df, keys, col, {"min": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "max": 1.0})


def multi_hot(df: DataFrame, id_cols: list[str], col: str, sep: str, tokens: list[str]) -> DataFrame:
    """One 0/1 column per token of a delimited string."""
    parts = F.split(F.col(col), sep)
    return df.select(*id_cols, *[F.array_contains(parts, w).cast("int").alias(w) for w in tokens])


def keyword_flags(df: DataFrame, col: str, words: list[str], case_sensitive: bool = False) -> DataFrame:
    text = F.col(col) if case_sensitive else F.lower(col)
    return df.withColumns({w: text.contains(w if case_sensitive else w.lower()) for w in words})


def bins_of(df: DataFrame, col: str, bins: int) -> list[float]:
    """Edges of ``bins`` even bins over the observed range."""
    return even_edges(*map(float, value_range(df, col)), bins)
