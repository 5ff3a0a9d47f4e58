"""Ranks, rolling windows, shifts, running totals and runs."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillframe.plans.ordered import cumulative_counts, scan


def ranks(df: DataFrame, col: str, keys: list[str] = (), method: str = "average", ascending: bool = True,
          out: str = "rank") -> DataFrame:
    """Rank of every row among its group; ties share the mean, minimum or maximum rank, or a dense one.

    Rank depends on the value alone, so it is worked out once per distinct value and joined back.
    A null value has no rank.
    """
    keys = list(keys)
    cum = cumulative_counts(df.select(*keys, col), keys, col)
    if not ascending:
        cum = cum.withColumn("cum", F.col("total") - F.col("cum") + F.col("n"))
    if method == "dense":
        order = [col]
        if not ascending:
            raise ValueError("dense ranks are ascending")
        cum = scan(cum.select(*keys, col), keys, order, {"_rank": ("row_number",)})
    else:
        c, n = F.col("cum"), F.col("n")
        rank = {"average": c - (n - 1) / 2, "max": c, "min": c - n + 1}[method]
        cum = cum.select(*keys, col, rank.alias("_rank"))
    return df.join(cum, [*keys, col], "left").select(*df.columns, F.col("_rank").alias(out))


def first_come_ranks(df: DataFrame, col: str, position: list[str], keys: list[str] = (), out: str = "rank") -> DataFrame:
    """Ties ranked by position: 1..n without gaps; a null has no rank."""
    ranked = scan(df.where(F.col(col).isNotNull()), list(keys), [col, *position], {out: ("row_number",)})
    rest = df.where(F.col(col).isNull()).withColumn(out, F.lit(None).cast(ranked.schema[out].dataType))
    return ranked.unionByName(rest.select(ranked.columns))


def rank_across(cols: list[str]) -> list[Column]:
    """Average rank of each cell among the cells of its row."""
    cells = F.array(*[F.col(c).cast("double") for c in cols])

    def rank(c: str) -> Column:
        x = F.col(c).cast("double")
        below = F.size(F.filter(cells, lambda v: v < x))
        ties = F.size(F.filter(cells, lambda v: v == x))
        return (below + (ties + 1) / 2).alias(f"{c}_rank")

    return [rank(c) for c in cols]


def rolling(series: DataFrame, order: str, col: str, aggs: dict[str, Column], before: int, after: int) -> DataFrame:
    """Rolling aggregates of a column of a calendar series (one row per day or hour), null until the window is full of values.

    The input is a series already reduced to calendar steps, so its length is bounded by time, not by rows.
    """
    w = Window.orderBy(order).rowsBetween(-before, after)
    full = F.count(col).over(w) == before + after + 1
    return series.withColumns({name: F.when(full, agg.over(w)) for name, agg in aggs.items()})


def centred(size: int) -> tuple[int, int]:
    """Rows before and after for a centred window; an even one reaches one further back."""
    return size // 2, size - 1 - size // 2


def gaussian_rolling(series: DataFrame, order: str, col: str, size: int, std: float, out: str) -> DataFrame:
    """Centred rolling sum with Gaussian weights, null until the window is full. Calendar series as above."""
    before, after = centred(size)
    mid = (size - 1) / 2
    weights = [math.exp(-0.5 * ((i - mid) / std) ** 2) for i in range(size)]
    w = Window.orderBy(order).rowsBetween(-before, after)
    vals = F.collect_list(F.coalesce(F.col(col), F.lit(float("nan")))).over(w)
    weighted = F.zip_with(vals, F.array(*[F.lit(x) for x in weights]), lambda a, b: a * b)
    total = F.aggregate(weighted, F.lit(0.0), lambda a, x: a + x)
    return series.withColumn(out, F.when(F.size(vals) == size, total))


def shift(series: DataFrame, order: str, col: str, steps: int, out: str) -> DataFrame:
    """Value ``steps`` rows earlier (later when negative) of a calendar series."""
    return series.withColumn(out, F.lag(col, steps).over(Window.orderBy(order)))


def running(df: DataFrame, keys: list[str], order: list[str], sums: dict[str, str], products: dict[str, str] | None = None) -> DataFrame:
    """Running sums and products (output name -> column) in one scan.

    A product is sign * exp(sum of logs); a zero makes every later product zero.
    """
    products = products or {}
    adds: dict[str, tuple] = {out: ("sum", F.col(c)) for out, c in sums.items()}
    for out, c in products.items():
        x = F.col(c)
        adds |= {f"_log_{out}": ("sum", F.when(x != 0, F.ln(F.abs(x)))), f"_neg_{out}": ("sum", F.when(x < 0, 1).otherwise(0)),
                 f"_zero_{out}": ("sum", F.when(x == 0, 1).otherwise(0))}
    rows = scan(df, keys, order, adds)
    for out in products:
        sign = F.when(F.col(f"_neg_{out}") % 2 == 0, 1.0).otherwise(-1.0)
        size = F.exp(F.coalesce(f"_log_{out}", F.lit(0.0)))
        rows = rows.withColumn(out, F.when(F.col(f"_zero_{out}") > 0, 0.0).otherwise(sign * size)).drop(
            f"_log_{out}", f"_neg_{out}", f"_zero_{out}")
    return rows


def enumerate_rows(df: DataFrame, order: list[str], out: str = "i") -> DataFrame:
    """0-based position in the given unique order."""
    return scan(df, [], order, {out: ("row_number",)}).withColumn(out, F.col(out) - 1)


def zip_rows(left: DataFrame, left_order: list[str], right: DataFrame, right_order: list[str]) -> DataFrame:
    """Rows of two frames paired by position, as far as the shorter one goes."""
    return enumerate_rows(left, left_order, "_i").join(enumerate_rows(right, right_order, "_i"), "_i").drop("_i")


def seen_before(df: DataFrame, value: list[str], order: list[str], out: str = "seen") -> DataFrame:
    """True for every row whose value occurred earlier; the first one is found by a map-side minimum."""
    first = df.groupBy(*(F.col(c).alias(f"_v{i}") for i, c in enumerate(value))).agg(F.min(F.struct(*order)).alias("_first"))
    same = [F.col(c).eqNullSafe(F.col(f"_v{i}")) for i, c in enumerate(value)]  # a null occurs like any other value
    return df.join(first, same).withColumn(out, F.struct(*order) > F.col("_first")).drop("_first", *(f"_v{i}" for i in range(len(value))))


def runs(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """(keys, run, value, n, first, last): consecutive rows of equal value, numbered from 1."""
    marked = scan(df.select(*keys, *order, value), keys, order, {"_prev": ("lag", value), "_rn": ("row_number",)})
    change = F.when((F.col("_rn") == 1) | ~F.col("_prev").eqNullSafe(F.col(value)), 1).otherwise(0)
    numbered = scan(marked.select(*keys, *order, value, change.alias("_change")), keys, order, {"run": ("sum", "_change")})
    return numbered.groupBy(*keys, "run", value).agg(
        F.count(F.lit(1)).alias("n"), F.min(order[0]).alias("first"), F.max(order[0]).alias("last"))
