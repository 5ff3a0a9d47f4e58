"""Joins with the naming, null and alignment rules of labelled tables."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK_LEVELS = 5_000


def merge(left: DataFrame, right: DataFrame, on: list[str] | None = None, how: str = "inner",
          suffixes: tuple[str, str] = ("_x", "_y"), null_keys_match: bool = False) -> DataFrame:
    """Join on shared columns by default; other columns of the same name get suffixes."""
    keys = on or [c for c in left.columns if c in right.columns]
    clash = {c for c in left.columns if c in right.columns and c not in keys}
    a = left.withColumnsRenamed({c: c + suffixes[0] for c in clash})
    b = right.withColumnsRenamed({c: c + suffixes[1] for c in clash})
    if not null_keys_match:
        return a.join(b, keys, how)
    b = b.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    joined = a.join(b, reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]), how)
    out = joined.withColumns({k: F.coalesce(k, f"_r_{k}") for k in keys})
    return out.drop(*[f"_r_{k}" for k in keys])


def unmatched_keys(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Distinct keys of ``left`` that ``right`` lacks."""
    return left.select(key).distinct().join(right, key, "left_anti")


def aligned(left: DataFrame, right: DataFrame, key: str, value: str, op, fill: float | Column | None = None) -> DataFrame:
    """``op(left, right)`` per key over the union of keys.

    Without ``fill`` a key one side lacks gives null; with it the lacking side takes the fill value,
    and the result is null only where both values are missing.
    """
    a = left.select(key, F.col(value).alias("_a"))
    b = right.select(key, F.col(value).alias("_b"))
    both = a.join(b, key, "full")
    x, y = F.col("_a"), F.col("_b")
    if fill is None:
        out = op(x, y)
    else:
        f = fill if isinstance(fill, Column) else F.lit(fill)
        out = F.when(x.isNotNull() | y.isNotNull(), op(F.coalesce(x, f), F.coalesce(y, f)))
    return both.select(key, out.alias(value))


def level_grid(df: DataFrame, cols: list[str]) -> DataFrame:
    """Every combination of the distinct values of ``cols``.

    The first column's values stay distributed. A further column's values are cut into chunks of about
    CHUNK_LEVELS, and each row is sent to every chunk by an equi-join.
    """
    grid = df.select(cols[0]).distinct()
    for c in cols[1:]:
        levels = df.select(c).distinct()
        chunks = max(1, math.ceil(levels.count() / CHUNK_LEVELS))
        right = levels.withColumn("_chunk", F.pmod(F.xxhash64(c), F.lit(chunks)))
        left = grid.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(chunks - 1).cast("bigint"))))
        grid = left.join(right, "_chunk").drop("_chunk")
    return grid


def offset_join(df: DataFrame, key: str, value: str, days: int) -> DataFrame:
    """(key, value, earlier): the value ``days`` before, matched on the exact date."""
    past = df.select(F.date_add(key, days).alias(key), F.col(value).alias("earlier"))
    return df.select(key, value).join(past, key, "left")


def overlap(df: DataFrame, part: str, fingerprint: Column) -> DataFrame:
    """(part, other, rows): rows of ``part`` whose fingerprint also occurs in ``other``.

    Works on counts per fingerprint, never on pairs of rows: a text copied a million times is one row.
    """
    counts = df.where(fingerprint.isNotNull()).groupBy(fingerprint.alias("_f"), part).agg(F.count(F.lit(1)).alias("n"))
    # One entry per part, of which there are only a few.
    per = counts.groupBy("_f").agg(F.collect_list(F.struct(F.col(part).alias("p"), "n")).alias("ps"))
    seen = per.select(F.explode("ps").alias("a"), "ps").select("a", F.explode("ps").alias("b"))
    return (seen.filter(F.col("a.p") != F.col("b.p"))
            .groupBy(F.col("a.p").alias(part), F.col("b.p").alias("other")).agg(F.sum("a.n").alias("rows")))
