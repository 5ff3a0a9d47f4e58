"""Concatenation, set algebra on keys and multisets, splitting."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillframe.plans.ordered import scan


def concat_all(*frames: DataFrame) -> DataFrame:
    """Rows of all frames over the union of their columns, absent cells null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def concat_common(*frames: DataFrame) -> DataFrame:
    """Rows of all frames over the columns they share."""
    shared = [c for c in frames[0].columns if all(c in f.columns for f in frames)]
    return reduce(DataFrame.unionByName, [f.select(*shared) for f in frames])


def concat_checked(key: str, *frames: DataFrame) -> DataFrame:
    """Concatenate, failing when a key occurs twice; the check runs inside the same query."""
    rows = concat_all(*frames)
    per_key = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    top = per_key.agg(F.max_by(key, "n").alias("k"), F.max("n").alias("n"))
    verdict = top.select(F.when(F.col("n") > 1, F.raise_error(F.concat(F.lit("duplicate key "), F.col("k").cast("string"))))
                         .otherwise(F.lit(True))).scalar()
    return rows.filter(verdict)


def concat_numbered(key: str, *frames: DataFrame) -> DataFrame:
    """Concatenate with a fresh 0-based row key: frame by frame, each in the order of ``key``."""
    rows = concat_all(*[f.withColumn("_src", F.lit(i)) for i, f in enumerate(frames)])
    return scan(rows, [], ["_src", key], {"row": ("row_number",)}).withColumn("row", F.col("row") - 1).drop("_src")


def concat_labelled(frames: dict[str, DataFrame], label: str = "source") -> DataFrame:
    return concat_all(*[f.select(F.lit(k).alias(label), "*") for k, f in frames.items()])


def symmetric_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.subtract(b).union(b.subtract(a))


def is_subset(a: DataFrame, b: DataFrame, multiset: bool = False) -> DataFrame:
    """One row, ``subset``: whether every row of ``a`` is in ``b`` (as often, for multisets)."""
    left = a.exceptAll(b) if multiset else a.subtract(b)
    return left.agg((F.count(F.lit(1)) == 0).alias("subset"))


def subtract_counts(a: DataFrame, b: DataFrame, value: str) -> DataFrame:
    """(value, n): occurrences in ``a`` minus those in ``b``, negative counts kept."""
    both = a.select(value, F.lit(1).alias("_d")).unionAll(b.select(value, F.lit(-1).alias("_d")))
    return both.groupBy(value).agg(F.sum("_d").alias("n"))


def uniqueness(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column_name, is_unique, duplicates) per column."""
    frames = [df.groupBy(F.col(c).cast("string").alias("k")).agg(F.count(F.lit(1)).alias("n")).agg(
        F.lit(c).alias("column_name"), (F.max("n") == 1).alias("is_unique"),
        F.count_if(F.col("n") > 1).alias("duplicates")) for c in cols]
    return reduce(DataFrame.unionAll, frames)


def split_at(df: DataFrame, order: list[str], cuts: list[int], out: str = "part") -> DataFrame:
    """Number of the piece each row falls into when the ordered frame is cut at the given positions."""
    rows = scan(df, [], order, {"_rn": ("row_number",)})
    part = reduce(lambda a, b: a + b, [((F.col("_rn") - 1) >= c).cast("int") for c in cuts], F.lit(0))
    return rows.withColumn(out, part).drop("_rn")


def column_blocks(df: DataFrame, cuts: list[int]) -> list[DataFrame]:
    edges = [0, *cuts, len(df.columns)]
    return [df.select(*df.columns[a:b]) for a, b in zip(edges, edges[1:])]
