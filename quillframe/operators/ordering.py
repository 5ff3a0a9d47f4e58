"""Sorting, top-k, sampling, shuffling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillframe.plans.ordered import scan
from quillframe.plans.seeded import order_key


def sort_values(df: DataFrame, by: list[str], ascending: bool = True) -> DataFrame:
    """Sort with nulls last in both directions."""
    return df.orderBy(*[F.asc_nulls_last(c) if ascending else F.desc_nulls_last(c) for c in by])


def sort_columns(df: DataFrame, ascending: bool = True) -> DataFrame:
    return df.select(*sorted(df.columns, reverse=not ascending))


def arg_sort(df: DataFrame, by: list[str], out: str = "position") -> DataFrame:
    """0-based position each row would take in the given order."""
    return scan(df, [], by, {out: ("row_number",)}).withColumn(out, F.col(out) - 1)


def nulls_last(by: list[str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in by]


def smallest(df: DataFrame, by: list[str], k: int) -> DataFrame:
    """The k smallest rows: a bounded heap per task, no full sort."""
    return df.orderBy(*nulls_last(by)).limit(k)


def smallest_per_group(df: DataFrame, keys: list[str], by: list[str], k: int) -> DataFrame:
    """The k smallest rows of each group; Spark cuts each task's rows of a group to k before the shuffle."""
    order = Window.partitionBy(*keys).orderBy(*nulls_last(by))
    return df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def sample(df: DataFrame, ids: list[str], n: int, seed: int = 0) -> DataFrame:
    """n rows without replacement, the same ones however the data is partitioned."""
    return df.withColumn("_k", order_key(seed, *ids)).orderBy("_k", *ids).limit(n).drop("_k")


def shuffle(df: DataFrame, ids: list[str], seed: int = 0, out: str = "position") -> DataFrame:
    """A permutation: every row with its 0-based place in the shuffled order."""
    return arg_sort(df.withColumn("_k", order_key(seed, *ids)), ["_k", *ids], out).drop("_k")
