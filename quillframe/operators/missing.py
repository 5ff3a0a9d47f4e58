"""Missing data: tests, drops, fills, imputation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from quillframe.plans.ordered import scan
from quillframe.plans.quantiles import quantiles


def is_missing(df: DataFrame, col: str) -> Column:
    """Null, or NaN for a float column."""
    c = F.col(col)
    return c.isNull() | F.isnan(c) if isinstance(df.schema[col].dataType, (FloatType, DoubleType)) else c.isNull()


def missing_summary(df: DataFrame) -> DataFrame:
    """(column_name, any_missing, n_missing) in one pass."""
    counts = df.agg(*[F.count_if(is_missing(df, c)).alias(c) for c in df.columns])
    return counts.unpivot([], df.columns, "column_name", "n_missing").select(
        "column_name", (F.col("n_missing") > 0).alias("any_missing"), "n_missing")


def drop_missing_columns(df: DataFrame, how: str = "any") -> DataFrame:
    """Drop columns with any missing value, or only those with nothing else."""
    counts = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(is_missing(df, c)).alias(c) for c in df.columns]).first()
    limit = 0 if how == "any" else max(counts["_n"] - 1, 0)
    return df.select(*[c for c in df.columns if counts[c] <= limit])


def forward_fill(df: DataFrame, keys: list[str], order: list[str], col: str) -> DataFrame:
    """Last value present at or before the row, per series. ``order`` must be unique per series."""
    return scan(df, keys, order, {col: ("last", F.col(col))})


def back_fill(df: DataFrame, keys: list[str], order: list[str], col: str) -> DataFrame:
    """First value present at or after the row, per series."""
    return scan(df, keys, order, {col: ("next", F.col(col))})


def fill_along_row(df: DataFrame, cols: list[str]) -> DataFrame:
    """Each cell takes the nearest value to its left when missing."""
    return df.withColumns({c: F.coalesce(*[F.col(x) for x in reversed(cols[: i + 1])]) for i, c in enumerate(cols)})


def impute_group_median(df: DataFrame, keys: list[str], col: str) -> DataFrame:
    """Fill with the exact median of the row's group; a group without values stays null."""
    med = quantiles(df, keys, col, {"_median": 0.5})
    return df.join(med, keys, "left").withColumn(col, F.coalesce(col, "_median")).drop("_median")


def impute_mode(df: DataFrame, col: str) -> DataFrame:
    """Fill with the most frequent value; the smallest wins a tie."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    best = counts.orderBy(F.desc("n"), col).limit(1).select(col).scalar()
    return df.withColumn(col, F.coalesce(F.col(col), best))


def impute_mean(df: DataFrame, col: str) -> DataFrame:
    return df.withColumn(col, F.coalesce(F.col(col), df.agg(F.avg(col)).scalar()))


def sentinels_to_null(df: DataFrame, col: str, codes: list = (), above: float | None = None) -> DataFrame:
    """Coded non-answers, and values above a limit, become null."""
    c = F.col(col)
    bad = c.isin(list(codes)) if codes else F.lit(False)
    if above is not None:
        bad = bad | (c > above)
    return df.withColumn(col, F.when(~bad, c))


def strict(agg, col: str) -> Column:
    """An aggregate that is null as soon as one input is null."""
    return F.when(F.count_if(F.col(col).isNull()) == 0, agg(col))


def strict_row_sum(cols: list[str]) -> Column:
    return reduce(lambda a, b: a + b, [F.col(c) for c in cols])


def row_sum(cols: list[str]) -> Column:
    return reduce(lambda a, b: a + b, [F.coalesce(F.col(c), F.lit(0)) for c in cols])


def reindex_rows(df: DataFrame, key: str, keys: DataFrame, fill: dict) -> DataFrame:
    """One row per wanted key; absent ones take the fill values."""
    return keys.join(df, key, "left").fillna(fill)
