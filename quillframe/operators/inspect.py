"""Looking at a table: column counts, first and last rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def column_counts(df: DataFrame) -> DataFrame:
    """(column_name, non_null, n_rows) from one pass over the table."""
    counts = df.agg(F.count(F.lit(1)).alias("n_rows"), *[F.count(c).alias(c) for c in df.columns])
    return counts.unpivot(["n_rows"], df.columns, "column_name", "non_null").select("column_name", "non_null", "n_rows")


def head(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """The first ``n`` rows; nulls come last."""
    return df.orderBy(*[F.asc_nulls_last(c) for c in order]).limit(n)


def tail(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """The last ``n`` rows in the order of ``head``, so nulls first."""
    return df.orderBy(*[F.desc_nulls_first(c) for c in order]).limit(n)


def head_tail(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """First and last ``n`` rows, told apart by ``part``."""
    return head(df, order, n).select(F.lit("head").alias("part"), "*").unionByName(
        tail(df, order, n).select(F.lit("tail").alias("part"), "*"))
