"""The three binning rules: right-closed cuts, histogram bins, left-closed digits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillframe.plans.ordered import scan


def count_edges(value: Column, edges: list[float], inclusive: bool) -> Column:
    """How many of the sorted edges lie below the value (at or below it when ``inclusive``).

    A balanced tree of comparisons: log2(edges) tests per row, all in generated code.
    """

    def tree(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        passed = value >= edges[mid] if inclusive else value > edges[mid]
        return F.when(passed, tree(mid + 1, hi)).otherwise(tree(lo, mid))

    return F.when(value.isNotNull(), tree(0, len(edges)))


def cut(value: Column, edges: list[float]) -> Column:
    """Bin i of (edges[i], edges[i+1]], from 0; null outside."""
    n = count_edges(value, edges, inclusive=False)
    return F.when((n > 0) & (n < len(edges)), n - 1)


def digitize(value: Column, edges: list[float]) -> Column:
    """Number of edges at or below the value: [a, b) bins, the last edge opens a bin of its own."""
    return count_edges(value, edges, inclusive=True)


def histogram_bin(value: Column, edges: list[float]) -> Column:
    """Bin of [a, b), the last one closed; null outside."""
    n = count_edges(value, edges, inclusive=True)
    return F.when(value == edges[-1], len(edges) - 2).when((n > 0) & (n < len(edges)), n - 1)


def even_edges(lo: float, hi: float, bins: int) -> list[float]:
    return [lo + (hi - lo) * i / bins for i in range(bins)] + [hi]


def bracket_join(df: DataFrame, value: str, brackets: DataFrame, lo: str) -> DataFrame:
    """Attach the bracket with the greatest lower edge at or below the value; none is null.

    Works for any number of brackets: edges and values are merged in one ordered scan, so there is
    neither a broadcast nor a comparison of every value with every edge.
    """
    extra = [c for c in brackets.columns if c != lo]
    edges = brackets.select(F.col(lo).cast("double").alias("_v"), F.lit(0).alias("_side"),
                            F.struct(lo, *extra).alias("_edge"))
    # One scan row per distinct value, however often it occurs.
    values = df.select(F.col(value).cast("double").alias("_v")).filter("_v IS NOT NULL").distinct()
    merged = edges.unionByName(values.withColumn("_side", F.lit(1)), allowMissingColumns=True)
    found = scan(merged, [], ["_v", "_side"], {"_hit": ("last", "_edge")}).filter("_side = 1")
    return (df.join(found.select("_v", "_hit"), F.col(value).cast("double") == F.col("_v"), "left")
            .select(*df.columns, f"_hit.{lo}", *[f"_hit.{c}" for c in extra]))
