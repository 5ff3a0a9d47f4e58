"""Pairwise work between two tables in blocks of bounded size.

Both sides are cut into blocks by row count; every pair of blocks is one group, small enough for a
task whatever the data looks like, and the function applied to it returns an already reduced result
rather than the pairs themselves.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_ROWS = 4096


def block_pairs(
    left: DataFrame,
    right: DataFrame,
    left_id: list[str],
    right_id: list[str],
    reduce_pair: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame],
    schema: str,
    rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Apply ``reduce_pair`` to every (left block, right block) and return its rows together."""
    nl = max(1, math.ceil(left.count() / rows))
    nr = max(1, math.ceil(right.count() / rows))
    lb = left.withColumn("_lb", F.pmod(F.xxhash64(*left_id), F.lit(nl)).cast("int")).withColumn(
        "_rb", F.explode(F.sequence(F.lit(0), F.lit(nr - 1))))
    rb = right.withColumn("_rb", F.pmod(F.xxhash64(*right_id), F.lit(nr)).cast("int")).withColumn(
        "_lb", F.explode(F.sequence(F.lit(0), F.lit(nl - 1))))
    return lb.groupBy("_lb", "_rb").cogroup(rb.groupBy("_lb", "_rb")).applyInPandas(reduce_pair, schema)
