"""User functions over values, columns and partitions; shared intermediates; long loops."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillframe.session import reliable


def map_values(df: DataFrame, cols: list[str], f: Callable[[pd.Series], pd.Series], returns: str) -> DataFrame:
    """An opaque element-wise function, applied to Arrow batches."""
    apply = F.pandas_udf(f, returns)
    return df.withColumns({c: apply(F.col(c)) for c in cols})


def map_partitions(df: DataFrame, schema: str, open_: Callable[[], object],
                   work: Callable[[object, pd.DataFrame], pd.DataFrame], close: Callable[[object], None]) -> DataFrame:
    """A function with one resource per partition, released also when the work fails."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        handle = open_()
        try:
            for pdf in batches:
                yield work(handle, pdf)
        finally:
            close(handle)

    return df.mapInPandas(run, schema)


@contextmanager
def shared(df: DataFrame):
    """A frame kept for several outputs, in memory and on disk, and released afterwards."""
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()


def iterate(df: DataFrame, step: Callable[[DataFrame], DataFrame], times: int, every: int) -> DataFrame:
    """Apply ``step`` many times, cutting the lineage with a checkpoint every few steps."""
    for i in range(1, times + 1):
        df = step(df)
        if i % every == 0:
            df = reliable(df)
    return df
