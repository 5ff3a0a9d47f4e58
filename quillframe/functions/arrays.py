"""Array and map expressions with list and dictionary semantics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def slice_step(c: Column, start: int | None = None, stop: int | None = None, step: int = 1) -> Column:
    """seq[start:stop:step], negative positions counted from the end, positive steps."""
    n = F.size(c)

    def at(i: int) -> Column:
        return F.lit(i) if i >= 0 else n + i

    lo = at(start) if start is not None else F.lit(0)
    hi = at(stop) if stop is not None else n
    lo = F.greatest(lo, F.lit(0))
    return F.filter(c, lambda _x, i: (i >= lo) & (i < hi) & ((i - lo) % step == 0))


def remove_first(c: Column, value) -> Column:
    """Without the first occurrence of ``value``."""
    pos = F.array_position(c, value).cast("int")
    return F.when(pos > 0, F.concat(F.slice(c, 1, F.greatest(pos - 1, F.lit(0))), F.slice(c, pos + 1, F.size(c)))).otherwise(c)


def pop_last(c: Column) -> Column:
    return F.slice(c, 1, F.greatest(F.size(c) - 1, F.lit(0)))


def insertion_point(c: Column, value) -> Column:
    """Position right of equal values in a sorted array."""
    return F.size(F.filter(c, lambda x: x <= value))


def get(m: Column, key, default) -> Column:
    return F.coalesce(F.try_element_at(m, F.lit(key)), F.lit(default))


def update(m: Column, other: Column) -> Column:
    """Entries of both maps, the second winning."""
    kept = F.map_filter(m, lambda k, _v: ~F.array_contains(F.map_keys(other), k))
    return F.map_concat(kept, other)


def delete(m: Column, key) -> Column:
    return F.map_filter(m, lambda k, _v: k != key)


def unzip(pairs: Column, field: str) -> Column:
    """One field of every struct in an array."""
    return F.transform(pairs, lambda p: p[field])


def matrix(c: Column, width: int) -> Column:
    """Rows of ``width`` elements, the last one shorter if elements are left over."""
    rows = F.ceil(F.size(c) / width).cast("int")
    whole = F.transform(F.sequence(F.lit(0), rows - 1), lambda i: F.slice(c, i * width + 1, F.lit(width)))
    return F.when(F.size(c) > 0, whole).when(c.isNotNull(), F.slice(F.array(c), 1, 0))


def transposed(m: Column, width: int) -> Column:
    """Columns of a matrix of rows of ``width`` elements as rows; null where a row is too short."""
    return F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda i: F.transform(m, lambda row: F.get(row, i)))
