"""Random choices that depend only on row identity and seed, so no partitioning changes them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _text(*cols) -> Column:
    return F.concat_ws("-", *[(F.col(c) if isinstance(c, str) else c).cast("string") for c in cols])


def order_key(seed: int, *cols) -> Column:
    """A 32-digit key whose order is a fixed shuffle of the rows."""
    return F.md5(F.concat_ws("-", F.lit(str(seed)), _text(*cols)))


def uniform(seed: int, *cols) -> Column:
    """A number in [0, 1) with 52 random bits."""
    return F.conv(F.substring(order_key(seed, *cols), 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def split_label(seed: int, shares: list[tuple[str, float]], *cols) -> Column:
    """Name of the share a row falls into, e.g. ``[("train", .8), ("test", .2)]``."""
    u, total, out = uniform(seed, *cols), 0.0, None
    for name, share in shares[:-1]:
        total += share
        out = F.when(u < total, name) if out is None else out.when(u < total, name)
    return F.lit(shares[-1][0]) if out is None else out.otherwise(shares[-1][0])
