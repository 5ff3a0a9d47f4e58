"""Ordered scans without a single-task window.

A plain window over a whole table, or over one hot key, runs in one task. Here the rows are
range-partitioned on (keys, order) first, so a hot key spans many partitions; each part is scanned
on its own and a small carry table, at most two rows per partition, brings in what came before
(or after) it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillframe.session import partitions_of, reliable

PART = "_part"
TIE = "_tie"


def range_split(df: DataFrame, by: list[str], parts: int | None = None) -> DataFrame:
    """Rows range-partitioned on ``by`` with their part number fixed by a checkpoint.

    The input position of a row is the last sort key, so that copies of one row, however many, spread
    over several parts too.
    """
    n = parts or partitions_of(df.sparkSession)
    tied = df.withColumn(TIE, F.monotonically_increasing_id())
    return reliable(tied.repartitionByRange(n, *by, TIE).withColumn(PART, F.spark_partition_id()))


def scan(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    adds: dict[str, tuple],
    parts: int | None = None,
) -> DataFrame:
    """Add running columns per ``keys`` in ascending ``order`` (both lists of column names), nulls last.

    ``adds`` maps an output name to one of ``("row_number",)``, ``("sum", col)``, ``("max", col)``,
    ``("total", col)`` (sum over the whole key), ``("last", col)`` and ``("next", col)`` (nearest non-null value at or before / after the row),
    ``("lag", col)`` and ``("lead", col)``. Null keys form a group of their own.
    """
    columns = df.columns
    # Spark puts nulls first, in ranges and in structs; a flag before each column puts them last in all of them.
    flags = {c: f"_null{i}" for i, c in enumerate(order)}
    df = df.withColumns({flag: F.col(c).isNull() for c, flag in flags.items()})
    order = [name for c in order for name in (flags[c], c)]
    split = range_split(df, [*keys, *order], parts)
    chunk = Window.partitionBy(*keys, PART).orderBy(*order, TIE)
    upto = chunk.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after = chunk.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    pos = F.struct(*order, TIE)

    summary: list[Column] = [F.count(F.lit(1)).alias("_n")]
    carry: dict[str, Column] = {}
    series = Window.partitionBy(*keys).orderBy(PART)
    before = series.rowsBetween(Window.unboundedPreceding, -1)
    behind = series.rowsBetween(1, Window.unboundedFollowing)
    local: dict[str, Column] = {}
    final: dict[str, Column] = {}
    for out, (kind, *arg) in adds.items():
        s, c, v = f"_s_{out}", F.col(f"_c_{out}"), F.col(f"_l_{out}")
        if kind == "row_number":
            local[out] = F.row_number().over(chunk).cast("bigint")
            carry[out] = F.sum("_n").over(before)
            final[out] = v + F.coalesce(c, F.lit(0))
            continue
        x = F.col(arg[0]) if isinstance(arg[0], str) else arg[0]
        if kind == "sum":
            local[out] = F.sum(x).over(upto)
            summary.append(F.sum(x).alias(s))
            carry[out] = F.sum(s).over(before)
            final[out] = F.coalesce(v + c, v, c)
        elif kind == "total":
            local[out] = F.sum(x).over(Window.partitionBy(*keys, PART))
            summary.append(F.sum(x).alias(s))
            carry[out] = F.sum(s).over(Window.partitionBy(*keys))
            final[out] = F.coalesce(c, v)
        elif kind == "max":
            local[out] = F.max(x).over(upto)
            summary.append(F.max(x).alias(s))
            carry[out] = F.max(s).over(before)
            final[out] = F.greatest(v, c)
        elif kind == "last":
            local[out] = F.last(x, ignorenulls=True).over(upto)
            summary.append(F.max_by(x, F.when(x.isNotNull(), pos)).alias(s))
            carry[out] = F.last(s, ignorenulls=True).over(before)
            final[out] = F.coalesce(v, c)
        elif kind == "next":
            local[out] = F.first(x, ignorenulls=True).over(after)
            summary.append(F.min_by(x, F.when(x.isNotNull(), pos)).alias(s))
            carry[out] = F.first(s, ignorenulls=True).over(behind)
            final[out] = F.coalesce(v, c)
        elif kind == "lag":
            local[out] = F.struct(F.lag(F.struct(x.alias("x"))).over(chunk).alias("p"))
            summary.append(F.max_by(x, pos).alias(s))
            carry[out] = F.lag(s).over(series)
            final[out] = F.when(v["p"].isNull(), c).otherwise(v["p"]["x"])
        elif kind == "lead":
            local[out] = F.struct(F.lead(F.struct(x.alias("x"))).over(chunk).alias("p"))
            summary.append(F.min_by(x, pos).alias(s))
            carry[out] = F.lead(s).over(series)
            final[out] = F.when(v["p"].isNull(), c).otherwise(v["p"]["x"])
        else:
            raise ValueError(f"unknown scan {kind}")

    # Only keys that span parts need a carry: one key per part boundary, so < 2 * parts rows.
    span = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    carries = (
        split.groupBy(*keys, PART).agg(*summary)
        .withColumn("_span", span).filter("_span > 1")
        .select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col(PART).alias("_kp"),
                *[e.alias(f"_c_{o}") for o, e in carry.items()])
    )
    on = F.col(PART) == F.col("_kp")
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    cols = [c for c in columns if c not in adds]
    return (
        split.select("*", *[e.alias(f"_l_{o}") for o, e in local.items()])
        .join(F.broadcast(carries), on, "left")
        .select(*cols, *[final[o].alias(o) for o in adds])
    )


def value_counts(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, value, n): map-side combined, so a hot value costs one row per task."""
    return df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))


def cumulative_counts(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, value, n, cum, total): rows per distinct value, rows at or below it, rows of the key; nulls left out."""
    present = df.filter(F.col(value).isNotNull())
    return scan(value_counts(present, keys, value), keys, [value], {"cum": ("sum", "n"), "total": ("total", "n")})


def with_group_stats(df: DataFrame, keys: list[str], aggs: dict[str, Column], keep_null_keys: bool = False) -> DataFrame:
    """Group statistics on every row: aggregate, then join back.

    Unlike a window this combines map-side and lets adaptive execution split a hot key.
    Rows with a null key are dropped, as a grouped frame drops them, or kept with null statistics.
    """
    cols = [e.alias(n) for n, e in aggs.items()]
    if keys:
        return df.join(df.groupBy(*keys).agg(*cols), keys, "left" if keep_null_keys else "inner").select(*df.columns, *aggs)
    stats = df.agg(F.struct(*cols).alias("s"))
    return df.withColumn("_st", stats.scalar()).select(*df.columns, *[F.col("_st")[n].alias(n) for n in aggs])
