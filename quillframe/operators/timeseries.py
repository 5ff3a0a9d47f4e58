"""Calendar spines, resampling, profiles.

A series here has one row per calendar step, so its length is bounded by time rather than by rows:
the plain ordered windows below run on such series only, after the rows have been aggregated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillframe.functions import dates


def spine(bounds: DataFrame, step: str, out: str = "day") -> DataFrame:
    """Every step from ``lo`` to ``hi`` of a one-row frame, e.g. ``interval 1 day``."""
    return bounds.select(F.explode(F.sequence("lo", "hi", F.expr(step))).alias(out))


def extent(df: DataFrame, col: str, kind: str = "date") -> DataFrame:
    return df.agg(F.min(col).cast(kind).alias("lo"), F.max(col).cast(kind).alias("hi"))


def business_days(days: DataFrame, col: str = "day") -> DataFrame:
    return days.filter(F.weekday(col) < 5)


def anchors(days: DataFrame, rule: str, col: str = "day") -> DataFrame:
    """Distinct anchor dates covering the days: BM, BQ, BA (last business day of the month, quarter,
    year) and MS, QS, AS (first day)."""
    unit = {"M": "month", "Q": "quarter", "A": "year"}[rule.strip("BS")]
    d = F.col(col)
    anchor = dates.business_period_end(d, unit) if rule.startswith("B") else F.to_date(F.date_trunc(unit, d))
    return days.select(anchor.alias(col)).distinct()


def resample(df: DataFrame, time: str, rule: str, aggs: dict[str, Column], out: str = "day") -> DataFrame:
    """Aggregate to D, W (labelled by its Sunday), M or BA buckets."""
    t = F.col(time)
    label = {"D": F.to_date(t), "W": dates.week_label(t), "M": dates.period_end(t, "month"),
             "BA": dates.business_period_end(t, "year")}[rule]
    return df.groupBy(label.alias(out)).agg(*[e.alias(n) for n, e in aggs.items()])


def fill_buckets(series: DataFrame, time: str, step: str, fill: dict | None = None) -> DataFrame:
    """Every step between the first and last bucket; empty ones null or filled."""
    out = spine(extent(series, time), step, time).join(series, time, "left")
    return out.fillna(fill) if fill else out


def as_freq(series: DataFrame, time: str, keys: DataFrame, method: str | None = None) -> DataFrame:
    """Values at the wanted dates: exact matches, or carried forward / back to the dates between."""
    if method is None:
        return keys.join(series, time, "left")
    values = [c for c in series.columns if c != time]
    wanted = keys.select(time).withColumn("_want", F.lit(True))
    both = series.withColumn("_has", F.lit(True)).join(wanted, time, "full")
    w = Window.orderBy(time)
    if method == "ffill":
        pick, frame = F.last, w.rowsBetween(Window.unboundedPreceding, 0)
    else:
        pick, frame = F.first, w.rowsBetween(0, Window.unboundedFollowing)
    row = F.when(F.col("_has"), F.struct(*values))
    filled = both.select(time, "_want", pick(row, ignorenulls=True).over(frame).alias("_v"))
    return filled.filter("_want").select(time, *[F.col(f"_v.{c}").alias(c) for c in values])


def serial_correlation(series: DataFrame, time: str, col: str, lag: int) -> DataFrame:
    """Correlation of a calendar series with itself ``lag`` steps earlier."""
    pairs = series.select(F.col(col).alias("x"), F.lag(col, lag).over(Window.orderBy(time)).alias("y")).dropna()
    return pairs.agg(F.corr("x", "y").alias("correlation"))
