"""Daily user activity: scan, normalise, count, top users per day, rolling mean."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillframe.operators.ordering import smallest_per_group
from quillframe.operators.windows import centred, rolling
from quillframe.sources.files import nan_to_null


def daily_activity(events: DataFrame, top: int = 5) -> DataFrame:
    """The ``top`` busiest (user, event type) pairs of every day, beside the day's total and its 7-day mean."""
    counts = (nan_to_null(events).groupBy(F.to_date("ts").alias("day"), "user_id", "event_type")
              .agg(F.count(F.lit(1)).alias("n")))
    best = smallest_per_group(counts.withColumn("_o", -F.col("n")), ["day"], ["_o", "user_id", "event_type"], top)
    totals = counts.groupBy("day").agg(F.sum("n").alias("day_total"))
    smooth = rolling(totals, "day", "day_total", {"week_mean": F.avg("day_total")}, *centred(7))
    return best.join(smooth, "day").select("day", "rank", "user_id", "event_type", "n", "day_total",
                                           F.round("week_mean", 6).alias("week_mean"))
