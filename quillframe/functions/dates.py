"""Date parsing, parts and calendar anchors. All of them keep the type without a time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DATE_FORMATS = ("yyyy-MM-dd", "yyyy-MMM-d", "MM-dd-yyyy", "yyyyMMdd", "d MMMM, yyyy")


def parse_mixed(c: Column, formats: tuple[str, ...] = DATE_FORMATS) -> Column:
    """Date from any of several formats, ordinals like '4th of July, 2015' included; null when none fits."""
    text = F.regexp_replace(c, r"^(\d{1,2})(st|nd|rd|th) of ", "$1 ")
    return F.coalesce(*[F.to_date(F.try_to_timestamp(text, F.lit(f))) for f in formats])


def build_date(year: Column, month: Column, day: Column) -> Column:
    """Date from its parts; null for a day that does not exist."""
    text = F.format_string("%04d%02d%02d", year.cast("int"), month.cast("int"), day.cast("int"))
    return F.to_date(F.try_to_timestamp(text, F.lit("yyyyMMdd")))


def weekday(c: Column) -> Column:
    """Monday = 0."""
    return F.weekday(c)


def truncate(unit: str, c: Column) -> Column:
    return F.date_trunc(unit, c).cast("timestamp_ntz")


def week_label(c: Column) -> Column:
    """The Sunday that ends the week."""
    return F.date_add(F.to_date(F.date_trunc("week", c)), 6)


def business_back(day: Column) -> Column:
    """The day itself, or the Friday before a weekend day."""
    return F.date_sub(day, F.greatest(F.weekday(day) - 4, F.lit(0)))


def period_end(c: Column, unit: str) -> Column:
    """Last calendar day of the month, quarter or year."""
    start = F.to_date(F.date_trunc(unit, c))
    return F.date_sub(F.add_months(start, {"month": 1, "quarter": 3, "year": 12}[unit]), 1)


def business_period_end(c: Column, unit: str) -> Column:
    return business_back(period_end(c, unit))
