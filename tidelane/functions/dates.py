"""Calendar keys. Group by the numeric parts, format once per group."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_start(ts: Column) -> Column:
    return F.trunc(F.to_date(ts), "month")


def month_key(day: Column) -> Column:
    """YYYY-MM"""
    return F.date_format(day, "yyyy-MM")


def week_of_year(day: Column) -> Column:
    """Monday-based week number, 0 to 53; days before the first Monday are week 0."""
    return F.floor((F.dayofyear(day) + 6 - F.weekday(day)) / 7).cast("int")


def week_key(year: Column, week: Column) -> Column:
    """YYYY-WW"""
    return F.concat_ws("-", F.lpad(year.cast("string"), 4, "0"), F.lpad(week.cast("string"), 2, "0"))


def year_week(ts: Column) -> Column:
    day = F.to_date(ts)
    return week_key(F.year(day), week_of_year(day))
