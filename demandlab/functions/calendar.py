"""Business-calendar expressions. A week starts on Sunday and Sundays are not worked."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_working_day(day: Column) -> Column:
    """True from Monday to Saturday (Spark numbers Sunday 1)."""
    return F.dayofweek(day) != 1


def week_start(day: Column) -> Column:
    """The Sunday on or before ``day``."""
    return F.date_sub(day, F.dayofweek(day) - 1)


def weeks_crossed(start: Column, end: Column) -> Column:
    """Number of Sunday boundaries between two dates, negative when ``end`` is earlier.

    Spark's own week difference counts full seven-day spans, so the Sundays are
    compared instead; their distance is always a multiple of seven.
    """
    return (F.date_diff(week_start(end), week_start(start)) / 7).cast("int")


def business_horizon(start: Column, end: Column) -> Column:
    """Days from ``start`` to ``end``, leaving out one day per week boundary."""
    return F.date_diff(end, start) - weeks_crossed(start, end)
