"""Division that stays defined under Spark's ANSI rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """NULL instead of an error when the denominator is zero."""
    return numerator / F.nullif(denominator, F.lit(0.0))


def absolute_error_percent(demand: Column, forecast: Column, absolute_error: Column) -> Column:
    """Absolute error as a percentage of demand.

    Without demand a positive forecast is 100 % wrong and a zero forecast right;
    a negative forecast has no defined error and gives NULL.
    """
    return (
        F.when((demand == 0) & (forecast > 0), F.lit(100.0))
        .when((demand == 0) & (forecast == 0), F.lit(0.0))
        .otherwise(F.lit(100.0) * safe_divide(absolute_error, demand))
    )
