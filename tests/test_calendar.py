import datetime as dt

import pytest
from pyspark.sql import functions as F

from demandlab.functions.calendar import business_horizon, is_working_day, week_start, weeks_crossed

FRIDAY, SUNDAY, MONDAY = dt.date(2022, 8, 5), dt.date(2022, 8, 7), dt.date(2022, 8, 8)


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


@pytest.mark.parametrize(
    ("start", "end", "weeks", "horizon"),
    [
        (FRIDAY, MONDAY, 1, 2),
        (MONDAY, FRIDAY, -1, -2),
        (MONDAY, MONDAY, 0, 0),
        (FRIDAY, SUNDAY, 1, 1),
        (SUNDAY, MONDAY, 0, 1),
        (MONDAY, dt.date(2022, 9, 17), 5, 35),
    ],
)
def test_horizon_leaves_out_sundays(spark, start, end, weeks, horizon):
    assert value(spark, weeks_crossed(F.lit(start), F.lit(end))) == weeks
    assert value(spark, business_horizon(F.lit(start), F.lit(end))) == horizon


def test_only_sunday_is_not_worked(spark):
    days = [MONDAY + dt.timedelta(days=i) for i in range(7)]
    worked = [value(spark, is_working_day(F.lit(day))) for day in days]
    assert worked == [True] * 6 + [False]


def test_week_starts_on_sunday(spark):
    assert value(spark, week_start(F.lit(FRIDAY))) == dt.date(2022, 7, 31)
    assert value(spark, week_start(F.lit(SUNDAY))) == SUNDAY
