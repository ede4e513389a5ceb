"""The stored line state: counted lines per day, from which thresholds are taken without the lines.

A row counts the equal lines (dataset, day, product, quantity, user flag) of a day.
Counts are exact and can be added up over any days, so mean, deviation and percentile
of the whole history come from the state. It is partitioned by month, and a month is
replaced as a whole, also by nothing, with what its own lines count now. So a run
that failed is simply run again, and no stored row is read to be written back. A state
therefore belongs to one choice of datasets (one, a country's, or all), with which it
is built and refreshed. What was counted under other lists or zones stays until its
month is counted again.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VALUES = ("product_id", "quantity", "user_listed", "line_count", "close_date", "dp_input_datasets_id")
MONTH = "month"


def month_of(day: dt.date) -> tuple[dt.date, dt.date]:
    """First and last day of a day's month."""
    first = day.replace(day=1)
    return first, (first + dt.timedelta(days=31)).replace(day=1) - dt.timedelta(days=1)


def create_line_state(spark: SparkSession, table: str, location: str | None = None) -> None:
    """Create the table if it does not exist; it asks for static overwrite whatever the session does."""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} (product_id BIGINT, quantity DOUBLE, user_listed BOOLEAN, line_count BIGINT, "
        f"close_date DATE, dp_input_datasets_id INT, {MONTH} DATE) USING parquet OPTIONS (partitionOverwriteMode 'static') "
        f"PARTITIONED BY ({MONTH}){place}"
    )


def _overwrite(rows: DataFrame, table: str, partition: str) -> None:
    # Datasets lie together in the files, so a reader of one skips the others.
    rows.sparkSession.sql(
        f"INSERT OVERWRITE TABLE {table} PARTITION ({partition}) SELECT * FROM {{rows}}",
        rows=rows.sortWithinPartitions("dp_input_datasets_id", "product_id"),
    )


def replace_all(counted: DataFrame, table: str) -> None:
    """Put counted lines in place of the whole state."""
    month = F.trunc("close_date", "month").alias(MONTH)
    _overwrite(counted.select(*VALUES, month).hint("rebalance", F.col(MONTH)), table, MONTH)


def replace_month(counted: DataFrame, table: str, day: dt.date) -> None:
    """Put the counted lines of a day's month in place of the stored ones."""
    first, last = month_of(day)
    rows = counted.filter(F.col("close_date").between(F.lit(first), F.lit(last))).select(*VALUES)
    _overwrite(rows.hint("rebalance"), table, f"{MONTH} = DATE'{first.isoformat()}'")


def stored_counts(spark: SparkSession, table: str, as_of: dt.date) -> DataFrame:
    """The state up to a day: partitions of later months are not read."""
    rows = spark.table(table).filter((F.col(MONTH) <= F.lit(as_of)) & (F.col("close_date") <= F.lit(as_of)))
    return rows.drop(MONTH)
