"""The stored demand table: create, append, and replace a dataset or a day.

The table is partitioned by dataset and date, so a replacement touches only its
own partitions. A table whose days are never replaced alone may be partitioned by
dataset only: it has no folder and file for every day, and the files are sorted by
date instead. Replacing with no rows leaves the dataset or day empty, which
dynamic partition overwrite would not do. A day's partition is therefore always
named in the statement, and the table itself asks for static overwrite, whatever
the session's mode is.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlab.sources.schemas import schema_of

PARTITION_COLUMNS = ("dp_input_datasets_id", "date")
BY_DATASET = PARTITION_COLUMNS[:1]


def _partitions(spark: SparkSession, table: str) -> list[str]:
    return [column.name for column in spark.catalog.listColumns(table) if column.isPartition]


def _value_columns(layout: str, partitions: Sequence[str] = PARTITION_COLUMNS) -> list[str]:
    return [name for name in schema_of(layout).names if name not in partitions]


def _clustered(df: DataFrame, *columns: str) -> DataFrame:
    """Bring a partition's rows together so that each gets few, even files.

    The rebalance hint lets adaptive execution split a partition that is too big
    and join small ones.
    """
    return df.hint("rebalance", *[F.col(name) for name in columns])


def by_dataset(df: DataFrame) -> DataFrame:
    """Each dataset's rows together, for writing them in a folder of their own."""
    return _clustered(df, *BY_DATASET)


def _exists(spark: SparkSession, location: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def _held_partitions(spark: SparkSession, location: str) -> Sequence[str] | None:
    """What the data at a location is partitioned by; None if there is none."""
    for files, partitions in ((f"{PARTITION_COLUMNS[1]}=*", PARTITION_COLUMNS), ("*.parquet", BY_DATASET)):
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{location.rstrip('/')}/{PARTITION_COLUMNS[0]}=*/{files}")
        if path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path):
            return partitions
    return None


def create_demand_table(
    spark: SparkSession,
    table: str,
    location: str | None = None,
    layout: str = "demand",
    partitions: Sequence[str] = PARTITION_COLUMNS,
) -> None:
    """Create the partitioned Parquet table if it does not exist.

    ``layout`` is 'demand' (with the experiment) or 'input_demand'. With a
    ``location`` that already holds data its partitions are picked up, and the
    table is partitioned as the data is.
    """
    filled = location is not None and not spark.catalog.tableExists(table) and _exists(spark, location)
    if filled:
        partitions = _held_partitions(spark, location) or partitions
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema_of(layout))
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet "
        "OPTIONS (partitionOverwriteMode 'static') "
        f"PARTITIONED BY ({', '.join(f'`{c}`' for c in partitions)}){place}"
    )
    if filled:
        spark.catalog.recoverPartitions(table)


def append_demand(df: DataFrame, table: str, layout: str = "demand") -> None:
    """Add rows to the table, in parallel."""
    partitions = _partitions(df.sparkSession, table)
    ordered = df.select(*_value_columns(layout, partitions), *partitions)
    _clustered(ordered, *partitions).write.insertInto(table)


def _require_static_overwrite(spark: SparkSession, table: str) -> None:
    """A table made elsewhere may follow the session, where the dynamic mode would keep stale days."""
    if spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() != "dynamic":
        return
    details = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Storage Properties'").first()
    if details is None or "partitionoverwritemode=static" not in details.data_type.replace(" ", "").lower():
        raise ValueError(f"table {table} lacks the option partitionOverwriteMode 'static'")


def replace_dataset(df: DataFrame, table: str, dataset_id: int, layout: str = "demand") -> None:
    """Put ``df``'s rows of one dataset in place of all stored rows of that dataset."""
    _require_static_overwrite(df.sparkSession, table)
    partitions = _partitions(df.sparkSession, table)
    days = [name for name in partitions if name not in BY_DATASET]
    rows = df.filter(F.col("dp_input_datasets_id") == dataset_id).select(*_value_columns(layout, partitions), *days)
    rows = _clustered(rows, *days)
    df.sparkSession.sql(
        f"INSERT OVERWRITE TABLE {table} "
        f"PARTITION ({', '.join([f'dp_input_datasets_id = {int(dataset_id)}', *[f'`{name}`' for name in days]])}) "
        "SELECT * FROM {rows}",
        rows=rows if days else rows.sortWithinPartitions("date"),
    )


def replace_day(df: DataFrame, table: str, dataset_id: int, day: dt.date, layout: str = "demand") -> None:
    """Put ``df``'s rows of one dataset and date in place of the stored ones.

    All experiments of the day are replaced together, so ``df`` has to hold all
    of them. The table has to be partitioned by date.
    """
    rows = df.filter((F.col("dp_input_datasets_id") == dataset_id) & (F.col("date") == F.lit(day))).select(
        *_value_columns(layout)
    )
    df.sparkSession.sql(
        f"INSERT OVERWRITE TABLE {table} "
        f"PARTITION (dp_input_datasets_id = {int(dataset_id)}, `date` = DATE'{day.isoformat()}') "
        "SELECT * FROM {rows}",
        rows=_clustered(rows),
    )


def replace_datasets(df: DataFrame, table: str, dataset_ids: Sequence[int], layout: str = "demand") -> None:
    """Put ``df``'s rows in place of all stored rows of some datasets; rows of other datasets are not written.

    Each dataset is one statement that can be repeated. A dataset without rows ends
    up empty. ``df`` is read once for each, so it should be a written table, best
    one partitioned by dataset, of which each statement reads its own part.
    """
    for dataset_id in sorted(dataset_ids):
        replace_dataset(df, table, dataset_id, layout)


def store_table(df: DataFrame, table: str, replace: bool = False) -> None:
    """Store a result under a name in the catalog; an existing table is an error unless it is to be replaced."""
    df.write.format("parquet").mode("overwrite" if replace else "errorifexists").saveAsTable(table)


def name_temporarily(df: DataFrame, view: str) -> DataFrame:
    """Give a result a session-scoped name for use in later SQL."""
    df.createOrReplaceTempView(view)
    return df.sparkSession.table(view)
