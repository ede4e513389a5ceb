"""CSV inputs and outputs of the experiment analysis."""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from demandlab.sources.schemas import ANCHOR_DAYS, DESIGN_MATRIX, MAFE_ERRORS

ROW_NUMBER = "row"


def _headers(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """(file, first line) of one file for each header that occurs: files of one kind share theirs."""
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("place"),
    )
    # Only the first block of a file can hold its first line.
    first = lines.filter("start = 0").groupBy("file").agg(F.min_by("value", "place").alias("header"))
    return [(row.file, row.header) for row in first.groupBy("header").agg(F.min("file").alias("file")).collect()]


def read_indexed_csv(spark: SparkSession, path: str, columns: str) -> DataFrame:
    """Read a CSV with a header whose first column is a row number, under any name or none.

    ``columns`` is a DDL list that leaves the row number out; no type is inferred.
    A file whose header has other columns, or another order, is an error.
    """
    wanted = StructType.fromDDL(columns).names
    for file, header in _headers(spark, path):
        found = next(csv.reader([header]))[1:]
        if found != wanted:
            raise ValueError(f"{file} has the columns {', '.join(found)}, not {', '.join(wanted)}")
    return (
        spark.read.schema(f"__row bigint, {columns}")
        .csv(path, header=True, enforceSchema=True, dateFormat="yyyy-MM-dd", mode="FAILFAST")
        .drop("__row")
    )


def read_anchor_days(spark: SparkSession, path: str) -> DataFrame:
    """The anchor dates on which forecasts are judged."""
    return read_indexed_csv(spark, path, ANCHOR_DAYS)


def read_design_matrix(spark: SparkSession, path: str) -> DataFrame:
    return read_indexed_csv(spark, path, DESIGN_MATRIX)


def read_errors(spark: SparkSession, path: str) -> DataFrame:
    """Weighted errors per warehouse, as ``Evaluation.warehouse_errors`` gives them."""
    return read_indexed_csv(spark, path, MAFE_ERRORS)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists", numbered: bool = False) -> None:
    """Write with a header, one file per task.

    ``numbered`` puts a row number first, as the readers here expect it; numbers
    are unique and ascending, but not without gaps between files.
    """
    if numbered:
        df = df.select(F.monotonically_increasing_id().alias(ROW_NUMBER), *df.columns)
    df.write.mode(mode).csv(path, header=True, dateFormat="yyyy-MM-dd")
