"""Runs queries in Spark and DuckDB and compares them cell by cell.

    python -m validation.compare [query ...]   (SF_DIR names the data folder, CORES the local cores)
"""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

from validation.oracle_queries import ORACLE
from validation.spark_queries import QUERIES

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def local_session(cores: str = "8", partitions: int = 8) -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("demandlab")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        # Building columns is several times faster without call sites for messages.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def normal(frame: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, dates as text, floats rounded, rows sorted."""
    out = {}
    for name in sorted(frame.columns):
        column = frame[name]
        if pd.api.types.is_float_dtype(column):
            out[name] = column.astype(float).round(5) + 0.0
        elif pd.api.types.is_integer_dtype(column) or pd.api.types.is_bool_dtype(column):
            out[name] = column.astype("int64")
        elif pd.api.types.is_datetime64_any_dtype(column):
            out[name] = column.dt.strftime("%Y-%m-%d")
        else:
            out[name] = column.astype(str)
    result = pd.DataFrame(out)
    return result.sort_values(list(result.columns), ignore_index=True)


def difference(spark_frame: pd.DataFrame, oracle_frame: pd.DataFrame) -> str | None:
    """None when equal, else what differs."""
    left, right = normal(spark_frame), normal(oracle_frame)
    if list(left.columns) != list(right.columns):
        return f"columns {sorted(set(left.columns) ^ set(right.columns))}"
    if len(left) != len(right):
        return f"rows {len(left)} and {len(right)}"
    for name in left.columns:
        a, b = left[name], right[name]
        if a.dtype != b.dtype:
            return f"type of {name}: {a.dtype} and {b.dtype}"
        same = ((a - b).abs() <= 1e-4) | (a.isna() & b.isna()) if a.dtype == float else a == b
        if not same.all():
            where = same[~same].index[0]
            return f"{(~same).sum()} values of {name}, first {left.loc[where].to_dict()} and {right.loc[where].to_dict()}"
    return None


def main() -> int:
    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    names = sys.argv[1:] or list(QUERIES)
    spark, connection = local_session(os.environ.get("CORES", "8")), oracle_connection(sf_dir)
    spark.sparkContext.setLogLevel("ERROR")
    failures = 0
    for name in names:
        started = time.time()
        try:
            ours = QUERIES[name](spark, sf_dir).toPandas()
            took = time.time() - started
            theirs = connection.execute(ORACLE[name]).df()
            problem = difference(ours, theirs)
        except Exception as error:  # the report goes on with the next query
            took, problem, ours = time.time() - started, f"{type(error).__name__}: {str(error)[:1500]}", []
        failures += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name:32s} {len(ours):8d} rows {took:6.1f} s  {problem or ''}", flush=True)
    return failures


if __name__ == "__main__":
    sys.exit(main())
