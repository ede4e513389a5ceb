"""Null-aware exclusion lists, kept per region.

SQL's ``id NOT IN (list of the region)`` has three outcomes that an anti join on
equality misses: a NULL in the region's list excludes every row of the region, a
NULL id is excluded unless the list is empty, and an empty list excludes nothing.
Writing it as NOT IN would make Spark compare each row with the region's whole
list. Here the list is looked up by hash on (region, id), and the two NULL rules
come from one summary row per region.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _entries(listed: DataFrame) -> DataFrame:
    return listed.filter(F.col("element_id").isNotNull()).select(
        F.col("region_code").alias("__region"), F.col("element_id").alias("__element")
    )


def _with_region_rules(df: DataFrame, listed: DataFrame, id_column: str, region_column: str) -> DataFrame:
    """Add __ruled_out: true where a NULL in the list or a NULL id excludes the row."""
    regions = listed.groupBy(F.col("region_code").alias("__list_region")).agg(
        F.bool_or(F.col("element_id").isNull()).alias("__has_null")
    )
    # One row per region, whatever the length of the lists.
    joined = df.join(F.broadcast(regions), F.col(region_column) == F.col("__list_region"), "left")
    has_list = F.col("__has_null").isNotNull()
    ruled_out = F.when(has_list, F.col("__has_null") | F.col(id_column).isNull()).otherwise(F.lit(False))
    return joined.withColumn("__ruled_out", ruled_out).drop("__list_region", "__has_null")


def not_listed(
    df: DataFrame, blacklist: DataFrame, kind: str, id_column: str, region_column: str = "region_code"
) -> DataFrame:
    """Keep the rows whose id is ``NOT IN`` the region's list of that kind."""
    listed = blacklist.filter(F.col("type") == kind)
    allowed = df.join(
        _entries(listed),
        (F.col(region_column) == F.col("__region")) & (F.col(id_column) == F.col("__element")),
        "left_anti",
    )
    ruled = _with_region_rules(allowed, listed, id_column, region_column)
    return ruled.filter(~F.col("__ruled_out")).drop("__ruled_out")


def flag_listed(
    df: DataFrame, blacklist: DataFrame, kind: str, id_column: str, flag: str, region_column: str = "region_code"
) -> DataFrame:
    """Add ``flag``: true where ``NOT IN`` would not keep the row."""
    listed = blacklist.filter(F.col("type") == kind)
    entries = _entries(listed).distinct().withColumn("__hit", F.lit(True))
    looked_up = df.join(
        entries,
        (F.col(region_column) == F.col("__region")) & (F.col(id_column) == F.col("__element")),
        "left",
    )
    ruled = _with_region_rules(looked_up, listed, id_column, region_column)
    return ruled.withColumn(flag, F.col("__hit").isNotNull() | F.col("__ruled_out")).drop(
        "__region", "__element", "__hit", "__ruled_out"
    )
