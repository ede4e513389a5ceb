"""Weighted demand lost to stockouts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandlab.operators.sku import remap_products
from demandlab.sources.tables import Tables


def _positive_sums(matched: DataFrame, new_skus: DataFrame, as_of: dt.date, day: dt.date | None = None) -> DataFrame:
    # Summed per raw product first: what is shuffled or joined to the product
    # map is then one row per day and product, not one per stockout record.
    if day is not None:
        matched = matched.filter(F.col("close_date") == F.lit(day))
    daily = (
        matched.filter(F.col("close_date") <= F.lit(as_of))
        .groupBy("close_date", "product_id", "region_code", "dataset_identifier", "stockout_weight")
        .agg(F.sum("stockout_demand").alias("lost"))
    )
    weighted = remap_products(daily, new_skus, units=("lost",))
    return (
        weighted.groupBy("close_date", "product_id", "region_code", "dataset_identifier")
        .agg(F.sum(F.col("lost") * F.col("stockout_weight")).alias("stockouts"))
        .filter(F.col("stockouts") > 0)
    )


def _chosen(datasets: DataFrame, *keys: str) -> DataFrame:
    return datasets.select(*keys, "dataset_identifier", "stockout_weight")


def stockouts_by_warehouse(
    tables: Tables, datasets: DataFrame, as_of: dt.date, day: dt.date | None = None
) -> DataFrame:
    """Positive stockout demand per day, product and dataset of the same warehouse; of one day if given."""
    keys = ["region_code", "warehouse"]
    matched = tables.stockout_by_warehouse.join(_chosen(datasets, *keys), keys)
    return _positive_sums(matched, tables.new_skus, as_of, day)


def stockouts_by_region(tables: Tables, datasets: DataFrame, as_of: dt.date) -> DataFrame:
    """The same for sources without warehouse: every dataset of the region gets it."""
    matched = tables.stockout_by_region.join(_chosen(datasets, "region_code"), "region_code")
    return _positive_sums(matched, tables.new_skus, as_of)
