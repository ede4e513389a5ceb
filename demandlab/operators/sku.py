"""Replacement of retired product codes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def remap_products(df: DataFrame, new_skus: DataFrame, units: tuple[str, ...] = (), product: str = "product_id") -> DataFrame:
    """Move rows to the current product and scale ``units`` to its unit size.

    A product without replacement keeps its code with factor 1. A code with
    several replacements yields one row for each. The join is left to the
    optimizer, which broadcasts the map only while it is small.
    """
    replacement = new_skus.select(
        F.col("old_product_id").alias("__old"),
        F.col("new_product_id").alias("__new"),
        F.col("old_units_per_new_unit").alias("__factor"),
    )
    joined = df.join(replacement, F.col(product) == F.col("__old"), "left")
    factor = F.coalesce(F.col("__factor"), F.lit(1.0))
    changed = {product: F.coalesce(F.col("__new"), F.col(product)), **{u: F.col(u) * factor for u in units}}
    return joined.withColumns(changed).drop("__old", "__new", "__factor")
