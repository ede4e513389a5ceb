"""Selection of the demand datasets to build, and of warehouses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandlab.sources.tables import Tables

# Pseudo sites and warehouses that never take part.
EXCLUDED_SITES = ("NaN", "FBO", "FBA")
EXCLUDED_WAREHOUSES = ("CO", "CEASABOX1", "SALR")

ANY_WAREHOUSE = "ALL"


def sites_with_country(tables: Tables) -> DataFrame:
    """Site rows with the lower-case country name."""
    country = tables.country.select("country_id", F.lower("identifier_value").alias("country"))
    return tables.site.select("site_id", F.col("identifier_value").alias("region_code"), "country_id").join(
        country, "country_id"
    )


def of_country(df: DataFrame, country: str | None) -> DataFrame:
    """Keep one country, ignoring case; all countries when None."""
    return df if country is None else df.filter(F.col("country") == F.lower(F.lit(country)))


def _daily(tables: Tables, dataset_id: int | None) -> DataFrame:
    chosen = tables.dataset.filter(F.col("accumulated_days") == 1)
    return chosen if dataset_id is None else chosen.filter(F.col("id") == dataset_id)


def select_datasets(tables: Tables, country: str | None = None, dataset_id: int | None = None) -> DataFrame:
    """Daily (not accumulated) datasets of a country, optionally just one.

    Columns: region_code, warehouse, dataset_identifier, stockout_weight and
    microzone_group_code. The country only restricts, so it is a semi join: the
    result is never larger than the dataset table, and the optimizer knows it.
    """
    sites = of_country(sites_with_country(tables), country).select("region_code")
    return _daily(tables, dataset_id).join(sites, "region_code", "left_semi").select(
        "region_code",
        "warehouse",
        F.col("id").alias("dataset_identifier"),
        "stockout_weight",
        "microzone_group_code",
    )


def list_datasets(tables: Tables, country: str | None = None, dataset_id: int | None = None) -> DataFrame:
    """The selected datasets with the name of their country."""
    sites = of_country(sites_with_country(tables), country).select("country", "region_code")
    return _daily(tables, dataset_id).join(sites, "region_code").select(
        "country", "region_code", "warehouse", F.col("id").alias("dataset_identifier"), "stockout_weight"
    )


def site_warehouses(tables: Tables) -> DataFrame:
    """Regular warehouses of regular sites: region_code, warehouse, is_3pl."""
    sites = tables.site.filter(~F.col("identifier_value").isin(*EXCLUDED_SITES)).select(
        "site_id", F.col("identifier_value").alias("region_code")
    )
    warehouses = tables.warehouse.filter(~F.col("identifier_value").isin(*EXCLUDED_WAREHOUSES)).select(
        "site_id", F.col("identifier_value").alias("warehouse"), "is_3pl"
    )
    return sites.join(warehouses, "site_id").select("region_code", "warehouse", "is_3pl")
