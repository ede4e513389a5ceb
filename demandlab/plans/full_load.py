"""Full load of the input demand, and the date tables prepared from it."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlab.functions.calendar import is_working_day
from demandlab.operators.datasets import select_datasets
from demandlab.operators.order_lines import order_lines
from demandlab.operators.stockouts import stockouts_by_region
from demandlab.plans.demand import Variant, wide_demand
from demandlab.session import intermediate_results, materialize
from demandlab.sources.demand_table import BY_DATASET, by_dataset, create_demand_table, replace_datasets, store_table
from demandlab.sources.tables import Tables

# Line bound and customer list on; no percentile, no smoothing.
LOAD_STEPS = Variant(number=0, sigma_lines=True, percentile_lines=False, user_list=True, smooth=False)


def full_load(tables: Tables, as_of: dt.date, country: str | None = None) -> DataFrame:
    """Input demand of every dataset of a country (all countries when None).

    Stockouts come from the source without warehouse.
    """
    datasets = select_datasets(tables, country)
    wide = wide_demand(
        order_lines(tables, datasets, as_of),
        stockouts_by_region(tables, datasets, as_of),
        tables.new_skus,
        [LOAD_STEPS],
    )
    demand = F.col(LOAD_STEPS.experiment)
    return wide.filter(demand.isNotNull()).select(
        "date", "product_id", demand.alias("demand"), "dp_input_datasets_id"
    )


def run_full_load(
    spark: SparkSession,
    tables: Tables,
    as_of: dt.date,
    country: str,
    input_demand: str,
    dates: str,
    start_dates: str,
    location: str | None = None,
) -> None:
    """Put the full load into the table ``input_demand`` and store the two tables of dates made from it.

    The load takes the place of all rows of the country's datasets, also of those
    without demand, and the date tables take the place of older ones. So a load
    that failed halfway, or ran already, is simply run again. A new table is
    partitioned by dataset alone: a load replaces whole datasets, and its readers take
    all days, so a folder for every day of every dataset would cost more than the load.
    """
    create_demand_table(spark, input_demand, location, "input_demand", BY_DATASET)
    # The ids of a country's datasets: no more than the dataset table has rows.
    datasets = [row[0] for row in select_datasets(tables, country).select("dataset_identifier").distinct().collect()]
    with intermediate_results(spark):
        load = materialize(by_dataset(full_load(tables, as_of, country)), "full-load", BY_DATASET)
        replace_datasets(load, input_demand, datasets, "input_demand")
    stored = spark.table(input_demand)
    store_table(demand_dates(stored), dates, replace=True)
    store_table(first_demand_dates(tables, stored, country), start_dates, replace=True)


def demand_dates(input_demand: DataFrame) -> DataFrame:
    """Distinct demand dates without Sundays."""
    return input_demand.select(F.col("date").alias("raw_date")).filter(is_working_day(F.col("raw_date"))).distinct()


def first_demand_dates(tables: Tables, input_demand: DataFrame, country: str | None = None) -> DataFrame:
    """First demand date per dataset and product of a country."""
    datasets = select_datasets(tables, country).select(F.col("dataset_identifier").alias("dp_input_datasets_id"))
    # The minimum does not care about repeated rows, so it is taken before the join.
    first = input_demand.groupBy("dp_input_datasets_id", "product_id").agg(F.min("date").alias("start_demand_date"))
    return (
        first.join(datasets.distinct(), "dp_input_datasets_id")
        .select("dp_input_datasets_id", "product_id", "start_demand_date")
    )
