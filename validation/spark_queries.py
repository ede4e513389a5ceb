"""Every operator and job as a query over the driver's tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from demandlab.functions.calendar import business_horizon, is_working_day
from demandlab.operators.datasets import list_datasets, of_country, select_datasets, site_warehouses, sites_with_country
from demandlab.operators.order_lines import (
    closed_orders,
    key_account_orders,
    kept_lines,
    lines_of,
    order_lines,
    without_listed_users,
    zone_orders,
)
from demandlab.operators.outliers import day_z_scores, line_percentiles, line_statistics, smooth_days
from demandlab.operators.sku import remap_products
from demandlab.operators.stockouts import stockouts_by_region, stockouts_by_warehouse
from demandlab.operators.zones import match_zone_groups, match_zones, zone_shapes
from demandlab.plans.demand import VARIANT, VARIANTS, build_demand, line_demand, refresh_line_state, run_demand, wide_demand
from demandlab.plans.evaluation import Evaluation, cohort_products, evaluation_cases, latest_params
from demandlab.plans.experiments import (
    add_difference,
    design_response,
    flag_exp6_higher,
    mean_by_timeframe,
    overall_mean,
    sum_by_timeframe,
)
from demandlab.plans.full_load import demand_dates, first_demand_dates, full_load, run_full_load
from demandlab.session import fresh_path
from demandlab.sources.csv_files import read_anchor_days, read_errors, write_csv
from demandlab.sources.demand_table import append_demand, create_demand_table, name_temporarily
from demandlab.sources.line_state import stored_counts
from demandlab.sources.order_layout import buckets_for, store_orders
from demandlab.sources.schemas import MAFE_ERRORS, schema_of
from validation.adapter import AS_OF, all_cases, evaluation_tables, line_state, repeated_setup_tables, source_tables

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}



def rounded(df: DataFrame) -> DataFrame:
    """Round doubles to six places: sums depend on their order in the last digits."""
    return df.select(
        *[F.round(name, 6).alias(name) if kind == "double" else F.col(name) for name, kind in df.dtypes]
    )


def query(build: Query) -> Query:
    """Register a query under the name of its function."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rounded(build(spark, sf_dir))

    QUERIES[build.__name__] = run
    return build


# Calendar, country and product code.


@query
def working_day_orders(spark, sf_dir):
    return closed_orders(source_tables(spark, sf_dir), AS_OF).select("id", "region_code", "close_date")


@query
def country_orders(spark, sf_dir):
    tables = source_tables(spark, sf_dir)
    sites = of_country(sites_with_country(tables), "c0").select("country", "region_code")
    return tables.order_header.join(sites, "region_code").select("id", "region_code", "country")


@query
def region_fanout(spark, sf_dir):
    tables = source_tables(spark, sf_dir)
    datasets = list_datasets(tables).withColumnRenamed("warehouse", "dataset_warehouse")
    return tables.order_header.select("id", "region_code", "close_date").join(datasets, "region_code")


@query
def shipping_horizon(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    ordered, shipped = F.to_date("o_orderdate"), F.to_date("l_shipdate")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line"),
        is_working_day(shipped).alias("working_day"),
        business_horizon(ordered, shipped).alias("timeframe"),
    )


@query
def sku_remap(spark, sf_dir):
    tables = source_tables(spark, sf_dir)
    lines = kept_lines(tables).select("order_id", "product_id", "quantity")
    return remap_products(lines, tables.new_skus, units=("quantity",))


# Zones and order lines.


@query
def zone_join(spark, sf_dir):
    tables = source_tables(spark, sf_dir)
    sites = tables.site.withColumnRenamed("identifier_value", "region_code")
    points = tables.order_header.select("id", "region_code", "latitude", "longitude").join(sites, "region_code")
    return match_zones(points, zone_shapes(tables)).select("id", "region_code", "microzone_id")


@query
def zone_group_join(spark, sf_dir):
    tables = source_tables(spark, sf_dir)
    points = tables.order_header.select("id", "region_code", "latitude", "longitude")
    return match_zone_groups(points, tables).select("id", "microzone_group_code", "microzone_id")


@query
def zone_order_routes(spark, sf_dir):
    tables = source_tables(spark, sf_dir)
    return zone_orders(tables, select_datasets(tables), AS_OF).drop("stockout_weight")


@query
def kam_lines(spark, sf_dir):
    tables = source_tables(spark, sf_dir)
    orders = key_account_orders(tables, select_datasets(tables), AS_OF)
    return lines_of(orders, tables, flag_users=False)


@query
def order_lines_all(spark, sf_dir):
    tables = source_tables(spark, sf_dir)
    return order_lines(tables, select_datasets(tables), AS_OF, flag_users=False)


@query
def order_lines_bucketed(spark, sf_dir):
    """The same from headers and lines stored in buckets of the order."""
    (headers, header_path), (lines, line_path) = (_new_table(spark, name) for name in ("headers", "lines"))
    buckets = buckets_for(spark, 0)
    tables = store_orders(source_tables(spark, sf_dir), headers, lines, buckets, (header_path, line_path))
    return order_lines(tables, select_datasets(tables), AS_OF, flag_users=False)


@query
def order_lines_user_blacklist(spark, sf_dir):
    tables = source_tables(spark, sf_dir)
    return without_listed_users(order_lines(tables, select_datasets(tables), AS_OF)).drop("user_listed")


# Thresholds, demand before stockouts, stockouts.


def _lines(spark, sf_dir):
    tables = source_tables(spark, sf_dir)
    return order_lines(tables, select_datasets(tables), AS_OF, flag_users=False)


@query
def line_stats(spark, sf_dir):
    return line_statistics(_lines(spark, sf_dir))


@query
def line_p99(spark, sf_dir):
    return line_percentiles(_lines(spark, sf_dir))


def _line_demand(number):
    def build(spark, sf_dir):
        tables = source_tables(spark, sf_dir)
        return line_demand(tables, select_datasets(tables), AS_OF, VARIANT[number])

    return build


for _number, _name in ((1, "unfiltered"), (2, "six_sigma"), (3, "p99"), (4, "six_sigma_p99")):
    _build = _line_demand(_number)
    _build.__name__ = f"line_demand_{_name}"
    query(_build)


@query
def stockouts_by_wh(spark, sf_dir):
    tables = source_tables(spark, sf_dir)
    return stockouts_by_warehouse(tables, select_datasets(tables), AS_OF)


@query
def stockouts_no_wh(spark, sf_dir):
    tables = source_tables(spark, sf_dir)
    return stockouts_by_region(tables, select_datasets(tables), AS_OF)


# Demand variants.


def _demand(number):
    return lambda spark, sf_dir: build_demand(source_tables(spark, sf_dir), AS_OF, [VARIANT[number]])


for _variant in VARIANTS:
    _build = _demand(_variant.number)
    _build.__name__ = f"demand_exp{_variant.number}"
    query(_build)


@query
def demand_all_variants(spark, sf_dir):
    return build_demand(source_tables(spark, sf_dir), AS_OF)


@query
def demand_by_view(spark, sf_dir):
    """Demand named for the session and read by SQL."""
    view, _ = _new_table(spark, "demand_view")
    name_temporarily(build_demand(source_tables(spark, sf_dir), AS_OF, [VARIANT[1]]), view)
    return spark.sql(f"SELECT dp_input_datasets_id, date, SUM(demand) AS demand, COUNT(*) AS products FROM {view} GROUP BY ALL")


@query
def demand_exp1_one_dataset(spark, sf_dir):
    return build_demand(source_tables(spark, sf_dir), AS_OF, [VARIANT[1]], country="C1", dataset_id=11)


@query
def demand_day_variants(spark, sf_dir):
    """The day's lines are counted into the stored state, which gives the thresholds."""
    tables, state = source_tables(spark, sf_dir), line_state(spark, sf_dir)
    refresh_line_state(spark, tables, state, AS_OF)
    return build_demand(tables, AS_OF, day=AS_OF, state=state)


@query
def demand_day_from_lines(spark, sf_dir):
    """The same day without a state: thresholds from all lines."""
    return build_demand(source_tables(spark, sf_dir), AS_OF, day=AS_OF)


@query
def line_state_counts(spark, sf_dir):
    """The state after the day's own refresh: counted lines of every day."""
    state = line_state(spark, sf_dir)
    refresh_line_state(spark, source_tables(spark, sf_dir), state, AS_OF)
    return stored_counts(spark, state, AS_OF)


@query
def demand_exp2_june_history(spark, sf_dir):
    """Smoothed by the mean of the whole history, then restricted."""
    tables = source_tables(spark, sf_dir)
    datasets = select_datasets(tables)
    lines = order_lines(tables, datasets, AS_OF, flag_users=False)
    days = wide_demand(lines, stockouts_by_warehouse(tables, datasets, AS_OF), tables.new_skus, [VARIANT[2]])
    june = F.col("date") >= F.lit("2001-06-01").cast("date")
    smoothed = smooth_days(days.filter("experiment_2 IS NOT NULL"), ["experiment_2"], june, over="history")
    return smoothed.withColumnRenamed("experiment_2", "demand")


@query
def demand_exp2_june(spark, sf_dir):
    june = F.col("date") >= F.lit("2001-06-01").cast("date")
    return build_demand(source_tables(spark, sf_dir), AS_OF, [VARIANT[2]], restriction=june)


@query
def zscore_days(spark, sf_dir):
    tables = source_tables(spark, sf_dir)
    datasets = select_datasets(tables)
    lines = order_lines(tables, datasets, AS_OF, flag_users=False)
    days = wide_demand(lines, stockouts_by_warehouse(tables, datasets, AS_OF), tables.new_skus, [VARIANT[1]])
    renamed = days.withColumnRenamed("experiment_1", "demand")
    return day_z_scores(renamed).withColumnRenamed("demand_z", "z_score")


# Full load, preparation, stored tables.


def _new_table(spark, name):
    """A table name and a location that no other run uses."""
    path = fresh_path(spark, name)
    return path.rsplit("/", 1)[-1].replace("-", "_"), path


def _full_load_tables(spark, sf_dir, runs=1):
    (demand, path), (dates, _), (starts, _) = (_new_table(spark, name) for name in ("input", "dates", "starts"))
    for _ in range(runs):
        run_full_load(spark, source_tables(spark, sf_dir), AS_OF, "c1", demand, dates, starts, path)
    loaded = spark.table(demand).select("product_id", "demand", "dp_input_datasets_id", "date")
    return loaded, spark.table(dates), spark.table(starts)


@query
def full_load_daily(spark, sf_dir):
    return full_load(source_tables(spark, sf_dir), AS_OF)


@query
def full_load_stored(spark, sf_dir):
    return _full_load_tables(spark, sf_dir)[0]


@query
def full_load_twice(spark, sf_dir):
    """A load that is run again leaves what one run leaves."""
    return _full_load_tables(spark, sf_dir, runs=2)[0]


@query
def all_dates_stored(spark, sf_dir):
    return _full_load_tables(spark, sf_dir)[1]


@query
def start_dates_stored(spark, sf_dir):
    return _full_load_tables(spark, sf_dir)[2]


@query
def all_dates(spark, sf_dir):
    return demand_dates(full_load(source_tables(spark, sf_dir), AS_OF))


@query
def start_demand_dates(spark, sf_dir):
    tables = source_tables(spark, sf_dir)
    return first_demand_dates(tables, full_load(tables, AS_OF), "c1")


STORED = ("date", "product_id", "demand", "dp_input_datasets_id", "experiment")
OTHER_DAY = AS_OF - dt.timedelta(days=1)


def _wrongly_stored(spark, dataset_id):
    """A table with rows of the dataset that no run makes, and one row of another dataset."""
    table, path = _new_table(spark, "demand")
    create_demand_table(spark, table, path)
    rows = [(AS_OF, -1, 1.0, dataset_id, "experiment_1"), (AS_OF, -2, 1.0, dataset_id, "experiment_9"), (OTHER_DAY, -3, 1.0, dataset_id, "experiment_1"), (AS_OF, -4, 1.0, 99, "experiment_1")]
    append_demand(spark.createDataFrame(rows, schema_of("demand")), table)
    return table


@query
def daily_run_stored(spark, sf_dir):
    """A daily run replaces the day of its dataset; another day and another dataset stay. Thresholds come from the line state."""
    table = _wrongly_stored(spark, 10)
    run_demand(spark, source_tables(spark, sf_dir), table, "c1", 10, AS_OF, state=line_state(spark, sf_dir, 10))
    return spark.table(table).select(*STORED)


@query
def dataset_replaced_stored(spark, sf_dir):
    """An initial load replaces all days of its dataset; another dataset stays."""
    table = _wrongly_stored(spark, 10)
    run_demand(spark, source_tables(spark, sf_dir), table, "c1", 10, AS_OF, initial_load=True)
    return spark.table(table).select(*STORED)


# Evaluation.


@query
def cohort(spark, sf_dir):
    tables = source_tables(spark, sf_dir)
    return cohort_products(tables, all_cases(tables))


def _evaluation(spark, sf_dir, by_category=False):
    tables, cases = evaluation_tables(spark, sf_dir)
    return Evaluation(tables, cases, AS_OF, by_category)


@query
def clean_demand(spark, sf_dir):
    return _evaluation(spark, sf_dir).clean_demand()


@query
def gmv_share(spark, sf_dir):
    tables = source_tables(spark, sf_dir)
    return Evaluation(tables, all_cases(tables), AS_OF).sales_share()


@query
def gmv_share_category(spark, sf_dir):
    tables = source_tables(spark, sf_dir)
    return Evaluation(tables, all_cases(tables), AS_OF, by_category=True).sales_share()


@query
def forecast_by_experiment(spark, sf_dir):
    return _evaluation(spark, sf_dir).forecast_by_experiment()


@query
def forecast_wide(spark, sf_dir):
    return _evaluation(spark, sf_dir).forecast_wide()


@query
def repeated_forecasts(spark, sf_dir):
    """Keys that several setups forecast."""
    return Evaluation(*repeated_setup_tables(spark, sf_dir), AS_OF).repeated_forecasts()


@query
def forecast_chain(spark, sf_dir):
    """Repeated setups as seven outer joins would count them."""
    return Evaluation(*repeated_setup_tables(spark, sf_dir), AS_OF, multiply_repeats=True).forecast_wide()


@query
def mafe_warehouse_chain(spark, sf_dir):
    return Evaluation(*repeated_setup_tables(spark, sf_dir), AS_OF, multiply_repeats=True).warehouse_errors()


@query
def mafe_product(spark, sf_dir):
    return _evaluation(spark, sf_dir).product_errors()


@query
def mafe_warehouse(spark, sf_dir):
    return _evaluation(spark, sf_dir).warehouse_errors()


@query
def mafe_category(spark, sf_dir):
    return _evaluation(spark, sf_dir, by_category=True).warehouse_errors()


@query
def latest_forecast_params(spark, sf_dir):
    return latest_params(source_tables(spark, sf_dir))


@query
def regular_warehouses(spark, sf_dir):
    return site_warehouses(source_tables(spark, sf_dir))


@query
def order_days_csv(spark, sf_dir):
    """Cases on every day of the orders; the days go through CSV files."""
    tables, path = source_tables(spark, sf_dir), fresh_path(spark, "days")
    days = tables.order_header.select(F.col("close_date").alias("date")).distinct()
    write_csv(days, path, numbered=True)
    return evaluation_cases(select_datasets(tables), read_anchor_days(spark, path), 40)


@query
def mafe_csv_round_trip(spark, sf_dir):
    path = fresh_path(spark, "errors")
    errors = _evaluation(spark, sf_dir).warehouse_errors()
    write_csv(errors.select(*StructType.fromDDL(MAFE_ERRORS).names), path, numbered=True)
    return read_errors(spark, path)


# Experiment analysis.

BY_DATASET = ("dp_input_datasets_id", "timeframe")


@query
def mafe_by_timeframe(spark, sf_dir):
    return mean_by_timeframe(_evaluation(spark, sf_dir).warehouse_errors())


@query
def mafe_sum_by_timeframe(spark, sf_dir):
    return sum_by_timeframe(_evaluation(spark, sf_dir).product_errors())


@query
def exp6_higher(spark, sf_dir):
    errors = _evaluation(spark, sf_dir).product_errors()
    return flag_exp6_higher(errors).select(
        "anchor", "dp_input_datasets_id", "forecast_date", "product_id", "timeframe", "exp6_higher"
    )


@query
def design_matrix(spark, sf_dir):
    return design_response(mean_by_timeframe(_evaluation(spark, sf_dir).warehouse_errors(), BY_DATASET))


@query
def variant_comparison(spark, sf_dir):
    return add_difference(mean_by_timeframe(_evaluation(spark, sf_dir).warehouse_errors()))


@query
def mafe_overall(spark, sf_dir):
    return overall_mean(add_difference(mean_by_timeframe(_evaluation(spark, sf_dir).warehouse_errors())))
