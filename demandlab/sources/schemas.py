"""Fixed schemas of every input and output table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# One DDL line per table. Flags that arrive as text ('true', 'False') stay text.
TABLE_COLUMNS = {
    "country": "country_id int, identifier_value string",
    "site": "site_id int, identifier_value string, country_id int",
    "warehouse": "site_id int, identifier_value string, is_3pl string",
    "dataset": (
        "id int, region_code string, warehouse string, microzone_group_code string, "
        "accumulated_days int, stockout_weight double"
    ),
    "forecast_params": "id int, dp_input_datasets_id int, start_day_live date, end_day_live date",
    "microzone_group": "microzone_group_code string, microzone_id int",
    "microzone": "microzone_id int, site_id int, boundaries array<array<struct<x: double, y: double>>>",
    "order_header": (
        "id bigint, user_id bigint, region_code string, warehouse string, tag_name string, "
        "status int, close_date date, latitude double, longitude double"
    ),
    "order_line": (
        "order_id bigint, product_id bigint, quantity double, price double, is_deleted string, owner_id bigint"
    ),
    "new_skus": "old_product_id bigint, new_product_id bigint, old_units_per_new_unit double",
    "customer_config": "region string, tag_name string, warehouse string, warehouse_vip string",
    "blacklist": "element_id bigint, type string, region_code string",
    "stockout_by_warehouse": (
        "close_date date, product_id bigint, region_code string, warehouse string, stockout_demand double"
    ),
    "stockout_by_region": "close_date date, product_id bigint, region_code string, stockout_demand double",
    "catalog": "product_id bigint, warehouse string, category string",
    "forecast": (
        "forecast_date date, created_on timestamp, region_code string, warehouse string, "
        "dp_forecast_params_id int, product_id bigint, forecast_quantity double, experiment string"
    ),
    "demand": "date date, product_id bigint, demand double, dp_input_datasets_id int, experiment string",
    "input_demand": "date date, product_id bigint, demand double, dp_input_datasets_id int",
}

# Columns of the CSV files, after the row number that comes first in each.
ANCHOR_DAYS = "date date"
MAFE_ERRORS = (
    "anchor date, dp_input_datasets_id int, forecast_date date, region_code string, warehouse string, timeframe int, "
    + ", ".join(f"mafe_exp{k} double" for k in range(1, 9))
)
DESIGN_MATRIX = "y double, a int, b int, c int, d int, af int, bf int, cf int, df int"


def schema_of(table: str) -> StructType:
    return StructType.fromDDL(TABLE_COLUMNS[table])


def conform(df: DataFrame, table: str) -> DataFrame:
    """Pick the table's columns in order and cast those of another type.

    The cast is where text identifiers become numbers, so that later joins
    compare plain columns.
    """
    present = dict(df.dtypes)
    wanted = schema_of(table)
    missing = [field.name for field in wanted if field.name not in present]
    if missing:
        raise ValueError(f"table {table} lacks the columns {', '.join(missing)}")
    return df.select(
        *[
            F.col(field.name)
            if present[field.name] == field.dataType.simpleString()
            else F.col(field.name).cast(field.dataType).alias(field.name)
            for field in wanted
        ]
    )
