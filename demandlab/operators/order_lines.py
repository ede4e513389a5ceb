"""Order lines of each dataset: zone orders plus key-account orders."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandlab.functions.calendar import is_working_day
from demandlab.operators.blacklist import flag_listed, not_listed
from demandlab.operators.datasets import ANY_WAREHOUSE
from demandlab.operators.zones import match_zone_groups
from demandlab.sources.tables import Tables

CLOSED = 1


def closed_orders(tables: Tables, as_of: dt.date, since: dt.date | None = None) -> DataFrame:
    """Headers of closed orders up to ``as_of``, without Sundays; those before ``since`` are left out if given."""
    headers = tables.order_header.filter(
        (F.col("status") == CLOSED)
        & (F.col("close_date") <= F.lit(as_of))
        & is_working_day(F.col("close_date"))
    )
    return headers if since is None else headers.filter(F.col("close_date") >= F.lit(since))


def kept_lines(tables: Tables) -> DataFrame:
    """Lines that were not deleted."""
    return tables.order_line.filter(F.col("is_deleted") == "false")


def key_accounts(tables: Tables) -> DataFrame:
    """Customer tags that a warehouse serves as key accounts."""
    return tables.customer_config.filter(F.col("warehouse_vip") == "true").select(
        F.col("region").alias("region_code"), "tag_name", F.col("warehouse").alias("account_warehouse")
    )


_HEADER = ("id", "user_id", "close_date", "region_code")
_ROUTED = (*_HEADER, "dataset_identifier", "stockout_weight")


def zone_orders(tables: Tables, datasets: DataFrame, as_of: dt.date, since: dt.date | None = None) -> DataFrame:
    """Orders inside a dataset's zones.

    Key-account orders stay out of single-warehouse datasets. A dataset over all
    warehouses keeps them, once per matching account row. Only headers and zones
    of the datasets' regions and groups are matched.
    """
    headers = closed_orders(tables, as_of, since).join(datasets.select("region_code"), "region_code", "left_semi")
    placed = match_zone_groups(
        headers.select(*_HEADER, "tag_name", "latitude", "longitude"), tables, datasets.select("microzone_group_code")
    )
    routed = placed.join(datasets, ["region_code", "microzone_group_code"])
    return (
        routed.join(key_accounts(tables), ["region_code", "tag_name"], "left")
        .filter(F.col("account_warehouse").isNull() | (F.col("warehouse") == ANY_WAREHOUSE))
        .select(*_ROUTED)
    )


def key_account_orders(tables: Tables, datasets: DataFrame, as_of: dt.date, since: dt.date | None = None) -> DataFrame:
    """Orders of key accounts, for the dataset of the warehouse that serves them."""
    single = datasets.filter(F.col("warehouse") != ANY_WAREHOUSE)
    accounts = key_accounts(tables).withColumnRenamed("account_warehouse", "warehouse")
    return (
        closed_orders(tables, as_of, since)
        .select(*_HEADER, "tag_name")
        .join(accounts, ["region_code", "tag_name"])
        .join(single, ["region_code", "warehouse"])
        .select(*_ROUTED)
    )


def lines_of(orders: DataFrame, tables: Tables, flag_users: bool = True) -> DataFrame:
    """Attach the lines to routed orders and apply the order and product lists.

    The order list is applied to the headers, before the join with the lines.
    With ``flag_users`` the column user_listed tells whether the customer is
    listed; leave it out where no result depends on it.
    """
    allowed = not_listed(orders, tables.blacklist, "order_id", "id")
    if flag_users:
        allowed = flag_listed(allowed, tables.blacklist, "user_id", "user_id", "user_listed")
    lines = kept_lines(tables).select("order_id", "product_id", "quantity")
    joined = allowed.join(lines, F.col("id") == F.col("order_id"))
    return not_listed(joined, tables.blacklist, "product_id", "product_id").select(
        "close_date",
        "product_id",
        "quantity",
        F.col("dataset_identifier").alias("dp_input_datasets_id"),
        "region_code",
        "stockout_weight",
        *(["user_listed"] if flag_users else []),
    )


def order_lines(
    tables: Tables,
    datasets: DataFrame,
    as_of: dt.date,
    flag_users: bool = True,
    since: dt.date | None = None,
) -> DataFrame:
    """All lines of all datasets, duplicates kept: overlapping zones count twice.

    Zone and key-account orders are united as headers, so the big join with the
    lines runs once. With ``since`` only headers from that day on are read, and
    their few ids are what the lines meet.
    """
    routed = zone_orders(tables, datasets, as_of, since).unionByName(key_account_orders(tables, datasets, as_of, since))
    return lines_of(routed, tables, flag_users)


def without_listed_users(lines: DataFrame) -> DataFrame:
    """Lines left when the customer list is applied too."""
    return lines.filter(~F.col("user_listed"))
