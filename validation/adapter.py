"""Builds the engine's input tables from the driver's parquet files.

Only this package knows those files; ``views.py`` holds the same derivations in
SQL for the check.
"""

from __future__ import annotations

import datetime as dt
import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlab.operators.datasets import select_datasets
from demandlab.plans.demand import VARIANT, VARIANTS, build_demand, build_line_state
from demandlab.plans.evaluation import case_days, evaluation_cases
from demandlab.session import fresh_path, materialize
from demandlab.sources.tables import Tables

AS_OF = dt.date(2001, 7, 31)
HORIZON_DAYS = 40
# Twelve anchors in May and June 2001, among them Sunday 2001-05-27.
ANCHORS = tuple(
    dt.date(2001, month, day)
    for month, day in (
        (5, 2), (5, 5), (5, 8), (5, 11), (5, 15), (5, 22), (5, 27), (5, 30), (6, 4), (6, 8), (6, 13), (6, 19),
    )
)


# Zone 1 has a hole, zone 2 overlaps zone 1 and is stored twice, zone 3 is an L
# with a second part, a triangle. No point of the 0.1 grid lies on an edge.
ZONES = """
    (1, array(array(named_struct('x', 0.05D, 'y', 0.05D), named_struct('x', 5.05D, 'y', 0.05D),
                    named_struct('x', 5.05D, 'y', 6.05D), named_struct('x', 0.05D, 'y', 6.05D)),
              array(named_struct('x', 1.05D, 'y', 1.05D), named_struct('x', 2.05D, 'y', 1.05D),
                    named_struct('x', 2.05D, 'y', 2.05D), named_struct('x', 1.05D, 'y', 2.05D)))),
    (2, array(array(named_struct('x', 3.05D, 'y', 2.05D), named_struct('x', 7.05D, 'y', 2.05D),
                    named_struct('x', 7.05D, 'y', 7.05D), named_struct('x', 3.05D, 'y', 7.05D)))),
    (3, array(array(named_struct('x', 5.05D, 'y', 0.05D), named_struct('x', 9.65D, 'y', 0.05D),
                    named_struct('x', 9.65D, 'y', 8.85D), named_struct('x', 7.05D, 'y', 8.85D),
                    named_struct('x', 7.05D, 'y', 4.05D), named_struct('x', 5.05D, 'y', 4.05D)))),
    (2, array(array(named_struct('x', 3.05D, 'y', 2.05D), named_struct('x', 7.05D, 'y', 2.05D),
                    named_struct('x', 7.05D, 'y', 7.05D), named_struct('x', 3.05D, 'y', 7.05D)))),
    (3, array(array(named_struct('x', 0.05D, 'y', 7.05D), named_struct('x', 4.05D, 'y', 7.05D),
                    named_struct('x', 0.05D, 'y', 8.55D))))"""
GROUP_ZONES = "('ALL', 1), ('ALL', 2), ('ALL', 3), ('W0', 1), ('W0', 2), ('W1', 2), ('W1', 3), ('W2', 1), ('W2', 3)"


def _each(table: DataFrame, names: str, rows: str) -> DataFrame:
    """``table`` with each of the literal rows beside every row."""
    return table.selectExpr("*", f"inline(array({rows})) AS ({names})")


@functools.cache
def source_tables(spark: SparkSession, sf_dir: str) -> Tables:
    """Everything but the engine's own outputs (demand, forecast).

    What is kept per session is the plan, not the data.
    """

    def read(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    region = read("region").selectExpr("r_regionkey AS site_id", "r_name AS region_code")
    customer = (
        read("customer")
        .join(read("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("site_id"))
        .select("c_custkey", "c_mktsegment", "c_acctbal", "region_code")
    )
    order_header = (
        read("orders")
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .selectExpr(
            "o_orderkey AS id",
            "o_custkey AS user_id",
            "region_code",
            "concat('W', o_custkey % 3) AS warehouse",
            "c_mktsegment AS tag_name",
            "CASE WHEN o_orderstatus = 'P' THEN 0 ELSE 1 END AS status",
            "CAST(o_orderdate AS DATE) AS close_date",
            "(o_custkey % 97) / 10 AS latitude",
            "(o_custkey % 89) / 10 AS longitude",
        )
    )
    lineitem, part = read("lineitem"), read("part")
    third_party = "l_partkey % 50 % 4 = 0 OR (l_partkey % 50 % 4 = 1 AND l_suppkey % 2 = 1)"
    order_line = lineitem.join(part, F.col("l_partkey") == F.col("p_partkey")).selectExpr(
        "l_orderkey AS order_id",
        "l_partkey % 50 AS product_id",
        "CASE WHEN l_orderkey % 45 = 7 THEN 2000.0D ELSE l_quantity + l_suppkey % 8 / 8D END AS quantity",
        "p_retailprice AS price",
        "CASE WHEN l_returnflag = 'R' THEN 'true' ELSE 'false' END AS is_deleted",
        f"CASE WHEN {third_party} THEN 99L ELSE 1L END AS owner_id",
    )
    products = part.selectExpr("p_partkey % 50 AS product_id").distinct()
    new_skus = products.filter("product_id % 10 IN (7, 9)").selectExpr(
        "product_id AS old_product_id",
        "product_id - 1 AS new_product_id",
        "CASE WHEN product_id % 10 = 9 THEN 4.0D ELSE 0.5D END AS old_units_per_new_unit",
    )
    catalog = products.selectExpr(
        "product_id",
        "explode(array('ALL', 'W0', 'W1', 'W2')) AS warehouse",
        "CASE WHEN product_id % 3 = 0 THEN 'FRUVER' ELSE 'OTHER' END AS category",
    )
    stockout = (
        lineitem.filter("l_returnflag = 'N' AND l_linenumber = 1")
        .join(order_header, F.col("l_orderkey") == F.col("id"))
        .selectExpr(
            "CAST(l_shipdate AS DATE) AS close_date",
            "l_partkey % 50 AS product_id",
            "region_code",
            "warehouse",
            "l_quantity / 2 AS stockout_demand",
        )
    )
    blacklist = (
        customer.filter("c_acctbal < -500").selectExpr("c_custkey AS element_id", "'user_id' AS type", "region_code")
        .unionByName(
            order_header.filter("id % 211 = 0").selectExpr("id AS element_id", "'order_id' AS type", "region_code")
        )
        .unionByName(
            region.filter("region_code IN ('AFRICA', 'ASIA')").selectExpr(
                "13L AS element_id", "'product_id' AS type", "region_code"
            )
        )
        # An entry without id: the region's list then admits nobody.
        .unionByName(region.filter("site_id = 4").selectExpr("CAST(NULL AS BIGINT) AS element_id", "'user_id' AS type", "region_code"))
    )
    dataset = _each(
        region, "n, warehouse, accumulated_days", "(0, 'ALL', 1), (1, 'W0', 1), (2, 'W1', 1), (3, 'W2', 1), (9, 'ALL', 7)"
    ).selectExpr(
        "site_id * 10 + n AS id",
        "region_code",
        "warehouse",
        "concat('G', site_id, '_', warehouse) AS microzone_group_code",
        "accumulated_days",
        "0.5D AS stockout_weight",
    )
    # Two setups per dataset; neither is live on all days.
    forecast_params = dataset.selectExpr("id AS dp_input_datasets_id", "explode(array(0, 1)) AS n").selectExpr(
        "dp_input_datasets_id * 2 + n AS id",
        "dp_input_datasets_id",
        "CASE n WHEN 0 THEN DATE'1995-01-01' ELSE DATE'2001-05-10' END AS start_day_live",
        "CASE WHEN n = 0 THEN DATE'2001-05-20' WHEN dp_input_datasets_id % 2 = 1 THEN DATE'2001-07-15' END AS end_day_live",
    )
    return Tables(
        {
            # The first two regions stand for the two countries.
            "country": region.filter("site_id < 2").selectExpr(
                "site_id AS country_id", "concat('C', site_id) AS identifier_value"
            ),
            "site": region.selectExpr("site_id", "region_code AS identifier_value", "site_id % 2 AS country_id"),
            "warehouse": _each(
                region, "identifier_value, is_3pl", "('W0', 'False'), ('W1', 'False'), ('W2', 'True')"
            ),
            "dataset": dataset,
            "forecast_params": forecast_params,
            "microzone_group": _each(region, "warehouse, number", GROUP_ZONES).selectExpr(
                "concat('G', site_id, '_', warehouse) AS microzone_group_code", "site_id * 10 + number AS microzone_id"
            ),
            "microzone": _each(region, "number, boundaries", ZONES).selectExpr(
                "site_id * 10 + number AS microzone_id", "site_id", "boundaries"
            ),
            "order_header": order_header,
            "order_line": order_line,
            "new_skus": new_skus,
            "customer_config": _each(
                region.withColumnRenamed("region_code", "region"),
                "tag_name, warehouse, warehouse_vip",
                "('BUILDING', 'W1', 'true'), ('MACHINERY', 'W0', 'true'), "
                "('MACHINERY', 'W1', 'true'), ('FURNITURE', 'W0', 'false')",
            ),
            "blacklist": blacklist,
            "stockout_by_warehouse": stockout,
            "stockout_by_region": stockout.drop("warehouse"),
            "catalog": catalog,
        }
    )


@functools.cache
def line_state(spark: SparkSession, sf_dir: str, dataset_id: int | None = None) -> str:
    """A stored line state of all months before that of ``AS_OF``, as daily runs have left it; a session builds it once per data folder."""
    path = fresh_path(spark, "line-state")
    table = path.rsplit("/", 1)[-1].replace("-", "_")
    build_line_state(spark, source_tables(spark, sf_dir), table, AS_OF.replace(day=1) - dt.timedelta(days=1), dataset_id=dataset_id, location=path)
    return table


def all_cases(tables: Tables) -> DataFrame:
    """Every daily dataset on every anchor."""
    return evaluation_cases(select_datasets(tables), ANCHORS, HORIZON_DAYS)


def _forecasts(tables: Tables, demand: DataFrame, cases: DataFrame, setups: DataFrame | None = None) -> DataFrame:
    """Stand-in forecasts: demand scaled per experiment, some products left out.

    Half of the experiments use retired codes for some products, so that the
    product map has something to do. ``setups`` (dp_input_datasets_id, date, params)
    names the setups that forecast a day instead of the dataset's newest.
    """
    newest = tables.forecast_params.groupBy("dp_input_datasets_id").agg(F.max("id").alias("params"))
    days = case_days(cases).withColumnRenamed("day", "date")
    days = days.join(newest, "dp_input_datasets_id") if setups is None else days.join(setups, ["dp_input_datasets_id", "date"])
    return (
        demand.join(days, ["dp_input_datasets_id", "date"])
        .selectExpr("*", f"explode(array({', '.join(str(v.number) for v in VARIANTS)})) AS k")
        .filter("product_id % 8 <> k - 1")
        .selectExpr("*", "product_id % 10 = 8 AND k % 2 = 0 AS retired", "demand * (1 + k / 16) AS amount")
        .selectExpr(
            "date AS forecast_date",
            "CAST(anchor AS TIMESTAMP) AS created_on",
            "region_code",
            "warehouse",
            "params AS dp_forecast_params_id",
            "CASE WHEN retired THEN product_id + 1 ELSE product_id END AS product_id",
            "CASE WHEN retired THEN amount / 4 ELSE amount END AS forecast_quantity",
            "concat('experiment_', k) AS experiment",
        )
    )


@functools.cache
def evaluation_tables(spark: SparkSession, sf_dir: str) -> tuple[Tables, DataFrame]:
    """Tables with stored demand and forecasts, and the cases to judge.

    As in production, the demand is built and stored before it is judged; a
    session does so once per data folder.
    """
    tables = source_tables(spark, sf_dir)
    cases = all_cases(tables)
    demand = materialize(build_demand(tables, AS_OF, [VARIANT[1]]), "demand")
    return tables.replacing(demand=demand, forecast=_forecasts(tables, demand, cases)), cases


@functools.cache
def repeated_setup_tables(spark: SparkSession, sf_dir: str) -> tuple[Tables, DataFrame]:
    """The same with forecasts of every setup live on a day: two where both are, in the first four experiments."""
    tables, cases = evaluation_tables(spark, sf_dir)
    days = case_days(cases).select("dp_input_datasets_id", F.col("day").alias("date")).distinct()
    live = F.col("date").between(F.col("start_day_live"), F.coalesce("end_day_live", F.date_add(F.lit(AS_OF), 1000)))
    setups = (
        tables.forecast_params.join(days, "dp_input_datasets_id").filter(live)
        .select("dp_input_datasets_id", "date", F.col("id").alias("params"))
    )
    older = F.col("dp_forecast_params_id") % 2 == 0
    made = _forecasts(tables, tables.demand, cases, setups).filter(~older | (F.col("experiment") <= "experiment_4"))
    return tables.replacing(forecast=made), cases
