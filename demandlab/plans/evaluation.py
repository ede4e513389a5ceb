"""Forecast evaluation: how far each experiment's forecast is from actual demand.

Every function works on a table of evaluation cases (anchor date, dataset, region,
warehouse, horizon), so all anchors, warehouses and categories are judged in one
job. Facts are first reduced to one row per day and product; only then do the
cases multiply them.
"""

from __future__ import annotations

import datetime as dt
import functools
import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandlab.functions.calendar import business_horizon
from demandlab.functions.ratios import absolute_error_percent, safe_divide
from demandlab.operators.blacklist import not_listed
from demandlab.operators.datasets import ANY_WAREHOUSE, site_warehouses
from demandlab.operators.order_lines import CLOSED, kept_lines
from demandlab.operators.sku import remap_products
from demandlab.operators.zones import match_zone_groups
from demandlab.plans.demand import VARIANTS
from demandlab.session import materialize
from demandlab.sources.tables import Tables

# Owners that count as first party, days a product stays in the
# cohort after its last sale, the experiment that supplies the actual demand,
# and how far an open-ended forecast setup reaches into the future.
FIRST_PARTY_OWNERS = (1, 5354, 8354, 6104, 7404)
COHORT_DAYS = 30
ACTUALS_EXPERIMENT = "experiment_1"
OPEN_END_DAYS = 1000

EXPERIMENTS = tuple(v.experiment for v in VARIANTS)
FORECASTS = tuple(f"forecast_exp{v.number}" for v in VARIANTS)
ERRORS = tuple(f"mafe_exp{v.number}" for v in VARIANTS)

CASE = ("anchor", "dp_input_datasets_id")
CASE_COLUMNS = (*CASE, "region_code", "warehouse", "days")


def evaluation_cases(datasets: DataFrame, anchors: DataFrame | Sequence[dt.date], days: int) -> DataFrame:
    """One case per selected dataset and anchor date.

    ``datasets`` comes from ``select_datasets``. The distinct anchor dates travel
    as one array: there cannot be more of them than calendar days.
    """
    if isinstance(anchors, DataFrame):
        dates = anchors.agg(F.collect_set("date")).scalar()
    else:
        dates = F.array(*[F.lit(day) for day in anchors])
    return (
        datasets.select(
            F.col("dataset_identifier").alias("dp_input_datasets_id"), "region_code", "warehouse", dates.alias("__dates")
        )
        .select(
            F.explode("__dates").alias("anchor"),
            "dp_input_datasets_id",
            "region_code",
            "warehouse",
            F.lit(days).alias("days"),
        )
    )


def case_days(cases: DataFrame) -> DataFrame:
    """Cases with one row per day of their horizon, both ends included.

    Listing the days turns the date range into an equality, which joins by hash
    and can prune date partitions.
    """
    return cases.withColumn("day", F.explode(F.sequence("anchor", F.date_add("anchor", F.col("days"))))).drop("days")


def latest_params(tables: Tables) -> DataFrame:
    """Newest forecast setup of each dataset, with the dataset's place."""
    datasets = tables.dataset.select(F.col("id").alias("dp_input_datasets_id"), "region_code", "warehouse")
    return (
        tables.forecast_params.join(datasets, "dp_input_datasets_id", "left")
        .groupBy("dp_input_datasets_id", "region_code", "warehouse")
        .agg(F.max("id").alias("dp_forecast_params_id"))
    )


def live_setups(params: DataFrame, dataset_days: DataFrame, open_end: Column) -> DataFrame:
    """(dp_input_datasets_id, close_date, setups): how many setups are live, for the days with any.

    A sweep: a setup counts +1 on its first day and -1 behind its last, and a running
    sum per dataset gives the count on each day asked for. So the ranges are never
    compared with days one by one. ``open_end`` is the last day of an open setup.
    """
    ranges = params.select(
        "dp_input_datasets_id", F.col("start_day_live").alias("first"), F.coalesce("end_day_live", open_end).alias("last")
    ).filter("first <= last")
    change = lambda day, by: ranges.select("dp_input_datasets_id", day.alias("close_date"), F.lit(by).alias("change"))
    asked = dataset_days.select("dp_input_datasets_id", "close_date", F.lit(0).alias("change"))
    ends = change(F.col("first"), 1).union(change(F.date_add("last", 1), -1)).union(asked)
    days = ends.groupBy("dp_input_datasets_id", "close_date").agg(
        F.sum("change").alias("change"), F.bool_or(F.col("change") == 0).alias("asked")
    )
    upwards = Window.partitionBy("dp_input_datasets_id").orderBy("close_date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        days.withColumn("setups", F.sum("change").over(upwards))
        .filter(F.col("asked") & (F.col("setups") > 0))
        .select("dp_input_datasets_id", "close_date", "setups")
    )


def _with_wanted_type(cases: DataFrame, tables: Tables) -> DataFrame:
    """Add wanted_type: '3pl', '1pl' or NULL (any) after the case's warehouse."""
    kinds = (
        site_warehouses(tables)
        .groupBy("region_code", "warehouse")
        .agg(
            F.bool_or(F.col("is_3pl") == "True").alias("__third"),
            F.bool_or(F.col("is_3pl") == "False").alias("__first"),
        )
    )
    wanted = F.when(F.col("__third"), F.lit("3pl")).when(F.col("__first"), F.lit("1pl"))
    return (
        cases.join(kinds, ["region_code", "warehouse"], "left")
        .withColumn("wanted_type", wanted)
        .drop("__third", "__first")
    )


def product_sales_dates(tables: Tables, cases: DataFrame, first_anchor: Column | None = None) -> DataFrame:
    """Last sale and last first-party sale of each product in the cases' regions.

    The cohort of any anchor follows from these two dates, so the lines are
    aggregated once however many anchors there are. Older orders are left out in
    the scan already.
    """
    if first_anchor is None:
        first_anchor = cases.agg(F.min("anchor")).scalar()
    regions = cases.groupBy("region_code").agg(F.date_sub(F.min("anchor"), COHORT_DAYS).alias("__from"))
    orders = (
        tables.order_header.filter(
            (F.col("status") == CLOSED) & (F.col("close_date") >= F.date_sub(first_anchor, COHORT_DAYS))
        )
        .select("id", "region_code", "close_date")
        .join(regions, "region_code")
        .filter(F.col("close_date") >= F.col("__from"))
        .drop("__from")
    )
    lines = kept_lines(tables).select("order_id", "product_id", "owner_id")
    first_party = F.when(F.col("owner_id").isin(*FIRST_PARTY_OWNERS), F.col("close_date"))
    raw = (
        orders.join(lines, F.col("id") == F.col("order_id"))
        .groupBy("region_code", "product_id")
        .agg(F.max("close_date").alias("last_sale"), F.max(first_party).alias("last_first_party"))
    )
    return (
        remap_products(raw, tables.new_skus)
        .groupBy("region_code", "product_id")
        .agg(F.max("last_sale").alias("last_sale"), F.max("last_first_party").alias("last_first_party"))
    )


def _product_type() -> Column:
    """'1pl' when a first-party line was sold in the window before the anchor or later."""
    since = F.date_sub("anchor", COHORT_DAYS)
    return F.when(F.col("last_first_party") >= since, F.lit("1pl")).otherwise(F.lit("3pl"))


def _in_cohort() -> Column:
    sold = F.col("last_sale") >= F.date_sub("anchor", COHORT_DAYS)
    return sold & (F.col("wanted_type").isNull() | (F.col("wanted_type") == _product_type()))


def cohort_products(tables: Tables, cases: DataFrame) -> DataFrame:
    """Products judged in each case, with their type.

    A product belongs to a case when it was sold in the region from 30 days before
    the anchor on, and its type fits the warehouse.
    """
    return (
        _with_wanted_type(cases, tables)
        .join(product_sales_dates(tables, cases), "region_code")
        .filter(_in_cohort())
        .select(*CASE, "region_code", "warehouse", "product_id", _product_type().alias("warehouse_type"))
    )


def _only_cohort(rows: DataFrame, sales_dates: DataFrame, region: str = "region_code") -> DataFrame:
    """Keep rows of a case's cohort; rows carry the case and wanted_type.

    Equal to joining with ``cohort_products`` but without listing the cohort of
    every case.
    """
    dates = sales_dates.select(
        F.col("region_code").alias("__region"), F.col("product_id").alias("__product"), "last_sale", "last_first_party"
    )
    return (
        rows.join(dates, (F.col(region) == F.col("__region")) & (F.col("product_id") == F.col("__product")))
        .filter(_in_cohort())
        .drop("__region", "__product", "last_sale", "last_first_party", "wanted_type")
    )


def _with_category(rows: DataFrame, tables: Tables, category: str | None, warehouse: str) -> DataFrame:
    """Inner join with the catalog on product and warehouse; one or all categories."""
    catalog = tables.catalog if category is None else tables.catalog.filter(F.col("category") == category)
    entries = catalog.select(
        F.col("product_id").alias("__product"), F.col("warehouse").alias("__warehouse"), "category"
    )
    return rows.join(
        entries, (F.col("product_id") == F.col("__product")) & (F.col(warehouse) == F.col("__warehouse"))
    ).drop("__product", "__warehouse")


class Evaluation:
    """Evaluation of a set of cases.

    With ``by_category`` products are judged within their catalog category: one
    category if named, otherwise each of them. ``multiply_repeats`` lets several forecast
    setups of one key count as a chain of outer joins would, instead of being summed.
    """

    def __init__(
        self,
        tables: Tables,
        cases: DataFrame,
        as_of: dt.date,
        by_category: bool = False,
        category: str | None = None,
        multiply_repeats: bool = False,
    ) -> None:
        self.tables = tables
        self.multiply_repeats = multiply_repeats
        # Both are small and read by several branches. Once stored, their true
        # size is known, which decides between broadcast and shuffle.
        self.cases = materialize(_with_wanted_type(cases.select(*CASE_COLUMNS), tables), "cases")
        # The span of the cases, as literals that reach the scans of the facts.
        span = self.cases.agg(
            F.min("anchor").alias("first_anchor"),
            F.max("anchor").alias("last_anchor"),
            F.max(F.date_add("anchor", F.col("days"))).alias("last_day"),
        ).first()
        self.first_anchor, self.last_anchor, self.last_day = (F.lit(day) for day in span)
        self.sales_dates = materialize(product_sales_dates(tables, self.cases, self.first_anchor), "sales-dates")
        self.as_of = as_of
        self.by_category = by_category or category is not None
        self.category = category
        self.group = (*CASE, "category") if self.by_category else CASE

    def _categorised(self, rows: DataFrame, warehouse: str) -> DataFrame:
        return _with_category(rows, self.tables, self.category, warehouse) if self.by_category else rows

    def clean_demand(self) -> DataFrame:
        """Actual demand per case, day and product of the cohort."""
        actuals = (
            self.tables.demand.filter(
                (F.col("experiment") == ACTUALS_EXPERIMENT) & F.col("date").between(self.first_anchor, self.last_day)
            )
            .select(F.col("date").alias("close_date"), "product_id", "demand", "dp_input_datasets_id")
        )
        days = case_days(self.cases).select(
            *CASE, F.col("region_code").alias("__cohort_region"), "wanted_type", F.col("day").alias("close_date")
        )
        # Datasets with a forecast setup. A semi join, so that the optimizer knows
        # this side is no larger than the dataset table.
        places = (
            self.tables.dataset.select(F.col("id").alias("dp_input_datasets_id"), "region_code", "warehouse")
            .join(self.tables.forecast_params, "dp_input_datasets_id", "left_semi")
        )
        rows = remap_products(
            actuals.join(days, ["dp_input_datasets_id", "close_date"]).join(places, "dp_input_datasets_id"),
            self.tables.new_skus,
            units=("demand",),
        )
        members = self._categorised(_only_cohort(rows, self.sales_dates, "__cohort_region"), "warehouse")
        return members.groupBy(*self.group, "close_date", "region_code", "product_id").agg(
            F.sum("demand").alias("demand")
        )

    def daily_sales_value(self) -> DataFrame:
        """Sales value per region, warehouse, day and product, summed over live setups.

        One row of sales counts once per zone it lies in and per live setup.
        """
        tables = self.tables
        places = self.cases.select("region_code", "warehouse")
        open_end = F.date_add(F.lit(self.as_of), OPEN_END_DAYS)
        datasets = (
            tables.dataset.filter(F.col("accumulated_days") == 1)
            .select(F.col("id").alias("dp_input_datasets_id"), "region_code", "warehouse", "microzone_group_code")
            .join(places, ["region_code", "warehouse"], "left_semi")
        )
        judged_days = case_days(self.cases).select("region_code", F.col("day").alias("close_date")).distinct()
        headers = (
            tables.order_header.filter(
                (F.col("status") == CLOSED) & F.col("close_date").between(self.first_anchor, self.last_day)
            )
            .select("id", "region_code", F.col("warehouse").alias("order_warehouse"), "close_date", "latitude", "longitude")
            .join(judged_days, ["region_code", "close_date"])
        )
        dataset_days = datasets.select("dp_input_datasets_id", "region_code").join(judged_days, "region_code")
        setups = live_setups(tables.forecast_params, dataset_days, open_end)
        # A header meets one row for each of its datasets, however many setups are live.
        live = (
            match_zone_groups(headers, tables, datasets.select("microzone_group_code"))
            .join(datasets, ["region_code", "microzone_group_code"])
            .filter((F.col("warehouse") == ANY_WAREHOUSE) | (F.col("order_warehouse") == F.col("warehouse")))
            .join(setups, ["dp_input_datasets_id", "close_date"])
            .select("id", "region_code", "warehouse", "close_date", "setups")
        )
        lines = kept_lines(tables).select("order_id", "product_id", (F.col("quantity") * F.col("price")).alias("value"))
        keys = ("region_code", "warehouse", "close_date", "product_id")
        raw = (
            live.join(lines, F.col("id") == F.col("order_id"))
            .groupBy(*keys)
            .agg(F.sum(F.col("value") * F.col("setups")).alias("value"))
        )
        remapped = remap_products(raw, tables.new_skus).groupBy(*keys).agg(F.sum("value").alias("value"))
        return not_listed(remapped, tables.blacklist, "product_id", "product_id")

    def sales_share(self) -> DataFrame:
        """Each product's share of the day's sales value, among the judged products."""
        days = case_days(self.cases).select(
            *CASE, "region_code", "warehouse", "wanted_type", F.col("day").alias("close_date")
        )
        rows = self.daily_sales_value().join(days, ["region_code", "warehouse", "close_date"])
        members = self._categorised(_only_cohort(rows, self.sales_dates), "warehouse")
        summed = members.groupBy(*self.group, "close_date", "product_id").agg(F.sum("value").alias("value"))
        day = Window.partitionBy(*self.group, "close_date")
        share = safe_divide(F.col("value"), F.sum("value").over(day))
        return summed.select(*self.group, "close_date", "product_id", share.alias("share"))

    def _forecast_rows(self) -> DataFrame:
        """Forecasts made on a case's anchor for its region and warehouse."""
        made = self.tables.forecast.filter(
            F.col("experiment").isin(*EXPERIMENTS)
            & (F.col("created_on") >= self.first_anchor.cast("timestamp"))
            & (F.col("created_on") < F.date_add(self.last_anchor, 1).cast("timestamp"))
        ).withColumn("created_on", F.to_date("created_on"))
        cases = self.cases.select(*CASE, "region_code", "warehouse", "wanted_type").withColumn(
            "created_on", F.col("anchor")
        )
        rows = remap_products(
            made.join(cases, ["created_on", "region_code", "warehouse"]),
            self.tables.new_skus,
            units=("forecast_quantity",),
        )
        members = self._categorised(_only_cohort(rows, self.sales_dates), "warehouse")
        return members.withColumn("timeframe", business_horizon(F.col("created_on"), F.col("forecast_date")))

    def forecast_by_experiment(self) -> DataFrame:
        """Forecast per case, experiment, setup, date and product, with its horizon."""
        return (
            self._forecast_rows()
            .groupBy(
                *self.group,
                "experiment",
                "forecast_date",
                "created_on",
                "region_code",
                "warehouse",
                "dp_forecast_params_id",
                "timeframe",
                "product_id",
            )
            .agg(F.coalesce(F.sum("forecast_quantity"), F.lit(0.0)).alias("forecast"))
        )

    def forecast_wide(self) -> DataFrame:
        """The eight experiments side by side, 0 where one has no forecast.

        One pass with conditional sums; keys with several forecast setups (see
        ``repeated_forecasts``) are summed up. With ``multiply_repeats`` they count as in a
        chain of full outer joins on the first experiment's keys.
        """
        if self.multiply_repeats:
            return self._forecast_chain()
        return (
            self._forecast_rows()
            .groupBy(*self._wide_keys())
            .agg(
                *[
                    F.coalesce(
                        F.sum(F.when(F.col("experiment") == experiment, F.col("forecast_quantity"))), F.lit(0.0)
                    ).alias(column)
                    for experiment, column in zip(EXPERIMENTS, FORECASTS)
                ]
            )
        )

    def _wide_keys(self) -> tuple[str, ...]:
        return (*self.group, "forecast_date", "region_code", "warehouse", "product_id", "timeframe")

    def _forecast_chain(self) -> DataFrame:
        """What seven full outer joins on the first experiment's keys would sum up to, without a join.

        Where the first experiment has a key, each row of an experiment meets every
        combination of the others' rows, an experiment without rows counting as one. Where
        it has none, or the key holds a NULL, nothing is joined and every row stays alone.
        """
        of = {column: F.col("experiment") == name for name, column in zip(EXPERIMENTS, FORECASTS)}
        counted = (
            self.forecast_by_experiment()
            .groupBy(*self._wide_keys())
            .agg(
                *[F.coalesce(F.sum(F.when(chosen, F.col("forecast"))), F.lit(0.0)).alias(column) for column, chosen in of.items()],
                *[F.count_if(chosen).alias(f"__rows_{column}") for column, chosen in of.items()],
            )
        )
        rows = {column: F.col(f"__rows_{column}") for column in of}
        joined = rows[FORECASTS[0]] > 0
        for key in ("forecast_date", "product_id", "timeframe"):
            joined = joined & F.col(key).isNotNull()

        def repeats(column: str) -> Column:
            # As doubles: eight counts multiplied may pass 64 bits.
            others = (F.greatest(n, F.lit(1)).cast("double") for other, n in rows.items() if other != column)
            return F.when(joined, functools.reduce(operator.mul, others)).otherwise(1.0)

        return counted.select(*self._wide_keys(), *[(F.col(column) * repeats(column)).alias(column) for column in of])

    def repeated_forecasts(self) -> DataFrame:
        """Keys with several forecast setups, where a join chain counts every combination."""
        keys = (*self.group, "experiment", "forecast_date", "product_id", "timeframe")
        return (
            self.forecast_by_experiment().groupBy(*keys).agg(F.count(F.lit(1)).alias("setups")).filter("setups > 1")
        )

    def product_errors(self, with_region: bool = False) -> DataFrame:
        """Error of each experiment per forecast date and product, with its weight.

        The weight (share) is renormalised within date and horizon over the
        products that have both a forecast and demand.
        """
        actuals = self.clean_demand().select(
            *self.group, F.col("close_date").alias("forecast_date"), "product_id", "region_code", "demand"
        )
        shares = self.sales_share().withColumnRenamed("close_date", "forecast_date")
        keys = [*self.group, "forecast_date", "product_id"]
        forecasts = self.forecast_wide().withColumnRenamed("region_code", "__forecast_region")
        matched = (
            forecasts.join(actuals, keys)
            .join(shares, keys, "left")
            .withColumn("region_code", F.coalesce("region_code", "__forecast_region"))
        )
        place = ["region_code"] if with_region else []
        demand = F.coalesce(F.col("demand"), F.lit(0.0))
        # The join keys are among the grouping keys, so this needs no new shuffle.
        grouped = matched.groupBy(*keys, *place, "warehouse", "timeframe", "share").agg(
            F.sum(demand).alias("demand"),
            *[F.sum(name).alias(name) for name in FORECASTS],
            *[F.sum(F.abs(F.col(f) - demand)).alias(f"__off_{f}") for f in FORECASTS],
        )
        day = Window.partitionBy(*self.group, "forecast_date", "timeframe")
        total = F.sum("share").over(day)
        weight = F.coalesce(F.when(total > 0, F.col("share") / F.nullif(total, F.lit(0.0))).otherwise(0.0), F.lit(0.0))
        errors = [
            absolute_error_percent(F.col("demand"), F.col(f), F.col(f"__off_{f}")).alias(error)
            for f, error in zip(FORECASTS, ERRORS)
        ]
        return grouped.select(
            *self.group,
            "forecast_date",
            *place,
            "warehouse",
            "product_id",
            "timeframe",
            "demand",
            *FORECASTS,
            *errors,
            weight.alias("share"),
        )

    def warehouse_errors(self) -> DataFrame:
        """Weighted error of each experiment per forecast date and horizon.

        With categories this is the error within the category.
        """
        return (
            self.product_errors(with_region=True)
            .groupBy(*self.group, "forecast_date", "region_code", "warehouse", "timeframe")
            .agg(*[F.sum(F.col(error) * F.col("share")).alias(error) for error in ERRORS])
        )
