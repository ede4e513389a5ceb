"""Daily demand per dataset and product in up to eight variants, in one job."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlab.operators.datasets import select_datasets
from demandlab.operators.order_lines import order_lines
from demandlab.operators.outliers import (
    GROUP,
    LINE_COUNT,
    SIGMAS,
    count_lines,
    line_thresholds,
    smooth_days,
)
from demandlab.operators.sku import remap_products
from demandlab.operators.stockouts import stockouts_by_warehouse
from demandlab.session import intermediate_results, materialize
from demandlab.sources.demand_table import create_demand_table, replace_dataset, replace_day
from demandlab.sources.line_state import create_line_state, month_of, replace_all, replace_month, stored_counts
from demandlab.sources.tables import Tables

DAY_KEYS = ("date", "product_id", "dp_input_datasets_id")


@dataclass(frozen=True)
class Variant:
    """One combination of the four cleaning steps."""

    number: int
    sigma_lines: bool
    percentile_lines: bool
    user_list: bool
    smooth: bool

    @property
    def experiment(self) -> str:
        return f"experiment_{self.number}"

    @property
    def population(self) -> str:
        """The lines that the thresholds are taken from."""
        return "open" if self.user_list else "all"

    @property
    def needs_thresholds(self) -> bool:
        return self.sigma_lines or self.percentile_lines


def _variant(number: int) -> Variant:
    # A half-fraction design: three free on/off steps count up in binary and the
    # fourth is on when an odd number of them is on.
    sigma, percentile, users = (bool((number - 1) >> bit & 1) for bit in range(3))
    return Variant(number, sigma, percentile, users, sigma ^ percentile ^ users)


VARIANTS = tuple(_variant(number) for number in range(1, 9))
VARIANT = {variant.number: variant for variant in VARIANTS}


def _populations(variants: Iterable[Variant]) -> dict[str, Column]:
    names = {v.population for v in variants if v.needs_thresholds}
    counts = {
        "all": F.col(LINE_COUNT),
        "open": F.when(F.col("user_listed"), F.lit(0)).otherwise(F.col(LINE_COUNT)),
    }
    return {name: counts[name] for name in sorted(names)}


def _kept(variant: Variant) -> Column:
    """Whether the variant keeps a counted line.

    A threshold drops lines without quantity or without product.
    """
    conditions = []
    if variant.user_list:
        conditions.append(~F.col("user_listed"))
    suffix = variant.population
    if variant.needs_thresholds:
        conditions.append(F.col("product_id").isNotNull())
    if variant.sigma_lines:
        bound = F.col(f"average_{suffix}") + F.col(f"std_dev_{suffix}") * SIGMAS
        conditions.append(F.col("quantity") <= bound)
    if variant.percentile_lines:
        conditions.append(F.col("quantity") <= F.col(f"p99_{suffix}"))
    keep = F.lit(True)
    for condition in conditions:
        keep = keep & condition
    return keep


def kept_quantities(
    lines: DataFrame, new_skus: DataFrame, variants: Sequence[Variant], day: dt.date | None = None
) -> DataFrame:
    """Each variant's remapped quantity, one column per variant named like its experiment.

    Rows are (date, product_id, dp_input_datasets_id) and are still to be summed.
    A column is NULL where its variant keeps no line, and 0 where it keeps only
    lines without quantity. With ``day`` only its lines go on; the thresholds
    still come from all lines.
    """
    on_day = F.lit(True) if day is None else F.col("close_date") == F.lit(day)
    if any(v.needs_thresholds for v in variants):
        # Thresholds and demand both read the counts, so the lines are read once, here.
        counted = materialize(count_lines(lines), "counted-lines")
        return counted_quantities(counted.filter(on_day), counted, new_skus, variants)
    keys = [*GROUP, "close_date", *(["user_listed"] if "user_listed" in lines.columns else [])]
    summed = lines.filter(on_day).groupBy(*keys).agg(F.sum("quantity").alias("quantity"))
    return _amounts(summed, F.col("quantity"), new_skus, variants)


def counted_quantities(counted: DataFrame, history: DataFrame, new_skus: DataFrame, variants: Sequence[Variant]) -> DataFrame:
    """As ``kept_quantities`` from counted lines, with thresholds from the counted lines of ``history``."""
    if any(v.needs_thresholds for v in variants):
        thresholds = line_thresholds(
            history,
            _populations(variants),
            sigma=sorted({v.population for v in variants if v.sigma_lines}),
            percentile=sorted({v.population for v in variants if v.percentile_lines}),
        )
        # The null-safe comparison keeps lines without product.
        renamed = thresholds.withColumnsRenamed({name: f"__{name}" for name in GROUP})
        same_group = [F.col(name).eqNullSafe(F.col(f"__{name}")) for name in GROUP]
        counted = counted.join(renamed, same_group).drop(*[f"__{name}" for name in GROUP])
    return _amounts(counted, F.col(LINE_COUNT) * F.col("quantity"), new_skus, variants)


def _amounts(counted: DataFrame, quantity: Column, new_skus: DataFrame, variants: Sequence[Variant]) -> DataFrame:
    amounts = counted.select(
        F.col("close_date").alias("date"),
        *GROUP,
        *[F.when(_kept(v), F.coalesce(quantity, F.lit(0.0))).alias(v.experiment) for v in variants],
    )
    return remap_products(amounts, new_skus, units=tuple(v.experiment for v in variants))


def sum_by_day(rows: DataFrame, variants: Sequence[Variant]) -> DataFrame:
    return rows.groupBy(*DAY_KEYS).agg(*[F.sum(v.experiment).alias(v.experiment) for v in variants])


def line_demand(
    tables: Tables, datasets: DataFrame, as_of: dt.date, variant: Variant
) -> DataFrame:
    """Demand from lines alone, before stockouts, with the dataset's attributes."""
    lines = order_lines(tables, datasets, as_of, flag_users=variant.user_list)
    summed = sum_by_day(kept_quantities(lines, tables.new_skus, [variant]), [variant])
    attributes = datasets.select(
        F.col("dataset_identifier").alias("dp_input_datasets_id"), "region_code", "stockout_weight"
    )
    return (
        summed.filter(F.col(variant.experiment).isNotNull())
        .join(attributes, "dp_input_datasets_id")
        .select(*DAY_KEYS, "region_code", "stockout_weight", F.col(variant.experiment).alias("quantity"))
    )


def combine_with_stockouts(rows: DataFrame, stockouts: DataFrame, variants: Sequence[Variant]) -> DataFrame:
    """Add stockouts to every variant, per day.

    Equal to a full outer join of the two daily tables on (dataset, product, date)
    followed by a sum, because stockouts are one row per key: appending the rows
    and summing once needs a single shuffle with partial sums.
    """
    lost = stockouts.select(
        F.col("close_date").alias("date"),
        "product_id",
        F.col("dataset_identifier").alias("dp_input_datasets_id"),
        *[F.col("stockouts").alias(v.experiment) for v in variants],
    )
    return sum_by_day(rows.unionByName(lost), variants)


def wide_demand(
    lines: DataFrame,
    stockouts: DataFrame,
    new_skus: DataFrame,
    variants: Sequence[Variant],
    day: dt.date | None = None,
) -> DataFrame:
    """Unsmoothed demand per day and product, one column per variant."""
    return combine_with_stockouts(kept_quantities(lines, new_skus, variants, day), stockouts, variants)


def _long(wide: DataFrame, variants: Sequence[Variant]) -> DataFrame:
    rows = wide.unpivot(list(DAY_KEYS), [v.experiment for v in variants], "experiment", "demand")
    return rows.filter(F.col("demand").isNotNull()).select(
        "date", "product_id", "demand", "dp_input_datasets_id", "experiment"
    )


def build_demand(
    tables: Tables,
    as_of: dt.date,
    variants: Sequence[Variant] = VARIANTS,
    country: str | None = None,
    dataset_id: int | None = None,
    restriction: Column | None = None,
    day: dt.date | None = None,
    state: str | None = None,
) -> DataFrame:
    """Daily demand of the chosen variants as one long table.

    ``restriction`` is a condition on date, product_id and dp_input_datasets_id of
    the finished days; thresholds and z-scores still use the whole history.
    ``day`` restricts to one date, whose mean is the demand itself, so smoothing
    changes nothing: days before it are needed for the line thresholds alone.
    The lines are read, joined and counted once for all variants. With ``day`` and
    the stored line state named ``state`` (see ``refresh_line_state``) no line is
    read: the day's counts and the thresholds both come from the state.
    """
    if state is not None:
        if day is None or restriction is not None:
            raise ValueError("the line state serves one day without a restriction")
        return _long(_day_from_state(tables, as_of, variants, country, dataset_id, day, state), variants)
    datasets = select_datasets(tables, country, dataset_id)
    lines = order_lines(tables, datasets, as_of, flag_users=any(v.user_list for v in variants))
    stockouts = stockouts_by_warehouse(tables, datasets, as_of, day)
    wide = wide_demand(lines, stockouts, tables.new_skus, variants, day)
    smoothed = [v.experiment for v in variants if v.smooth and day is None]
    if smoothed:
        wide = smooth_days(wide, smoothed, restriction)
    elif restriction is not None:
        wide = wide.filter(restriction)
    return _long(wide, variants)


def _day_from_state(
    tables: Tables, as_of: dt.date, variants: Sequence[Variant], country: str | None, dataset_id: int | None, day: dt.date, state: str
) -> DataFrame:
    datasets = select_datasets(tables, country, dataset_id)
    ids = datasets.select(F.col("dataset_identifier").alias("dp_input_datasets_id"))
    history = stored_counts(tables.dataset.sparkSession, state, as_of).join(ids, "dp_input_datasets_id", "left_semi")
    if dataset_id is not None:  # a literal that prunes the state's partitions
        history = history.filter(F.col("dp_input_datasets_id") == dataset_id)
    counted = history.filter(F.col("close_date") == F.lit(day))
    if any(v.needs_thresholds for v in variants):
        # Only products sold on the day need thresholds. Both sides read the day's few rows.
        counted = materialize(counted, "counted-day")
        sold = counted.select(*[F.col(name).alias(f"__{name}") for name in GROUP]).distinct()
        history = history.join(sold, [F.col(name).eqNullSafe(F.col(f"__{name}")) for name in GROUP], "left_semi")
    rows = counted_quantities(counted, history, tables.new_skus, variants)
    return combine_with_stockouts(rows, stockouts_by_warehouse(tables, datasets, as_of, day), variants)


def build_line_state(
    spark: SparkSession,
    tables: Tables,
    state: str,
    as_of: dt.date,
    country: str | None = None,
    dataset_id: int | None = None,
    location: str | None = None,
) -> None:
    """Count all lines up to ``as_of`` into the table ``state``, in place of what it holds."""
    create_line_state(spark, state, location)
    replace_all(count_lines(order_lines(tables, select_datasets(tables, country, dataset_id), as_of)), state)


def refresh_line_state(
    spark: SparkSession,
    tables: Tables,
    state: str,
    as_of: dt.date,
    country: str | None = None,
    dataset_id: int | None = None,
    location: str | None = None,
) -> None:
    """Count the lines of the month of ``as_of`` again, up to that day, and replace the month.

    A daily run does so for its own day; for late or corrected lines of an old month
    give its last day. Only headers of the month are read. The country and dataset are
    those the state was built with.
    """
    create_line_state(spark, state, location)
    datasets = select_datasets(tables, country, dataset_id)
    replace_month(count_lines(order_lines(tables, datasets, as_of, since=month_of(as_of)[0])), state, as_of)


def run_demand(
    spark: SparkSession,
    tables: Tables,
    table: str,
    country: str,
    dataset_id: int,
    as_of: dt.date,
    initial_load: bool = False,
    location: str | None = None,
    state: str | None = None,
) -> None:
    """Build all eight variants of a dataset and store them.

    An initial load replaces the dataset; a daily run replaces the day ``as_of``.
    Either way there is a single write, so a rerun gives the same table. With the
    dataset's line state named ``state`` a daily run reads the lines of its own month alone,
    counts them into the state, and takes the thresholds from there.
    """
    create_demand_table(spark, table, location)
    with intermediate_results(spark):
        if initial_load:
            replace_dataset(build_demand(tables, as_of, VARIANTS, country, dataset_id), table, dataset_id)
        else:
            if state is not None:
                refresh_line_state(spark, tables, state, as_of, country, dataset_id)
            day = build_demand(tables, as_of, VARIANTS, country, dataset_id, day=as_of, state=state)
            replace_day(day, table, dataset_id, as_of)
