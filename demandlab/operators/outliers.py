"""Line thresholds per dataset and raw product, and smoothing of outlying days.

Lines are first counted per (dataset, product, day, quantity). Everything after
that works on counts, so a product with very many lines is only as large as its
number of distinct days and quantities.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandlab.functions.ratios import safe_divide
from demandlab.session import materialize

# Width of the line bound, the line percentile, the day bound.
SIGMAS = 6
LINE_PERCENTILE = 0.99
DAY_Z_BOUND = 2.81

# Ranges of quantities, in which ranks are looked for, to each doubling; a range with
# more distinct quantities than that is split into so many parts, again and again.
RANGES = 1024
MOST_IN_RANGE = 10_000
PARTS = 1024

GROUP = ("dp_input_datasets_id", "product_id")
LINE_COUNT = "line_count"


def count_lines(lines: DataFrame) -> DataFrame:
    """Number of equal lines per dataset, product, day and quantity (and user flag)."""
    keys = [*GROUP, "close_date", "quantity", *(["user_listed"] if "user_listed" in lines.columns else [])]
    return lines.groupBy(*keys).agg(F.count(F.lit(1)).alias(LINE_COUNT))


def _histogram(counted: DataFrame, populations: Mapping[str, Column]) -> DataFrame:
    """Lines of each population per dataset, product and distinct quantity; unknown quantities count 0."""
    known = F.col("quantity").isNotNull()
    return counted.groupBy(*GROUP, "quantity").agg(
        *[F.sum(F.when(known, n).otherwise(F.lit(0))).alias(f"n_{name}") for name, n in populations.items()]
    )


def _same(left: DataFrame, right: DataFrame, *keys: str, how: str = "inner") -> DataFrame:
    """Join in which NULL keys are equal."""
    renamed = right.withColumnsRenamed({key: f"__{key}" for key in keys})
    condition = [F.col(key).eqNullSafe(F.col(f"__{key}")) for key in keys]
    return left.join(renamed, condition, how).drop(*[f"__{key}" for key in keys])


def _means(histogram: DataFrame, populations: Sequence[str]) -> DataFrame:
    """total_<name> and average_<name> per group."""
    sums = histogram.groupBy(*GROUP).agg(
        *[F.sum(f"n_{p}").alias(f"total_{p}") for p in populations],
        *[F.sum(F.col(f"n_{p}") * F.col("quantity")).alias(f"sum_{p}") for p in populations],
    )
    averages = [safe_divide(F.col(f"sum_{p}"), F.col(f"total_{p}").cast("double")).alias(f"average_{p}") for p in populations]
    return sums.select(*GROUP, *[f"total_{p}" for p in populations], *averages)


def _deviations(histogram: DataFrame, means: DataFrame, populations: Sequence[str]) -> DataFrame:
    """std_dev_<name> per group from the squared distances to the mean: a second pass, with partial sums."""
    square = lambda p: F.col(f"n_{p}") * (F.col("quantity") - F.col(f"average_{p}")) * (F.col("quantity") - F.col(f"average_{p}"))
    sums = _same(histogram, means, *GROUP).groupBy(*GROUP).agg(
        *[F.sum(square(p)).alias(f"squares_{p}") for p in populations], *[F.max(f"total_{p}").alias(f"total_{p}") for p in populations]
    )
    spread = lambda p: F.sqrt(safe_divide(F.col(f"squares_{p}"), (F.col(f"total_{p}") - 1).cast("double")))
    return sums.select(*GROUP, *[F.coalesce(spread(p), F.lit(0.0)).alias(f"std_dev_{p}") for p in populations])


def _range() -> Column:
    """The range of a quantity: ``RANGES`` to each doubling, in the order of the quantities."""
    steps = F.floor(F.log2(F.abs("quantity") + 1) * RANGES)
    return (F.signum("quantity") * steps).cast("long")


def _near_ranks(histogram: DataFrame, means: DataFrame, populations: Sequence[str]) -> DataFrame:
    """The quantities in the ranges that hold a wanted rank, with the lines before the range.

    Only sums per range are counted up in a window; the quantities of all other
    ranges go no further.
    """
    position = lambda p: (F.col(f"total_{p}") - 1) * F.lit(LINE_PERCENTILE)
    rows = histogram.filter(F.col("quantity").isNotNull()).withColumn("range", _range())
    sums = rows.groupBy(*GROUP, "range").agg(*[F.sum(f"n_{p}").alias(f"n_{p}") for p in populations])
    upwards = Window.partitionBy(*GROUP).orderBy("range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = _same(sums.withColumns({f"upto_{p}": F.sum(f"n_{p}").over(upwards) for p in populations}), means, *GROUP)
    wanted = F.lit(False)
    for p in populations:
        wanted |= (F.col(f"upto_{p}") > F.floor(position(p))) & (F.col(f"upto_{p}") - F.col(f"n_{p}") <= F.ceil(position(p)))
    kept = sums.filter(wanted).select(
        *GROUP,
        "range",
        *[(F.col(f"upto_{p}") - F.col(f"n_{p}")).alias(f"before_{p}") for p in populations],
        *[column for p in populations for column in (F.floor(position(p)).alias(f"first_{p}"), F.ceil(position(p)).alias(f"last_{p}"))],
    )
    return _same(rows, kept, *GROUP, "range").withColumn("range", F.array("range"))


def _refined(near: DataFrame, populations: Sequence[str]) -> DataFrame:
    """The same ranks in ranges of at most ``MOST_IN_RANGE`` distinct quantities.

    A range that holds more is cut into equal parts between its least and greatest
    quantity, and only the parts that hold a wanted rank go on. The least and the
    greatest fall into different parts, so every round leaves fewer; quantities that
    all lie within a thousandth take one round more than others.
    """
    near = materialize(near, "near-ranks")
    while True:
        sizes = near.groupBy(*GROUP, "range").agg(
            F.count(F.lit(1)).alias("size"), F.min("quantity").alias("least"), F.max("quantity").alias("greatest")
        )
        full = materialize(sizes.filter(F.col("size") > MOST_IN_RANGE).drop("size"), "full-ranges")
        if full.isEmpty():
            return near
        place = F.floor((F.col("quantity") - F.col("least")) / (F.col("greatest") - F.col("least")) * PARTS)
        rows = _same(near, full, *GROUP, "range").withColumn("part", F.least(place, F.lit(PARTS - 1)).cast("long"))
        keys = (*GROUP, "range", "part")
        # One row a part: the window sees at most PARTS of them.
        sums = rows.groupBy(*keys).agg(*[F.sum(f"n_{p}").alias(f"n_{p}") for p in populations], *[F.max(f"{name}_{p}").alias(f"{name}_{p}") for p in populations for name in ("before", "first", "last")])
        upwards = Window.partitionBy(*GROUP, "range").orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        sums = sums.withColumns({f"upto_{p}": F.col(f"before_{p}") + F.sum(f"n_{p}").over(upwards) for p in populations})
        wanted = F.lit(False)
        for p in populations:
            wanted |= (F.col(f"upto_{p}") > F.col(f"first_{p}")) & (F.col(f"upto_{p}") - F.col(f"n_{p}") <= F.col(f"last_{p}"))
        kept = sums.filter(wanted).select(*keys, *[(F.col(f"upto_{p}") - F.col(f"n_{p}")).alias(f"before_{p}") for p in populations])
        parts = _same(rows.drop("least", "greatest", *[f"before_{p}" for p in populations]), kept, *keys)
        parts = parts.withColumn("range", F.concat("range", F.array("part"))).select(*near.columns)
        others = near.join(full.select(*[F.col(name).alias(f"__{name}") for name in (*GROUP, "range")]), [F.col(name).eqNullSafe(F.col(f"__{name}")) for name in (*GROUP, "range")], "left_anti")
        near = materialize(others.unionByName(parts), "near-ranks")


def _percentiles(histogram: DataFrame, means: DataFrame, populations: Sequence[str]) -> DataFrame:
    """p99_<name> per group, interpolated between the two neighbouring ranks and exact."""
    upwards = Window.partitionBy(*GROUP, "range").orderBy("quantity").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    near = _refined(_near_ranks(histogram, means, populations), populations)
    ranked = near.withColumns({f"upto_{p}": F.col(f"before_{p}") + F.sum(f"n_{p}").over(upwards) for p in populations})
    at = lambda p, rank: F.min(F.when((F.col(f"n_{p}") > 0) & (F.col(f"upto_{p}") > F.col(f"{rank}_{p}")), F.col("quantity")))
    found = ranked.groupBy(*GROUP).agg(
        *[at(p, rank).alias(f"{name}_{p}") for p in populations for rank, name in (("first", "low"), ("last", "high"))],
        *[F.max(f"first_{p}").alias(f"first_{p}") for p in populations],
    )
    found = _same(found, means.select(*GROUP, *[f"total_{p}" for p in populations]), *GROUP)

    def between(p: str) -> Column:
        low, high = F.col(f"low_{p}"), F.col(f"high_{p}")
        return low + (high - low) * ((F.col(f"total_{p}") - 1) * F.lit(LINE_PERCENTILE) - F.col(f"first_{p}"))

    return found.select(*GROUP, *[between(p).alias(f"p99_{p}") for p in populations])


def line_thresholds(
    counted: DataFrame, populations: Mapping[str, Column], sigma: Sequence[str] | None = None, percentile: Sequence[str] | None = None
) -> DataFrame:
    """Mean, sample deviation and exact 99th percentile of the line quantity.

    ``counted`` is the output of ``count_lines``. Each population is a name and
    a count column; the result has average_<name> and std_dev_<name> of those
    listed in ``sigma``, and p99_<name> of those in ``percentile`` (all by
    default), per dataset and raw product. NULL quantities count for nothing, and
    the deviation of a single line is 0. Nothing needs all quantities of a product in one task.
    """
    sigma = list(populations) if sigma is None else list(sigma)
    percentile = list(populations) if percentile is None else list(percentile)
    # The histogram is read several times and far smaller than the lines, so it is written once.
    histogram = materialize(_histogram(counted, populations), "quantities")
    means = _means(histogram, list(populations))
    result = means.select(*GROUP, *[f"average_{p}" for p in sigma])
    if sigma:
        result = _same(result, _deviations(histogram, means, sigma), *GROUP)
    if percentile:
        result = _same(result, _percentiles(histogram, means, percentile), *GROUP, how="left")
    return result


def line_statistics(lines: DataFrame) -> DataFrame:
    """Mean and sample deviation (0 for one line) per dataset and raw product."""
    thresholds = line_thresholds(count_lines(lines), {"all": F.col(LINE_COUNT)}, percentile=())
    return thresholds.select(*GROUP, F.col("average_all").alias("average"), F.col("std_dev_all").alias("std_dev"))


def line_percentiles(lines: DataFrame) -> DataFrame:
    """Exact 99th percentile of the line quantity per dataset and raw product."""
    thresholds = line_thresholds(count_lines(lines), {"all": F.col(LINE_COUNT)}, sigma=())
    return thresholds.select(*GROUP, F.col("p99_all").alias("percentile_99"))


def day_z_scores(days: DataFrame, demands: Sequence[str] = ("demand",)) -> DataFrame:
    """Add <demand>_z, the z-score of each day within its product and dataset.

    A product without spread gets 0. All demand columns share one window.
    """
    group = Window.partitionBy("product_id", "dp_input_datasets_id")
    return days.withColumns(
        {
            f"{name}_z": F.coalesce(
                safe_divide(F.col(name) - F.avg(name).over(group), F.stddev_samp(name).over(group)), F.lit(0.0)
            )
            for name in demands
        }
    )


def smooth_days(
    days: DataFrame, demands: Sequence[str], restriction: Column | None = None, over: str = "restricted"
) -> DataFrame:
    """Replace outlying days by the product's mean day.

    Z-scores use the whole history. A restriction is applied before the mean is
    taken, so the mean covers the restricted days only; for a single day the
    replacement then changes nothing. With ``over='history'`` the mean covers all
    days and the restriction comes last. An absent (NULL) demand stays absent.
    """
    if over not in ("restricted", "history"):
        raise ValueError(f"over must be 'restricted' or 'history', not {over!r}")
    scored = day_z_scores(days, demands)
    if restriction is not None and over == "restricted":
        scored = scored.filter(restriction)
    group = Window.partitionBy("product_id", "dp_input_datasets_id")
    smoothed = scored.withColumns(
        {
            name: F.when(
                F.col(name).isNotNull() & (F.abs(F.col(f"{name}_z")) >= DAY_Z_BOUND), F.avg(name).over(group)
            ).otherwise(F.col(name))
            for name in demands
        }
    )
    if restriction is not None and over == "history":
        smoothed = smoothed.filter(restriction)
    return smoothed.drop(*[f"{name}_z" for name in demands])
