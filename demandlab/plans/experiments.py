"""Analysis of the eight experiments from their errors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from demandlab.plans.demand import VARIANTS
from demandlab.plans.evaluation import ERRORS

# Fixed value: the horizon whose errors enter the design matrix.
RESPONSE_TIMEFRAME = 2

TIMEFRAME = "timeframe"
FACTORS = ("a", "b", "c", "d")


def _measures(df: DataFrame, keys: Sequence[str]) -> list[str]:
    """Numeric columns other than the keys and the dataset."""
    left_out = {*keys, "dp_input_datasets_id"}
    return [f.name for f in df.schema if isinstance(f.dataType, NumericType) and f.name not in left_out]


def mean_by_timeframe(errors: DataFrame, keys: Sequence[str] = (TIMEFRAME,)) -> DataFrame:
    """Mean of every numeric column per horizon, over all dates and anchors."""
    return errors.groupBy(*keys).agg(*[F.avg(m).alias(m) for m in _measures(errors, keys)])


def sum_by_timeframe(errors: DataFrame, keys: Sequence[str] = (TIMEFRAME,)) -> DataFrame:
    """Sum of every numeric column per horizon; a column without values sums to 0."""
    return errors.groupBy(*keys).agg(*[F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in _measures(errors, keys)])


def overall_mean(df: DataFrame) -> DataFrame:
    """Mean of every numeric column in one row."""
    return df.agg(*[F.avg(m).alias(m) for m in _measures(df, ())])


def add_difference(df: DataFrame, left: str = "mafe_exp6", right: str = "mafe_exp5", name: str = "comp") -> DataFrame:
    """Difference of two experiments' errors."""
    return df.withColumn(name, F.col(left) - F.col(right))


def flag_exp6_higher(errors: DataFrame) -> DataFrame:
    """1 where experiment 6 has the larger error than experiment 5, else 0."""
    higher = F.when(F.col("mafe_exp6") > F.col("mafe_exp5"), F.lit(1)).otherwise(F.lit(0))
    return errors.withColumn("exp6_higher", higher)


def _levels(number: int) -> list[Column]:
    v = VARIANTS[number - 1]
    on = [int(step) for step in (v.sigma_lines, v.percentile_lines, v.user_list, v.smooth)]
    plain = [F.lit(level).alias(name) for name, level in zip(FACTORS, on)]
    coded = [F.lit(2 * level - 1).alias(f"{name}f") for name, level in zip(FACTORS, on)]
    return plain + coded


def design_response(means: DataFrame, timeframe: int = RESPONSE_TIMEFRAME) -> DataFrame:
    """The design matrix with the mean error of each experiment as response y.

    ``means`` comes from ``mean_by_timeframe``; its other columns (say, a dataset
    key) are kept. Each row of means becomes eight rows, one per experiment, with
    the steps as 0/1 (a-d) and as -1/+1 (af-df).
    """
    others = [c for c in means.columns if c not in ERRORS and c != TIMEFRAME]
    runs = F.array(
        *[
            F.struct(F.lit(v.number).alias("experiment"), F.col(error).alias("y"), *_levels(v.number))
            for v, error in zip(VARIANTS, ERRORS)
        ]
    )
    return (
        means.filter(F.col(TIMEFRAME) == timeframe)
        .select(*others, F.explode(runs).alias("run"))
        .select(*others, "run.*")
    )
