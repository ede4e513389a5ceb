import datetime as dt
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandlab.operators.outliers import (
    LINE_COUNT,
    _histogram,
    _means,
    _near_ranks,
    _range,
    count_lines,
    day_z_scores,
    line_percentiles,
    line_statistics,
    smooth_days,
)
from demandlab.plans.demand import VARIANT, kept_quantities, sum_by_day

DAY = dt.date(2022, 8, 1)
LINES = (
    "close_date date, product_id bigint, quantity double, dp_input_datasets_id int, region_code string, "
    "stockout_weight double, user_listed boolean"
)


def lines_frame(spark, quantities, product=1):
    return spark.createDataFrame([(DAY, product, q, 10, "R", 0.5, False) for q in quantities], LINES)


def kept_total(spark, make_tables, quantities, variant):
    skus = make_tables().new_skus
    summed = sum_by_day(kept_quantities(lines_frame(spark, quantities), skus, [VARIANT[variant]]), [VARIANT[variant]])
    return summed.first()[f"experiment_{variant}"]


def test_six_sigma_needs_enough_lines(spark, make_tables):
    assert kept_total(spark, make_tables, [1.0] * 36 + [1000.0], 6) == 1036
    assert kept_total(spark, make_tables, [1.0] * 38 + [1000.0], 6) == 38


def test_equal_maxima_fail_six_sigma_but_pass_p99(spark, make_tables):
    quantities = [1.0] * 117 + [1000.0] * 3
    assert kept_total(spark, make_tables, quantities, 6) == 117
    assert kept_total(spark, make_tables, quantities, 7) == 3117
    assert kept_total(spark, make_tables, quantities, 4) == 117


def test_single_line_is_kept(spark, make_tables, rows_of):
    frame = lines_frame(spark, [5.0])
    assert rows_of(line_statistics(frame), "average", "std_dev") == [(5.0, 0.0)]
    assert kept_total(spark, make_tables, [5.0], 4) == 5


def test_percentile_interpolates(spark, rows_of):
    frame = lines_frame(spark, [1.0, 2.0, 3.0, 100.0])
    assert line_percentiles(frame).first().percentile_99 == pytest.approx(97.09)


def test_null_quantity_and_null_product(spark, make_tables):
    frame = lines_frame(spark, [None, 2.0]).unionByName(lines_frame(spark, [3.0], product=None))
    variants = [VARIANT[1], VARIANT[6]]
    summed = sum_by_day(kept_quantities(frame, make_tables().new_skus, variants), variants)
    got = {row.product_id: (row.experiment_1, row.experiment_6) for row in summed.collect()}
    assert got == {1: (2.0, 2.0), None: (3.0, None)}


def test_line_without_quantity_still_makes_a_day(spark, make_tables):
    variants = [VARIANT[1], VARIANT[4]]
    summed = sum_by_day(kept_quantities(lines_frame(spark, [None]), make_tables().new_skus, variants), variants)
    assert (summed.first().experiment_1, summed.first().experiment_4) == (0.0, None)


@pytest.mark.parametrize("size", [1, 2, 3, 50, 101, 200, 333])
def test_thresholds_equal_plain_python(spark, size):
    draw = random.Random(size)
    quantities = [float(draw.choice([1, 2, 3, 7, 40, 41.5])) for _ in range(size)]
    frame = lines_frame(spark, quantities)
    stats, percentile = line_statistics(frame).first(), line_percentiles(frame).first().percentile_99
    ordered, position = sorted(quantities), 0.99 * (size - 1)
    low, high = ordered[int(position)], ordered[min(int(position) + (position % 1 > 0), size - 1)]
    assert stats.average == pytest.approx(statistics.fmean(quantities))
    assert stats.std_dev == pytest.approx(statistics.stdev(quantities) if size > 1 else 0.0)
    assert percentile == pytest.approx(low + (high - low) * (position % 1))
    assert frame.select(F.percentile("quantity", F.lit(0.99))).first()[0] == pytest.approx(percentile)


def spike(spark, demands):
    rows = [(DAY + dt.timedelta(days=i), 1, d, 10) for i, d in enumerate(demands)]
    return spark.createDataFrame(rows, "date date, product_id bigint, demand double, dp_input_datasets_id int")


def test_outlying_day_becomes_the_mean(spark):
    days = spike(spark, [1.0] * 11 + [100.0])
    smoothed = {row.date: row.demand for row in smooth_days(days, ["demand"]).collect()}
    assert smoothed[DAY] == 1.0
    assert smoothed[DAY + dt.timedelta(days=11)] == pytest.approx(111 / 12)


def test_one_day_restriction_changes_nothing(spark):
    last = DAY + dt.timedelta(days=11)
    days = smooth_days(spike(spark, [1.0] * 11 + [100.0]), ["demand"], F.col("date") == F.lit(last))
    assert [(row.date, row.demand) for row in days.collect()] == [(last, 100.0)]


def test_restricted_mean_covers_restricted_days_only(spark):
    days = smooth_days(spike(spark, [1.0] * 11 + [100.0]), ["demand"], F.col("date") >= F.lit(DAY + dt.timedelta(days=10)))
    assert sorted(row.demand for row in days.collect()) == [1.0, 50.5]


def test_no_spread_gives_zero_score(spark):
    scores = {row.demand_z for row in day_z_scores(spike(spark, [3.0, 3.0])).collect()}
    assert scores == {0.0}
    assert day_z_scores(spike(spark, [3.0])).first().demand_z == 0.0


def test_too_few_days_cannot_be_outlying(spark):
    days = spike(spark, [1.0] * 8 + [100.0])
    assert max(row.demand for row in smooth_days(days, ["demand"]).collect()) == 100.0


def exact(values, n=None):
    ordered = sorted(values)
    at = (len(ordered) - 1) * 0.99
    low, high = ordered[int(at)], ordered[-int(-at // 1)]
    return low + (high - low) * (at - int(at))


def test_percentile_of_a_product_with_very_many_quantities(spark):
    """No window partition holds them all: only the range of a rank is ordered, also beside a mistyped quantity."""
    draw = random.Random(3)
    quantities = [draw.lognormvariate(1, 1) for _ in range(200_000)] + [1e9]
    frame = spark.createDataFrame([(q,) for q in quantities], "quantity double").selectExpr(
        "DATE'2022-08-01' AS close_date", "1L AS product_id", "quantity", "10 AS dp_input_datasets_id"
    )
    counted = count_lines(frame)
    histogram = _histogram(counted, {"all": F.col(LINE_COUNT)})
    assert _near_ranks(histogram, _means(histogram, ["all"]), ["all"]).count() < 5000
    assert histogram.select(_range()).distinct().count() < 20_000
    assert line_percentiles(frame).first().percentile_99 == pytest.approx(exact(quantities), rel=1e-12)
    stats = line_statistics(frame).first()
    assert stats.average == pytest.approx(statistics.fmean(quantities)) and stats.std_dev == pytest.approx(statistics.stdev(quantities))


def test_percentiles_of_many_small_groups(spark):
    draw = random.Random(4)
    groups = {p: [float(draw.choice([1, 2, 2, 3, 50, 0.5])) for _ in range(draw.randint(1, 300))] for p in range(20)}
    rows = [(DAY, p, q, 10, "R", 0.5, False) for p, values in groups.items() for q in [*values, None]]
    found = {r.product_id: r.percentile_99 for r in line_percentiles(spark.createDataFrame(rows, LINES)).collect()}
    assert found == {p: pytest.approx(exact(values)) for p, values in groups.items()}


def test_group_of_unknown_quantities_has_no_percentile(spark, rows_of):
    frame = lines_frame(spark, [None, None])
    assert rows_of(line_percentiles(frame), "percentile_99") == [(None,)]
    assert rows_of(line_statistics(frame), "average", "std_dev") == [(None, 0.0)]


def test_mean_of_the_whole_history(spark):
    days = spark.createDataFrame([(DAY + dt.timedelta(days=k), 1, 10, 1000.0 if k == 20 else 1.0) for k in range(21)], "date date, product_id bigint, dp_input_datasets_id int, demand double")
    last = F.col("date") == F.lit(DAY + dt.timedelta(days=20))
    assert smooth_days(days, ["demand"], last).first().demand == 1000.0
    assert smooth_days(days, ["demand"], last, over="history").first().demand == pytest.approx(1020 / 21)
    with pytest.raises(ValueError, match="over"):
        smooth_days(days, ["demand"], over="month")


def test_percentile_of_quantities_that_lie_close_together(spark, monkeypatch):
    """Ranges are split until none holds more than the bound, however close the quantities are."""
    from demandlab.operators import outliers

    seen = []
    refined = outliers._refined

    def watched(near, populations):
        found = refined(near, populations)
        seen.append(found.groupBy(*outliers.GROUP, "range").count().agg({"count": "max"}).first()[0])
        return found

    monkeypatch.setattr(outliers, "_refined", watched)
    monkeypatch.setattr(outliers, "MOST_IN_RANGE", 1000)
    n = 200_000
    near = spark.range(n).selectExpr("1 AS dp_input_datasets_id", "id % 2 AS product_id", f"1 + id * (0.0005D / {n}) AS quantity")
    # A third product has few values very close to each other and one far away, and many equal ones.
    far = spark.range(5000).selectExpr("1 AS dp_input_datasets_id", "7L AS product_id", "CASE WHEN id = 0 THEN -3e9D WHEN id < 2000 THEN 5D ELSE 5 + id * 1e-12D END AS quantity")
    lines = near.union(far).withColumn("close_date", F.lit("2022-08-01").cast("date"))
    found = {row["product_id"]: row["percentile_99"] for row in line_percentiles(lines).collect()}
    values = lines.select("product_id", "quantity").toPandas()
    for product in (0, 1, 7):
        assert found[product] == pytest.approx(np.percentile(values[values["product_id"] == product]["quantity"], 99), abs=1e-13)
    assert max(seen) <= 1000
