import datetime as dt
import functools

import pytest
from pyspark.sql import functions as F

from demandlab.functions.ratios import absolute_error_percent
from demandlab.operators.datasets import select_datasets
from demandlab.plans.evaluation import ERRORS, FORECASTS, Evaluation, case_days, cohort_products, evaluation_cases, latest_params, live_setups
from demandlab.sources.schemas import schema_of

ANCHOR = dt.date(2022, 8, 1)
AS_OF = dt.date(2022, 9, 30)
ZONE = [[{"x": x, "y": y} for x, y in ((0.0, 0.0), (9.0, 0.0), (9.0, 9.0), (0.0, 9.0))]]


def day(n):
    return ANCHOR + dt.timedelta(days=n)


@pytest.fixture
def market(make_tables):
    """One first-party dataset (10), one third-party (11) and one over all warehouses (12)."""

    def build(**more):
        products = {1: (1, 2.0), 2: (1, 3.0), 3: (99, 5.0), 7: (1, 1.0)}
        rows = {
            "country": [(1, "CO")],
            "site": [(1, "BOG", 1)],
            "warehouse": [(1, "W0", "False"), (1, "W2", "True")],
            "dataset": [(10, "BOG", "W0", "G", 1, 0.5), (11, "BOG", "W2", "G", 1, 0.5), (12, "BOG", "ALL", "G", 1, 0.5)],
            "forecast_params": [(1, 10, day(-99), None), (2, 11, day(-99), None), (3, 12, day(-99), day(1))],
            "microzone": [(1, 1, ZONE)],
            "microzone_group": [("G", 1)],
            "new_skus": [(7, 2, 2.0)],
            "order_header": [(n, 1, "BOG", w, "t", 1, day(n), 1.0, 1.0) for n, w in ((1, "W0"), (2, "W0"))]
            + [(3, 1, "BOG", "W0", "t", 1, day(-31), 1.0, 1.0), (4, 1, "BOG", "W2", "t", 1, day(1), 1.0, 1.0)],
            "order_line": [(1, p, 10.0, price, "false", owner) for p, (owner, price) in products.items()]
            + [(2, 1, 4.0, 2.0, "false", 1), (3, 5, 1.0, 1.0, "false", 1), (4, 3, 2.0, 5.0, "false", 99)],
            "demand": [(day(1), 1, 10.0, 10, "experiment_1"), (day(1), 2, 8.0, 10, "experiment_1"), (day(1), 1, 99.0, 10, "experiment_2")],
            "forecast": [
                (day(1), dt.datetime(2022, 8, 1, 9), "BOG", "W0", 1, p, q, f"experiment_{k}")
                for p, q, k in ((1, 12.0, 1), (2, 4.0, 1), (7, 1.0, 1), (1, 5.0, 2), (2, 8.0, 3), (3, 8.0, 1))
            ],
            "catalog": [(1, "W0", "FRUVER"), (2, "W0", "OTHER"), (1, "W2", "OTHER")],
            **more,
        }
        return make_tables(**rows)

    return build


def cases_of(tables, *dataset, days=5):
    cases = evaluation_cases(select_datasets(tables, "co"), [ANCHOR], days)
    return cases.filter(F.col("dp_input_datasets_id").isin(*dataset)) if dataset else cases


@pytest.mark.parametrize(
    ("demand", "forecast", "error"), [(0.0, 5.0, 100.0), (0.0, 0.0, 0.0), (0.0, -1.0, None), (10.0, 12.0, 20.0)]
)
def test_error_of_one_cell(spark, demand, forecast, error):
    d, f = F.lit(demand), F.lit(forecast)
    assert spark.range(1).select(absolute_error_percent(d, f, F.abs(f - d)).alias("e")).first().e == error


def test_cases_from_anchor_table(spark, market, rows_of):
    anchors = spark.createDataFrame([(day(0),), (day(3),), (day(0),)], "date date")
    cases = evaluation_cases(select_datasets(market(), "co", 10), anchors, 1)
    assert rows_of(cases, "anchor", "days") == [(day(0), 1), (day(3), 1)]
    assert rows_of(case_days(cases), "day") == [(day(0),), (day(1),), (day(3),), (day(4),)]


def test_cohort_follows_warehouse_type(market, rows_of):
    tables = market()
    found = rows_of(cohort_products(tables, cases_of(tables)), "dp_input_datasets_id", "product_id", "warehouse_type")
    # Product 5 was last sold 31 days before the anchor; 7 is now 2.
    assert found == [(10, 1, "1pl"), (10, 2, "1pl"), (11, 3, "3pl"), (12, 1, "1pl"), (12, 2, "1pl"), (12, 3, "3pl")]


def test_newest_setup(market, rows_of):
    tables = market(forecast_params=[(4, 10, ANCHOR, None), (9, 10, ANCHOR, None), (5, 77, ANCHOR, None)])
    columns = ("dp_input_datasets_id", "region_code", "warehouse", "dp_forecast_params_id")
    assert rows_of(latest_params(tables), *columns) == [(10, "BOG", "W0", 9), (77, None, None, 5)]


def test_clean_demand_is_experiment_one_of_the_cohort(market, rows_of):
    tables = market()
    rows = Evaluation(tables, cases_of(tables), AS_OF).clean_demand()
    assert rows_of(rows, "dp_input_datasets_id", "product_id", "demand") == [(10, 1, 10.0), (10, 2, 8.0)]


def test_shares_sum_to_one_and_follow_live_setups(market, rows_of):
    tables = market()
    shares = Evaluation(tables, cases_of(tables), AS_OF).sales_share()
    values = {(r.dp_input_datasets_id, r.close_date, r.product_id): r.share for r in shares.collect()}
    # W0 on day 1: product 1 sells 20, product 2 sells 30 + 10 (as 7).
    assert values[10, day(1), 1] == pytest.approx(20 / 60)
    assert values[10, day(1), 2] == pytest.approx(40 / 60)
    assert values[11, day(1), 3] == 1.0
    # The setup of dataset 12 ends on day 1; it sees all warehouses.
    assert {key[1] for key in values if key[0] == 12} == {day(1)}
    assert values[12, day(1), 3] == pytest.approx(60 / 120)
    totals = {r.total for r in shares.groupBy("dp_input_datasets_id", "close_date").agg(F.round(F.sum("share"), 9).alias("total")).collect()}
    assert totals == {1.0}


def test_blacklisted_product_has_no_share(market, rows_of):
    tables = market(blacklist=[(2, "product_id", "BOG")])
    shares = Evaluation(tables, cases_of(tables, 10), AS_OF).sales_share()
    assert rows_of(shares.filter(F.col("close_date") == F.lit(day(1))), "product_id", "share") == [(1, 1.0)]


def test_two_live_setups_count_twice(market):
    tables = market()
    twice = market(forecast_params=[(1, 10, day(-99), None), (2, 10, day(1), day(1))])
    once = Evaluation(tables, cases_of(tables, 10), AS_OF).daily_sales_value()
    double = Evaluation(twice, cases_of(twice, 10), AS_OF).daily_sales_value()
    total = {n: {r.close_date: r.t for r in v.groupBy("close_date").agg(F.sum("value").alias("t")).collect()} for n, v in ((1, once), (2, double))}
    assert total[2][day(1)] == 2 * total[1][day(1)]
    assert total[2][day(2)] == total[1][day(2)]


def test_product_and_warehouse_errors(market, rows_of):
    tables = market()
    evaluation = Evaluation(tables, cases_of(tables, 10), AS_OF)
    products = evaluation.product_errors()
    found = {r.product_id: r for r in products.collect()}
    assert (found[1].timeframe, found[1].demand, found[1].forecast_exp1) == (1, 10.0, 12.0)
    assert found[1].mafe_exp1 == pytest.approx(20.0)
    assert (found[2].forecast_exp1, found[2].mafe_exp1) == (6.0, pytest.approx(25.0))  # 4 + 1 of product 7 at 2 units
    assert (found[2].forecast_exp2, found[2].mafe_exp2) == (0.0, 100.0)
    assert found[1].share == pytest.approx(20 / 60)
    total = evaluation.warehouse_errors().first()
    assert total.region_code == "BOG"
    assert total.mafe_exp1 == pytest.approx(20.0 / 3 + 25.0 * 2 / 3)


def test_share_is_zero_without_sales(market):
    tables = market(order_line=[(2, 1, 4.0, 2.0, "false", 1), (2, 2, 4.0, 2.0, "false", 1)])
    shares = {r.product_id: r.share for r in Evaluation(tables, cases_of(tables, 10), AS_OF).product_errors().collect()}
    assert shares == {1: 0.0, 2: 0.0}


def test_category_is_judged_on_its_own(market):
    tables = market()
    every = {r.category: r for r in Evaluation(tables, cases_of(tables, 10), AS_OF, by_category=True).warehouse_errors().collect()}
    assert every["FRUVER"].mafe_exp1 == pytest.approx(20.0)
    assert every["OTHER"].mafe_exp1 == pytest.approx(25.0)
    one = Evaluation(tables, cases_of(tables, 10), AS_OF, category="FRUVER").warehouse_errors().collect()
    assert [r.category for r in one] == ["FRUVER"]


def test_wide_forecast_equals_chain_of_outer_joins(market, rows_of):
    tables = market()
    evaluation = Evaluation(tables, cases_of(tables, 10), AS_OF)
    assert evaluation.repeated_forecasts().count() == 0
    long = evaluation.forecast_by_experiment()
    keys = ["forecast_date", "product_id", "timeframe"]
    parts = [
        long.filter(F.col("experiment") == f"experiment_{k}").select(*keys, F.col("forecast").alias(name))
        for k, name in enumerate(FORECASTS, 1)
    ]
    chain = functools.reduce(lambda left, right: left.join(right, keys, "full_outer"), parts).na.fill(0.0)
    assert rows_of(evaluation.forecast_wide(), *keys, *FORECASTS) == rows_of(chain, *keys, *FORECASTS)


def test_repeated_setups_are_reported(market, rows_of):
    extra = [(day(1), dt.datetime(2022, 8, 1), "BOG", "W0", params, 1, 1.0, "experiment_4") for params in (1, 2)]
    tables = market(forecast=extra)
    evaluation = Evaluation(tables, cases_of(tables, 10), AS_OF)
    assert rows_of(evaluation.repeated_forecasts(), "experiment", "product_id", "setups") == [("experiment_4", 1, 2)]
    assert evaluation.forecast_wide().first().forecast_exp4 == 2.0
    assert len(ERRORS) == 8


def test_live_setups_by_a_sweep(spark):
    """A thousand overlapping setups give one row for each day asked for."""
    day = lambda k: dt.date(2022, 1, 1) + dt.timedelta(days=k)
    rows = [(k, 10 + k % 2, day(k % 97), day(k % 97 + k % 31) if k % 5 else None) for k in range(1000)]
    rows += [(2000, 10, day(60), day(50)), (2001, 10, None, day(50)), (2002, 12, day(5), None)]  # ends before it starts; no start; not asked for
    params = spark.createDataFrame(rows, schema_of("forecast_params"))
    asked = [(dataset, day(k)) for dataset in (10, 11) for k in range(0, 140, 3)]
    frame = spark.createDataFrame(asked, "dp_input_datasets_id int, close_date date")
    found = {(r["dp_input_datasets_id"], r["close_date"]): r["setups"] for r in live_setups(params, frame, F.lit(day(120))).collect()}
    expected = {}
    for dataset, at in asked:
        live = sum(d == dataset and start is not None and start <= at <= (end or day(120)) for _, d, start, end in rows)
        if live:
            expected[dataset, at] = live
    assert found == expected and max(expected.values()) > 100


def test_repeated_setups_multiply_as_in_a_chain_of_outer_joins(market, rows_of):
    """Several rows of several experiments, products with and without the first one, against the joins themselves."""
    made = dt.datetime(2022, 8, 1)
    rows = [(1, 1, 1), (1, 2, 1), (1, 1, 2), (1, 1, 3), (1, 2, 3), (1, 3, 3), (2, 1, 2), (2, 2, 2), (2, 1, 5), (3, 1, 1), (3, 2, 8)]
    forecast = [(day(d), made, "BOG", "ALL", params, p, 1.0 + p + params / 8 + k / 64 + d, f"experiment_{k}") for p, params, k in rows for d in (1, 2)]
    evaluation = Evaluation(tables := market(forecast=forecast), cases_of(tables, 12), AS_OF, multiply_repeats=True)
    long = evaluation.forecast_by_experiment()
    assert evaluation.repeated_forecasts().count() == 6
    keys = ["forecast_date", "product_id", "timeframe"]
    parts = [
        long.filter(F.col("experiment") == f"experiment_{k}").select(*[F.col(c).alias(f"{c}{k}") for c in keys], F.col("forecast").alias(name))
        for k, name in enumerate(FORECASTS, 1)
    ]
    chain = parts[0]
    for k, part in enumerate(parts[1:], 2):
        chain = chain.join(part, [F.col(f"{c}1") == F.col(f"{c}{k}") for c in keys], "full_outer")
    merged = [F.coalesce(*[F.col(f"{c}{k}") for k in range(1, 9)]).alias(c) for c in keys]
    expected = chain.groupBy(*merged).agg(*[F.sum(F.coalesce(F.col(f), F.lit(0.0))).alias(f) for f in FORECASTS])
    found = rows_of(evaluation.forecast_wide(), *keys, *FORECASTS)
    assert found == rows_of(expected, *keys, *FORECASTS)
    first = next(r for r in found if r[1] == 1)
    assert first[3] == 3 * sum(2.0 + params / 8 + 1 / 64 + 1 for params in (1, 2))  # three rows of experiment 3 for each
