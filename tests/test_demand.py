import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from demandlab.operators.datasets import list_datasets, select_datasets, site_warehouses
from demandlab.operators.order_lines import order_lines, without_listed_users
from demandlab.operators.stockouts import stockouts_by_region, stockouts_by_warehouse
from demandlab.plans.demand import VARIANT, VARIANTS, build_demand, build_line_state, combine_with_stockouts, kept_quantities, refresh_line_state, run_demand
from demandlab.plans.full_load import demand_dates, first_demand_dates, full_load, run_full_load
from demandlab.session import fresh_path
from demandlab.sources.demand_table import append_demand
from demandlab.sources.schemas import schema_of

MONDAY, TUESDAY, SUNDAY = dt.date(2022, 8, 1), dt.date(2022, 8, 2), dt.date(2022, 8, 7)
AS_OF = dt.date(2022, 8, 20)


def square(low, high):
    return [[{"x": x, "y": y} for x, y in ((low, low), (high, low), (high, high), (low, high))]]


ZONE, INNER = square(0.0, 10.0), square(4.0, 6.0)


def header(order, day=MONDAY, user=1, tag="plain", status=1, at=(1.0, 1.0), region="BOG"):
    return (order, user, region, "W0", tag, status, day, *at)


@pytest.fixture
def shop(make_tables):
    """Two datasets of one site, one of another country, and a few orders."""

    def build(**more):
        rows = {
            "country": [(1, "CO"), (2, "BR")],
            "site": [(1, "BOG", 1), (2, "SPO", 2)],
            "warehouse": [(1, "W0", "False"), (1, "CO", "False"), (2, "W9", "True")],
            "dataset": [
                (10, "BOG", "ALL", "G", 1, 0.5),
                (11, "BOG", "W0", "G", 1, 0.5),
                (19, "BOG", "ALL", "G", 7, 0.5),
                (20, "SPO", "ALL", "G", 1, 0.5),
            ],
            "microzone": [(1, 1, ZONE), (2, 1, INNER), (3, 2, ZONE)],
            "microzone_group": [("G", 1), ("G", 2), ("G", 3)],
            "customer_config": [("BOG", "vip", "W0", "true"), ("BOG", "vip", "W1", "true"), ("BOG", "old", "W0", "false")],
            "new_skus": [(7, 70, 4.0)],
            "order_header": [
                header(1),
                header(2, day=SUNDAY),
                header(3, day=AS_OF + dt.timedelta(days=2)),
                header(4, status=0),
                header(5, at=(5.0, 5.0)),  # in two zones
                header(6, at=(50.0, 50.0)),  # in none
                header(7, tag="vip", at=(50.0, 50.0)),
                header(8, tag="vip"),
                header(9, user=99),
                header(10, tag="old"),
            ],
            "order_line": [(order, 7, 1.0, 2.0, "false", 1) for order in range(1, 11)] + [(1, 8, 9.0, 2.0, "true", 1)],
            **more,
        }
        return make_tables(**rows)

    return build


def counts(rows):
    found = {}
    for row in rows.collect():
        found[row.dp_input_datasets_id] = found.get(row.dp_input_datasets_id, 0) + 1
    return found


def test_dataset_selection(shop, rows_of):
    tables = shop()
    assert rows_of(select_datasets(tables, "co"), "dataset_identifier") == [(10,), (11,)]
    assert rows_of(select_datasets(tables, "CO", 11), "dataset_identifier") == [(11,)]
    assert rows_of(list_datasets(tables), "country", "dataset_identifier") == [("br", 20), ("co", 10), ("co", 11)]
    assert rows_of(site_warehouses(tables), "region_code", "warehouse", "is_3pl") == [("BOG", "W0", "False"), ("SPO", "W9", "True")]


def test_routing_of_zone_and_key_account_orders(shop):
    # ALL: orders 1, 9, 10 once, 5 twice (two zones), 8 twice (two account rows).
    # W0: 1, 9, 10 once, 5 twice, and the key account's 7 and 8 once each.
    tables = shop()
    lines = order_lines(tables, select_datasets(tables, "CO"), AS_OF)
    assert counts(lines) == {10: 7, 11: 7}


def test_lists_of_users_orders_and_products(shop):
    listed = shop(blacklist=[(99, "user_id", "BOG"), (10, "order_id", "BOG"), (7, "product_id", "SPO")])
    lines = order_lines(listed, select_datasets(listed, "CO"), AS_OF)
    assert counts(lines) == {10: 6, 11: 6}
    assert counts(without_listed_users(lines)) == {10: 5, 11: 5}


def test_stockouts_are_weighted_remapped_and_positive(shop, rows_of):
    events = [(MONDAY, 7, "BOG", "W0", 3.0), (MONDAY, 70, "BOG", "W0", 2.0), (MONDAY, 8, "BOG", "W0", 0.0), (AS_OF + dt.timedelta(1), 7, "BOG", "W0", 3.0)]
    tables = shop(stockout_by_warehouse=events, stockout_by_region=[(d, p, r, q) for d, p, r, _, q in events])
    datasets = select_datasets(tables, "CO")
    columns = ("dataset_identifier", "product_id", "stockouts")
    assert rows_of(stockouts_by_warehouse(tables, datasets, AS_OF), *columns) == [(11, 70, 7.0)]
    assert rows_of(stockouts_by_region(tables, datasets, AS_OF), *columns) == [(10, 70, 7.0), (11, 70, 7.0)]


def test_sum_equals_full_outer_join(shop, rows_of):
    tables = shop(stockout_by_warehouse=[(MONDAY, 7, "BOG", "W0", 3.0), (TUESDAY, 8, "BOG", "W0", 2.0)])
    datasets = select_datasets(tables, "CO")
    variant = VARIANT[1]
    rows = kept_quantities(order_lines(tables, datasets, AS_OF), tables.new_skus, [variant])
    lost = stockouts_by_warehouse(tables, datasets, AS_OF)
    demand = rows.groupBy("date", "product_id", "dp_input_datasets_id").agg(F.sum("experiment_1").alias("quantity"))
    joined = demand.join(
        lost.select(F.col("close_date").alias("date"), "product_id", F.col("dataset_identifier").alias("dp_input_datasets_id"), "stockouts"),
        ["date", "product_id", "dp_input_datasets_id"],
        "full_outer",
    ).select("date", "product_id", "dp_input_datasets_id", (F.coalesce("quantity", F.lit(0.0)) + F.coalesce("stockouts", F.lit(0.0))).alias("experiment_1"))
    assert rows_of(combine_with_stockouts(rows, lost, [variant])) == rows_of(joined)


def test_design_of_the_variants():
    steps = {v.number: tuple(int(s) for s in (v.sigma_lines, v.percentile_lines, v.user_list, v.smooth)) for v in VARIANTS}
    assert steps == {
        1: (0, 0, 0, 0), 2: (1, 0, 0, 1), 3: (0, 1, 0, 1), 4: (1, 1, 0, 0),
        5: (0, 0, 1, 1), 6: (1, 0, 1, 0), 7: (0, 1, 1, 0), 8: (1, 1, 1, 1),
    }


def test_variants_together_equal_variants_alone(shop, rows_of):
    lines = [(1, 7, float(q), 2.0, "false", 1) for q in [1] * 60 + [2000]] + [(9, 7, 5.0, 2.0, "false", 1)]
    tables = shop(order_line=lines, blacklist=[(99, "user_id", "BOG")], stockout_by_warehouse=[(TUESDAY, 8, "BOG", "W0", 2.0)])
    together = build_demand(tables, AS_OF, country="CO")
    rows = rows_of(together)
    assert len({row[-1] for row in rows}) == 8
    for number in (1, 4, 8):
        alone = rows_of(build_demand(tables, AS_OF, [VARIANT[number]], "CO"))
        assert alone == [row for row in rows if row[-1] == f"experiment_{number}"]


def test_full_load_and_dates(shop, rows_of):
    tables = shop(stockout_by_region=[(SUNDAY, 7, "BOG", 2.0), (SUNDAY, 7, "SPO", 2.0)], blacklist=[(99, "user_id", "BOG")])
    loaded = full_load(tables, AS_OF)
    assert rows_of(loaded) == [
        (MONDAY, 70, 24.0, 10), (MONDAY, 70, 24.0, 11),
        (SUNDAY, 70, 4.0, 10), (SUNDAY, 70, 4.0, 11), (SUNDAY, 70, 4.0, 20),
    ]
    assert rows_of(demand_dates(loaded)) == [(MONDAY,)]
    assert rows_of(first_demand_dates(tables, loaded, "co")) == [(10, 70, MONDAY), (11, 70, MONDAY)]
    assert rows_of(first_demand_dates(tables, loaded, "BR")) == [(20, 70, SUNDAY)]


def test_runs_replace_what_they_rebuild(spark, shop, rows_of):
    table, place = "stored_demand", fresh_path(spark, "stored")
    tables = shop()
    for dataset in (10, 11):
        run_demand(spark, tables, table, "CO", dataset, AS_OF, initial_load=True, location=place)
    first = rows_of(spark.table(table))
    assert len(first) == 16
    run_demand(spark, tables, table, "CO", 10, AS_OF, initial_load=True)
    run_demand(spark, tables, table, "CO", 10, MONDAY)
    assert rows_of(spark.table(table)) == first

    # The orders of the day are gone: its rows go too, other days and datasets stay.
    other_day = shop(order_header=[header(1, day=TUESDAY)])
    run_demand(spark, other_day, table, "CO", 10, TUESDAY)
    assert spark.table(table).count() == 24
    run_demand(spark, shop(order_header=[]), table, "CO", 10, MONDAY)
    left = rows_of(spark.table(table), "dp_input_datasets_id", "date")
    assert left == [(10, TUESDAY)] * 8 + [(11, MONDAY)] * 8
    run_demand(spark, shop(order_header=[]), table, "CO", 10, AS_OF, initial_load=True)
    assert rows_of(spark.table(table), "dp_input_datasets_id") == [(11,)] * 8


def test_a_day_from_the_line_state_follows_late_lines(spark, shop, rows_of, tmp_path):
    """The day's demand equals that from all lines, also after a late line of an old day moved the threshold."""
    old, today = dt.date(2022, 7, 4), MONDAY
    headers = [header(order, day=old) for order in range(1, 61)] + [header(100, day=today), header(101, day=TUESDAY)]
    lines = [(order, 7, 1.0 + order / 64, 2.0, "false", 1) for order in range(1, 61)] + [(100, 7, 9.0, 2.0, "false", 1), (101, 7, 500.0, 2.0, "false", 1)]
    tables = shop(order_header=headers, order_line=lines)
    spark.sql("DROP TABLE IF EXISTS day_state")
    build_line_state(spark, tables, "day_state", dt.date(2022, 7, 31), "CO", location=f"file://{tmp_path}/state")

    def demand(source, state):
        return rows_of(build_demand(source, today, country="CO", day=today, state=state), "dp_input_datasets_id", "experiment", "demand")

    refresh_line_state(spark, tables, "day_state", today, "CO")
    before = demand(tables, "day_state")
    assert before == demand(tables, None)
    dropped = {row[1] for row in demand(tables, None)}
    assert "experiment_2" not in dropped  # nine is beyond six deviations

    late = shop(order_header=headers + [header(k, day=old) for k in range(200, 240)], order_line=lines + [(k, 7, 40.0, 2.0, "false", 1) for k in range(200, 240)])
    assert demand(late, "day_state") == before  # not counted yet
    refresh_line_state(spark, late, "day_state", dt.date(2022, 7, 31), "CO")
    refresh_line_state(spark, late, "day_state", dt.date(2022, 7, 31), "CO")  # again, as after a failure
    assert demand(late, "day_state") == demand(late, None) != before
    assert "experiment_2" in {row[1] for row in demand(late, "day_state")}

    refresh_line_state(spark, shop(order_header=[], order_line=[]), "day_state", dt.date(2022, 7, 31), "CO")
    assert spark.table("day_state").filter("close_date < '2022-08-01'").count() == 0
    with pytest.raises(ValueError, match="one day"):
        build_demand(tables, today, state="day_state")
    spark.sql("DROP TABLE day_state")


def test_a_full_load_can_be_run_again(spark, shop, rows_of):
    tables = shop(stockout_by_region=[(MONDAY, 8, "BOG", 2.0)])
    run = uuid.uuid4().hex  # files of an interrupted run may still lie in the warehouse
    names = tuple(f"load_{name}_{run}" for name in ("demand", "dates", "starts"))
    run_full_load(spark, tables, AS_OF, "CO", *names)
    once = [rows_of(spark.table(name)) for name in names]
    append_demand(spark.createDataFrame([(MONDAY, 5, 1.0, 11), (MONDAY, 5, 1.0, 20)], schema_of("input_demand")), names[0], "input_demand")
    spark.sql(f"DROP TABLE {names[2]}")  # a load that failed halfway
    run_full_load(spark, tables, AS_OF, "CO", *names)
    own = spark.table(names[0]).filter("dp_input_datasets_id <> 20")
    assert [rows_of(own), *[rows_of(spark.table(name)) for name in names[1:]]] == once
    assert spark.table(names[0]).filter("dp_input_datasets_id = 20").count() == 1  # another country's stays
    # Datasets that have no demand any more end up empty.
    run_full_load(spark, shop(order_header=[], order_line=[]), AS_OF, "CO", *names)
    assert rows_of(spark.table(names[0]), "dp_input_datasets_id") == [(20,)]
    assert rows_of(spark.table(names[1])) == [(MONDAY,)] and spark.table(names[2]).count() == 0
    for name in names:
        spark.sql(f"DROP TABLE {name}")


def test_a_full_load_writes_few_files(spark, shop):
    """One file for each dataset, not one for each of its days."""
    days = [MONDAY + dt.timedelta(days=k) for k in range(5)]
    tables = shop(stockout_by_region=[(day, 8, "BOG", 2.0) for day in days])
    names = tuple(f"few_{name}_{uuid.uuid4().hex}" for name in ("demand", "dates", "starts"))
    run_full_load(spark, tables, AS_OF, "CO", *names)
    stored = spark.table(names[0])
    assert stored.select("date").distinct().count() == 5 and len(stored.inputFiles()) == 2
    assert spark.table(names[1]).count() == 5
    for name in names:
        spark.sql(f"DROP TABLE {name}")
