import datetime as dt
from pathlib import Path

import pytest

from demandlab.session import CHECKPOINT_SETTING, intermediate_results, materialize, shared_folder
from demandlab.sources.demand_table import BY_DATASET, PARTITION_COLUMNS, append_demand, create_demand_table, name_temporarily, replace_dataset, replace_day, store_table
from demandlab.sources.schemas import schema_of
from demandlab.sources.tables import Tables, catalog_tables

MONDAY = dt.date(2022, 8, 1)


@pytest.fixture
def loaded(spark):
    rows = [(MONDAY, 1, 2.5, 10), (MONDAY, 2, 1.0, 11)]
    return spark.createDataFrame(rows, schema_of("input_demand"))


def test_text_identifiers_become_numbers(spark):
    raw = spark.createDataFrame(
        [("7", "2022-08-01", 1.5, "BOG", "extra")],
        "product_id string, close_date string, stockout_demand double, region_code string, more string",
    )
    table = Tables({"stockout_by_region": raw}).stockout_by_region
    assert table.schema == schema_of("stockout_by_region")
    assert table.first().product_id == 7


def test_missing_columns_and_tables_are_named(spark):
    tables = Tables({"country": spark.createDataFrame([(1,)], "country_id int")})
    with pytest.raises(ValueError, match="identifier_value"):
        tables.country
    with pytest.raises(KeyError, match="site"):
        tables.site
    with pytest.raises(AttributeError):
        tables.unknown


def test_append_adds_and_replace_keeps_the_other_dataset(spark, loaded, rows_of):
    spark.sql("DROP TABLE IF EXISTS loads")
    create_demand_table(spark, "loads", layout="input_demand")
    append_demand(loaded, "loads", "input_demand")
    append_demand(loaded, "loads", "input_demand")
    assert spark.table("loads").count() == 4
    replace_dataset(loaded, "loads", 10, "input_demand")
    columns = ("dp_input_datasets_id", "product_id", "demand")
    assert rows_of(spark.table("loads"), *columns) == [(10, 1, 2.5), (11, 2, 1.0), (11, 2, 1.0)]
    read = catalog_tables(spark, {"input_demand": "loads"}).input_demand
    assert read.schema.names == schema_of("input_demand").names
    spark.sql("DROP TABLE loads")


def test_results_get_names(spark, loaded, rows_of):
    spark.sql("DROP TABLE IF EXISTS stored_result")
    store_table(loaded, "stored_result")
    assert rows_of(spark.table("stored_result")) == rows_of(loaded)
    assert rows_of(name_temporarily(loaded, "named_result")) == rows_of(spark.sql("SELECT * FROM named_result"))
    spark.sql("DROP TABLE stored_result")


def test_materialized_rows_and_folder(spark, loaded, rows_of):
    assert rows_of(materialize(loaded, "copy")) == rows_of(loaded)

    class Cluster:
        def __init__(self, folder):
            self.conf = {CHECKPOINT_SETTING: folder} if folder else {}
            self.sparkContext = type("Context", (), {"master": "yarn"})

    assert shared_folder(Cluster("hdfs:///shared")) == "hdfs:///shared"
    with pytest.raises(ValueError, match=CHECKPOINT_SETTING):
        shared_folder(Cluster(None))


@pytest.fixture(params=["static", "dynamic"])
def overwrite_mode(spark, request):
    setting = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(setting)
    spark.conf.set(setting, request.param)
    yield request.param
    spark.conf.set(setting, before)


def test_replacing_leaves_no_stale_rows_in_any_mode(spark, rows_of, overwrite_mode):
    schema, columns = schema_of("input_demand"), ("date", "product_id")
    rows = lambda *values: spark.createDataFrame(list(values), schema)
    tuesday = MONDAY + dt.timedelta(days=1)
    for table in ("replaced", "elsewhere"):
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    create_demand_table(spark, "replaced", layout="input_demand")
    append_demand(rows((MONDAY, 1, 1.0, 10), (tuesday, 2, 1.0, 10), (MONDAY, 9, 1.0, 11)), "replaced", "input_demand")
    replace_dataset(rows((MONDAY, 3, 1.0, 10)), "replaced", 10, "input_demand")
    assert rows_of(spark.table("replaced"), *columns) == [(MONDAY, 3), (MONDAY, 9)]
    replace_day(rows((MONDAY, 4, 1.0, 10), (tuesday, 5, 1.0, 10)), "replaced", 10, MONDAY, "input_demand")
    assert rows_of(spark.table("replaced"), *columns) == [(MONDAY, 4), (MONDAY, 9)]
    replace_day(rows(), "replaced", 11, MONDAY, "input_demand")
    assert rows_of(spark.table("replaced"), *columns) == [(MONDAY, 4)]
    replace_dataset(rows(), "replaced", 10, "input_demand")
    assert spark.table("replaced").count() == 0
    spark.sql("CREATE TABLE elsewhere (product_id BIGINT, demand DOUBLE, dp_input_datasets_id INT, `date` DATE) USING parquet PARTITIONED BY (dp_input_datasets_id, `date`)")
    if overwrite_mode == "dynamic":
        with pytest.raises(ValueError, match="partitionOverwriteMode"):
            replace_dataset(rows(), "elsewhere", 10, "input_demand")
    else:
        replace_dataset(rows(), "elsewhere", 10, "input_demand")
    spark.sql("DROP TABLE replaced")
    spark.sql("DROP TABLE elsewhere")


def test_a_filled_location_is_picked_up(spark, loaded, rows_of, tmp_path):
    for table in ("first_name", "second_name"):
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        create_demand_table(spark, table, f"file://{tmp_path}/filled", "input_demand")
        if table == "first_name":
            append_demand(loaded, table, "input_demand")
    assert rows_of(spark.table("second_name"), "product_id") == [(1,), (2,)]
    spark.sql("DROP TABLE first_name")
    spark.sql("DROP TABLE second_name")


def test_intermediate_results_go_with_their_block(spark):
    outside = materialize(spark.range(3), "outside")
    with intermediate_results(spark):
        inner = materialize(spark.range(5), "inner")
        with intermediate_results(spark):
            innermost = materialize(spark.range(7), "innermost")
        assert inner.count() == 5 and not exists(innermost)
    assert not exists(inner) and exists(outside)
    with pytest.raises(RuntimeError), intermediate_results(spark):
        failed = materialize(spark.range(2), "failed")
        raise RuntimeError
    assert not exists(failed) and outside.count() == 3


def exists(df):
    return Path(df.inputFiles()[0].removeprefix("file://")).parent.exists()


def test_a_table_by_dataset_has_no_file_for_every_day(spark, rows_of, tmp_path):
    rows = spark.createDataFrame([(MONDAY + dt.timedelta(days=k), k, 1.0, 10 + k % 2) for k in range(60)], schema_of("input_demand"))
    place = f"file://{tmp_path}/by_dataset"
    for table in ("few_files", "few_files_again"):
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        create_demand_table(spark, table, place, "input_demand", BY_DATASET if table == "few_files" else PARTITION_COLUMNS)
        if table == "few_files":
            append_demand(rows, table, "input_demand")
            append_demand(rows, table, "input_demand")
            replace_dataset(rows, table, 10, "input_demand")
            assert spark.table(table).count() == 30 + 60 and len(list(tmp_path.rglob("*.parquet"))) <= 4
            replace_dataset(rows, table, 11, "input_demand")
            assert rows_of(spark.table(table), *rows.columns) == rows_of(rows)
    # Another table at the place is partitioned as the files there are.
    assert rows_of(spark.table("few_files_again"), *rows.columns) == rows_of(rows)
    replace_dataset(rows.limit(0), "few_files_again", 10, "input_demand")
    assert rows_of(spark.table("few_files_again"), *rows.columns) == rows_of(rows.filter("dp_input_datasets_id = 11"))
    spark.sql("DROP TABLE few_files")
    spark.sql("DROP TABLE few_files_again")


def test_files_of_every_day_stay_readable_by_dataset(spark, loaded, rows_of, tmp_path):
    place = f"file://{tmp_path}/days"
    for table in ("older", "newer"):
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    create_demand_table(spark, "older", place, "input_demand")
    append_demand(loaded, "older", "input_demand")
    create_demand_table(spark, "newer", place, "input_demand", BY_DATASET)
    assert rows_of(spark.table("newer"), *loaded.columns) == rows_of(loaded)
    replace_dataset(loaded.limit(0), "newer", 10, "input_demand")
    assert rows_of(spark.table("newer"), "product_id") == [(2,)]
    for table in ("older", "newer"):
        spark.sql(f"DROP TABLE {table}")


def test_a_materialized_table_by_dataset_reads_one_folder(spark, loaded, rows_of):
    copy = materialize(loaded, "copy", BY_DATASET)
    assert rows_of(copy, *loaded.columns) == rows_of(loaded)
    plan = copy.filter("dp_input_datasets_id = 10")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dp_input_datasets_id" in plan
