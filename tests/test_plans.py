"""The plans that matter at scale, read from the query plans themselves."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from demandlab.operators.datasets import select_datasets
from demandlab.operators.order_lines import closed_orders, order_lines
from demandlab.operators.outliers import count_lines
from demandlab.plans.demand import VARIANT, build_demand
from demandlab.plans.evaluation import Evaluation, evaluation_cases
from demandlab.sources.order_layout import BUCKET_BYTES, buckets_for, store_orders
from demandlab.sources.schemas import TABLE_COLUMNS
from demandlab.sources.tables import parquet_tables
from validation.adapter import ANCHORS, AS_OF, source_tables

SF = "/root/testdata/sf0.001"
STORED = [name for name in TABLE_COLUMNS if name not in ("demand", "input_demand", "forecast")]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """The model's tables as Parquet, as they would lie in production."""
    folder = tmp_path_factory.mktemp("stored")
    tables = source_tables(spark, SF)
    for name in STORED:
        getattr(tables, name).coalesce(1).write.parquet(f"{folder}/{name}")
    return parquet_tables(spark, str(folder), *STORED)


def plan(df, mode="formatted"):
    jvm = df.sparkSession._jvm
    text = df._jdf.queryExecution().explainString(jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode))
    return text.split("== Initial Plan ==")[0] if "== Initial Plan ==" in text else text


def scans(df, table):
    """How often the executed plan reads a table; df has been run."""
    jvm = df.sparkSession._jvm
    text = df._jdf.queryExecution().explainString(jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    tree = text.split("== Initial Plan ==")[0]
    ids = set(re.findall(r"Scan parquet\s+\((\d+)\)", tree))
    details = dict(re.findall(r"\((\d+)\) Scan parquet[^\n]*\n(.*?)\n\n", text, re.S))
    return sum(f"/{table}]" in details.get(i, "") for i in ids)


def test_all_variants_read_the_lines_once(stored):
    datasets = select_datasets(stored)
    counted = count_lines(order_lines(stored, datasets, AS_OF))
    counted.collect()
    assert scans(counted, "order_line") == 1
    assert scans(counted, "order_header") == 2  # zone orders and key accounts
    df = build_demand(stored, AS_OF)
    df.collect()
    assert scans(df, "order_line") == scans(df, "order_header") == 0  # thresholds and demand read the written counts


def test_filters_and_columns_reach_the_scan(stored):
    text = plan(closed_orders(stored, AS_OF).select("id"))
    assert "PushedFilters" in text and "EqualTo(status,1)" in text and "LessThanOrEqual(close_date" in text
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {"id", "status", "close_date"}


def test_no_cross_join_and_no_fact_is_shuffled_for_a_dimension(stored):
    text = plan(build_demand(stored, AS_OF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    # The only joins that may shuffle are orders to lines and thresholds to counts.
    assert text.count("SortMergeJoin") + text.count("ShuffledHashJoin") <= 2


def test_restriction_keeps_the_whole_history_for_thresholds(stored, rows_of):
    day = F.col("date") == F.lit(AS_OF)
    restricted = build_demand(stored, AS_OF, restriction=day).filter("experiment IN ('experiment_4', 'experiment_6')")
    whole = build_demand(stored, AS_OF).filter(day & F.col("experiment").isin("experiment_4", "experiment_6"))
    assert rows_of(restricted) == rows_of(whole)


def test_dataset_side_has_a_known_small_size(stored):
    size = select_datasets(stored, "c0")._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    assert int(str(size)) < 100_000


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.fixture
def bucketed(spark, stored):
    """Headers and lines in buckets of the order; written twice, as after a failure."""
    for _ in range(2):
        tables = store_orders(stored, "headers_by_order", "lines_by_order", buckets_for(spark, 0))
    yield tables
    spark.sql("DROP TABLE headers_by_order")
    spark.sql("DROP TABLE lines_by_order")


def test_headers_and_lines_in_buckets_meet_without_an_exchange(bucketed, stored, no_broadcast):
    headers, lines = bucketed.order_header, bucketed.order_line
    joined = headers.join(lines, F.col("id") == F.col("order_id"))
    assert "Exchange" not in plan(joined)
    assert "Bucketed: true" in plan(joined)
    plain = stored.order_header.join(stored.order_line, F.col("id") == F.col("order_id"))
    assert "Exchange" in plan(plain)
    assert sorted(map(tuple, joined.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)


def test_number_of_buckets(spark):
    least = 1 << (int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length()
    assert buckets_for(spark, 0) == buckets_for(spark, 1) == least
    assert buckets_for(spark, 10 << 40) == 65536  # 10 TB of lines
    assert BUCKET_BYTES * buckets_for(spark, (1 << 40) + 1) >= (1 << 40) + 1


def test_bucketed_lines_are_joined_where_they_lie(bucketed, no_broadcast):
    """Only the much smaller header side moves, after it was routed to datasets."""
    tree = plan(order_lines(bucketed, select_datasets(bucketed), AS_OF)).split("\n\n")[0]
    lines = tree.split("lines_by_order")[0].splitlines()
    depth = len(lines[-1]) - len(lines[-1].lstrip(" :+-"))
    above = []
    for line in reversed(lines[:-1]):
        indent = len(line) - len(line.lstrip(" :+-"))
        if indent < depth:
            above.append(line)
            depth = indent
        if "SortMergeJoin" in line and line in above:
            break
    assert above and not any("Exchange" in line for line in above)


def test_anchor_span_reaches_the_fact_scans(stored):
    cases = evaluation_cases(select_datasets(stored), ANCHORS, 40)
    text = plan(Evaluation(stored, cases, AS_OF).daily_sales_value())
    assert f"GreaterThanOrEqual(close_date,{min(ANCHORS).isoformat()})" in text
    assert f"LessThanOrEqual(close_date,{(max(ANCHORS) + dt.timedelta(days=40)).isoformat()})" in text
    assert text.count("SortMergeJoin") + text.count("ShuffledHashJoin") <= 1  # orders to lines


def test_a_dataset_restricts_points_before_the_polygon_test(stored):
    text = plan(build_demand(stored, AS_OF, [VARIANT[1]], "C1", 11)).split("\n\n")[0].splitlines()
    polygon = next(i for i, line in enumerate(text) if "SemiJoin" in line or "LeftSemi" in line)
    assert polygon > 0
    optimized = build_demand(stored, AS_OF, [VARIANT[1]], "C1", 11)._jdf.queryExecution().optimizedPlan().toString()
    lines = optimized.splitlines()
    test = next(i for i, line in enumerate(lines) if "edges" in line and "exists" in line)
    inner = [line for line in lines[test:] if "LeftSemi" in line]
    assert len(inner) >= 2  # headers by region, zones and groups by group, below the polygon test


def test_one_day_needs_no_window_over_days(stored):
    text = plan(build_demand(stored, AS_OF, [VARIANT[1], VARIANT[5]], day=AS_OF))
    assert "Window" not in text
    assert f"EqualTo(close_date,{AS_OF.isoformat()})" in text


def test_one_day_equals_the_day_of_the_whole(stored, rows_of):
    day = build_demand(stored, AS_OF, day=AS_OF)
    assert rows_of(day) == rows_of(build_demand(stored, AS_OF, restriction=F.col("date") == F.lit(AS_OF)))
