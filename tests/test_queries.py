"""Some queries against DuckDB on the smallest data; validation.compare runs them all."""

import pytest

from validation.compare import difference, oracle_connection
from validation.oracle_queries import ORACLE
from validation.spark_queries import QUERIES

SF = "/root/testdata/sf0.001"
CHECKED = ("zone_join", "order_lines_bucketed", "order_lines_user_blacklist", "forecast_chain", "demand_by_view", "demand_all_variants", "daily_run_stored", "mafe_category", "design_matrix")


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, name):
    expected = oracle_connection(SF).execute(ORACLE[name]).df()
    assert difference(QUERIES[name](spark, SF).toPandas(), expected) is None
