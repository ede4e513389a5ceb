import duckdb
import pytest

from demandlab.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "benchmark", "embeddings", "pages"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    theirs, ours = connection.execute(ORACLE[name]), QUERIES[name](spark, SF)
    columns = [c[0] for c in theirs.description]
    assert sorted(columns) == sorted(ours.columns)
    assert sorted(map(tuple, ours.select(*columns).collect()), key=str) == sorted(theirs.fetchall(), key=str)


def test_operators_are_registered_once_each():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES if name.startswith("op")) == list(range(1, 14))
