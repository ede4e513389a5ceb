import sys
from collections.abc import Mapping
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql.pandas.types import to_arrow_schema

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from demandlab.sources.schemas import TABLE_COLUMNS, schema_of  # noqa: E402
from demandlab.sources.tables import Tables  # noqa: E402
from validation.compare import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session("4", 4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


class _LiteralFrames(Mapping):
    """Frames from literal rows, built when asked for; empty if no rows were given."""

    def __init__(self, spark, rows):
        self.spark, self.rows = spark, rows

    def __getitem__(self, name):
        schema = schema_of(name)
        columns = list(zip(*self.rows[name])) if self.rows.get(name) else [[] for _ in schema]
        arrow = to_arrow_schema(schema)
        table = pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)
        return self.spark.createDataFrame(table, schema)

    def __iter__(self):
        return iter(TABLE_COLUMNS)

    def __len__(self):
        return len(TABLE_COLUMNS)


@pytest.fixture
def make_tables(spark):
    """Tables from literal rows; a table that is not given is empty."""
    return lambda **rows: Tables(_LiteralFrames(spark, rows))


@pytest.fixture
def rows_of():
    """Rows as a sorted list of tuples; NULLs sort first."""

    def collect(df, *columns):
        rows = [tuple(row) for row in (df.select(*columns) if columns else df).collect()]
        return sorted(rows, key=lambda row: [(value is not None, value) for value in row])

    return collect
