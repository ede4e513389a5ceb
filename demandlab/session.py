"""Where a job may keep intermediate tables."""

from __future__ import annotations

import contextlib
import functools
import tempfile
import uuid
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="demandlab-")


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster.

    Only a local session without the setting gets a folder of its own; a cluster
    that names none is an error, because a machine-local folder would not be seen
    by the other machines.
    """
    folder = spark.conf.get(CHECKPOINT_SETTING, None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder that all executors share")
    return _local_folder()


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


# Paths written inside each open ``intermediate_results``.
_open_scopes: list[list[str]] = []


@contextlib.contextmanager
def intermediate_results(spark: SparkSession) -> Iterator[None]:
    """Remove on leaving what was materialized inside, also after a failure.

    Only for a block that ends with its result written elsewhere: a DataFrame that
    still reads an intermediate table fails afterwards.
    """
    written: list[str] = []
    _open_scopes.append(written)
    try:
        yield
    finally:
        # By identity: two scopes that have written the same are equal as lists.
        _open_scopes[:] = [scope for scope in _open_scopes if scope is not written]
        for place in written:
            path = spark._jvm.org.apache.hadoop.fs.Path(place)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, name: str, by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Use it for a result that several later branches read: the lineage is cut and
    the files outlive any executor. Branches that each read some values of the
    columns ``by`` read only the folders of those; these columns then come last.
    """
    path = fresh_path(df.sparkSession, name)
    for written in _open_scopes:
        written.append(path)
    df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
