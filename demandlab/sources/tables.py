"""The set of input tables a job reads."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from demandlab.sources.schemas import TABLE_COLUMNS, conform


@dataclass(frozen=True)
class Tables:
    """Named DataFrames, checked against the fixed schemas when first asked for.

    Any reader will do: Parquet, a catalog table, JDBC. One instance usually holds
    the facts of one country; several countries in the same tables work as well,
    because regions identify their country.
    """

    frames: Mapping[str, DataFrame]
    _checked: dict[str, DataFrame] = field(default_factory=dict, repr=False, compare=False)

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLE_COLUMNS:
            raise AttributeError(name)
        if name not in self._checked:
            if name not in self.frames:
                raise KeyError(f"no table {name} was given")
            self._checked[name] = conform(self.frames[name], name)
        return self._checked[name]

    def replacing(self, **frames: DataFrame) -> "Tables":
        return Tables({**self.frames, **frames})


def parquet_tables(spark: SparkSession, folder: str, *names: str) -> Tables:
    """Tables stored as ``folder/name`` in Parquet; all known ones by default."""
    chosen = names or tuple(TABLE_COLUMNS)
    return Tables({name: spark.read.parquet(f"{folder.rstrip('/')}/{name}") for name in chosen})


def catalog_tables(spark: SparkSession, names: Mapping[str, str]) -> Tables:
    """Tables found in the session catalog, as ``{model name: table name}``."""
    return Tables({model: spark.table(stored) for model, stored in names.items()})
