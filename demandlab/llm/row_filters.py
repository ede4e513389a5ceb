"""Leaving out rows that a join would drop, or a task has had, before they are shuffled or worked on."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandlab.llm import bloom

#: Bits of a filter of keys in front of a join: sixteen a key, and no filter if that were over the bound.
LEAST_BITS, MOST_BITS = 1 << 16, 1 << 28


def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of texts that the task has not had yet. Copies beyond the first add nothing but work."""
    seen: set[int] = set()
    for batch in batches:
        keys = batch["text_key"].to_pylist()
        new = [k for k, key in enumerate(keys) if not (key in seen or seen.add(key))]
        yield batch if len(new) == len(keys) else batch.take(pa.array(new, pa.int64()))


def possible(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows whose key may be among the keys (a written table of distinct ones); all rows if there are too many keys."""
    count = keys.count()
    if 16 * count > MOST_BITS:
        return rows
    bits = max(LEAST_BITS, 1 << (16 * count - 1).bit_length())
    spread = F.xxhash64(key)
    held = rows.sparkSession.sparkContext.broadcast(bloom.build(keys.select(spread.alias("k")), F.col("k"), bits))

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = bloom.may_contain(held.value, batch["_spread"].to_numpy().view(np.uint64))
            yield batch.filter(pa.array(keep)).drop_columns(["_spread"])

    return rows.withColumn("_spread", spread).mapInArrow(chosen, rows.schema)
