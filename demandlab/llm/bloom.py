"""A Bloom filter of fixed size over 64-bit keys: built by Spark, tested in tasks."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a filter; the driver and every task hold an eighth of it in bytes, whatever the data.
FILTER_BITS = 1 << 24


def build(keys: DataFrame, key: Column, bits: int = FILTER_BITS) -> np.ndarray:
    """The filter's 64-bit words. At most bits / 64 rows come to the driver, as Arrow batches of 12 bytes a row, not as objects."""
    places = F.array(key, F.shiftrightunsigned(key, 32))
    bit = F.pmod(F.col("place"), F.lit(bits))
    words = (
        keys.select(F.explode(places).alias("place"))
        .groupBy(F.shiftright(bit, 6).cast("int").alias("word"))
        .agg(F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(pmod(place, {bits}), 64) as int))")).alias("mask"))
        .toArrow()
    )
    out = np.zeros(bits // 64, dtype=np.int64)
    for batch in words.to_batches():
        out[batch["word"].to_numpy()] = batch["mask"].to_numpy()
    return out.view(np.uint64)


def may_contain(words: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """False only where a key is certainly not in the filter. keys: unsigned 64-bit, `bits` a power of two."""
    bits = np.uint64(len(words) * 64 - 1)
    found = np.ones(len(keys), dtype=bool)
    for place in (keys & bits, (keys >> np.uint64(32)) & bits):
        found &= (words[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1
    return found
