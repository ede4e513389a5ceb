import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandlab.llm import bloom


def plain(keys, bits):
    """The filter's words, bit by bit."""
    out = np.zeros(bits // 64, dtype=np.uint64)
    for key in keys.tolist():
        for place in (key % bits, (key >> 32) % bits):
            out[place // 64] |= np.uint64(1 << place % 64)
    return out


@pytest.mark.parametrize("n, bits", [(0, 64), (1, 64), (3000, 1 << 12), (3000, 1 << 16)])
def test_equal_to_setting_every_bit(spark, n, bits):
    keys = np.random.default_rng(n + 1).integers(0, 1 << 64, n, dtype=np.uint64)
    frame = spark.createDataFrame([(int(k),) for k in keys.view(np.int64).repeat(2)], "k long")
    words = bloom.build(frame, F.col("k"), bits)
    assert words.dtype == np.uint64 and words.tolist() == plain(keys, bits).tolist()
    assert bloom.may_contain(words, keys).all()


def test_the_driver_holds_a_full_filter_as_arrays_not_an_object_a_word(spark):
    bits = 1 << 22
    keys = spark.range(bits // 16).select(F.xxhash64("id").alias("k"))
    bloom.build(keys.limit(10), F.col("k"), 64)
    tracemalloc.start()
    try:
        words = bloom.build(keys, F.col("k"), bits)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert (words != 0).mean() > 0.99
    assert most < 4 * words.nbytes
