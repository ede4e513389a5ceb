import numpy as np
from pyspark.sql import functions as F

from demandlab.llm.one_bit_search import code, estimates, nearest, rotation

SCHEMA = "vec_id long, embedding array<float>, rank string"


def brute(rows, k):
    """(query, rank, id, score), scores summed in order in double precision."""
    good = {(i, tuple(v)) for i, v, _ in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    out = []
    for q, v in good:
        if q % 20 == 0:
            scores = []
            for i, w in good:
                if i != q and len(w) == len(v):
                    total = 0.0
                    for x, y in zip(np.float32(v).astype(float), np.float32(w).astype(float)):
                        total += x * y
                    scores.append((-total, i))
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(scores)[:k])]
    return sorted(out)


def found(spark, rows, **options):
    return sorted(tuple(r) for r in nearest(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 20 == 0, **options).collect())


def test_equals_brute_force_with_ties_and_odd_rows(spark):
    random = np.random.default_rng(4)
    rows = [(k, random.standard_normal(16).astype("float32").tolist(), "x") for k in range(400)]
    rows += [(500 + k, rows[7][1], "copy") for k in range(30)]
    rows += [(1000, None, ""), (1020, [], ""), (1040, [0.0] * 16, ""), (1060, [float("nan")] * 16, ""), (1080, [None] + [1.0] * 15, ""), (1100, [float("inf")] * 16, ""), (None, rows[1][1], "")]
    rows += [rows[20], rows[20], (2000, [1.0, 2.0], ""), (2001, [2.0, 1.0], ""), (2002, [1.0, 2.0], "")]
    assert found(spark, rows, k=20) == brute(rows, 20)


def test_fewer_candidates_than_wanted_and_none(spark):
    rows = [(0, [1.0, 0.0], ""), (1, [0.5, 0.5], ""), (2, [-1.0, 0.0], "")]
    assert found(spark, rows, k=20) == brute(rows, 20)
    assert found(spark, rows[:1], k=20) == [] == found(spark, [], k=20)


def test_estimates_stay_within_the_bound():
    random = np.random.default_rng(1)
    vectors, queries, turn = random.standard_normal((500, 32)), random.standard_normal((20, 32)), rotation(32)
    assert np.allclose(turn @ turn.T, np.eye(32))
    bits, lengths, corrections = code(vectors, turn)
    cosine, error = estimates(bits, corrections, queries, turn, 3.0)
    exact = (queries / np.linalg.norm(queries, axis=1)[:, None]) @ (vectors / lengths[:, None]).T
    assert (np.abs(cosine - exact) <= error).mean() > 0.99
    assert abs((cosine - exact).mean()) < 0.01
