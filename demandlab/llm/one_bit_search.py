"""Nearest neighbours by inner product with randomly rotated one-bit codes.

A vector of unit length is padded to `EXPANSION` times its dimensions, rotated by
a random orthogonal matrix and kept as the signs, packed to bits, with two
scalars: its length, and the inner product of the rotated vector and its signs.
These give an unbiased estimate of its inner product with any query and a bound
of the error (`EPSILON` standard deviations). In every block a candidate is
reranked if its upper bound reaches the k-th largest lower bound; the original
vectors, in double precision and summed in order, give the scores.

The queries are a stated set of rows. Candidates and queries are dealt into blocks
of bounded size and each two blocks meet once; every candidate is coded and
looked at, so nothing but the error bound decides.

Cases: vectors that are null, empty, zero or hold null or non-finite components,
and rows without an id, take no part; only vectors of equal dimensions are
compared; a row repeated with the same vector counts once; rows with the query's
own id are no candidates; ties go to the smaller id; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandlab.session import materialize

EXPANSION, EPSILON = 4, 3.0
MOST_QUERIES, MOST_CANDIDATES, FEW_CANDIDATES = 2048, 32768, 512


def rotation(dimensions: int, expansion: int = EXPANSION, seed: int = 11) -> np.ndarray:
    """The first `dimensions` rows of a random orthogonal matrix: pads and rotates at once."""
    size = dimensions * expansion
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((size, size)))
    return (q * np.sign(np.diag(r)))[:dimensions]


def code(vectors: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(packed bits, lengths, corrections) of the rows."""
    lengths = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))
    turned = (vectors / lengths[:, None]) @ turn
    return np.packbits(turned > 0, axis=1), lengths, np.abs(turned).sum(axis=1) / math.sqrt(turn.shape[1])


def estimates(bits: np.ndarray, corrections: np.ndarray, queries: np.ndarray, turn: np.ndarray, epsilon: float) -> tuple[np.ndarray, np.ndarray]:
    """Estimated cosines (queries x candidates) and the bound of the error of each candidate's."""
    size = turn.shape[1]
    signs = np.unpackbits(bits, axis=1, count=size).astype(np.float32) * 2 - 1
    unit = queries / np.sqrt((queries**2).sum(axis=1))[:, None]
    cosine = (unit @ turn).astype(np.float32) @ signs.T / np.float32(math.sqrt(size)) / corrections.astype(np.float32)
    error = epsilon * np.sqrt(np.maximum(0, 1 - corrections**2)) / corrections / math.sqrt(size - 1) + 1e-5
    return cosine, error.astype(np.float32)


def _coding(expansion: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns: dict[int, np.ndarray] = {}
        for batch in batches:
            for n in np.unique(sizes := batch["dimensions"].to_numpy()):
                part = batch.filter(pa.array(sizes == n))
                turn = turns.setdefault(int(n), rotation(int(n), expansion))
                vectors = part["embedding"].flatten().to_numpy().reshape(-1, n)
                bits, lengths, corrections = code(vectors, turn)
                columns = [part["vec_id"], part["embedding"], part["dimensions"], pa.array([b.tobytes() for b in bits], pa.binary()), pa.array(lengths), pa.array(corrections)]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "embedding", "dimensions", "bits", "length", "correction"])

    return rows


def _searching(k: int, expansion: int, epsilon: float):
    def search(group: pd.DataFrame) -> pd.DataFrame:
        n = int(group["dimensions"].iloc[0])
        queries, candidates = (group[group["is_query"] == flag].sort_values("vec_id", ignore_index=True) for flag in (True, False))
        none = pd.DataFrame({"query_id": [], "query_key": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "query_key": "int64", "vec_id": "int64"})
        if queries.empty or candidates.empty:
            return none
        turn = rotation(n, expansion)
        bits = np.frombuffer(b"".join(candidates["bits"]), np.uint8).reshape(len(candidates), -1)
        raw = np.stack(candidates["embedding"].to_numpy()).astype(np.float64)
        asked = np.stack(queries["embedding"].to_numpy()).astype(np.float64)
        ids, own, key = candidates["vec_id"].to_numpy(), queries["vec_id"].to_numpy(), queries["query_key"].to_numpy()
        length, out = candidates["length"].to_numpy().astype(np.float32), []
        for low in range(0, len(asked), 64):
            part = asked[low : low + 64]
            cosine, error = estimates(bits, candidates["correction"].to_numpy(), part, turn, epsilon)
            # Per query the length of the query is a common factor.
            lower, upper = (cosine - error) * length, (cosine + error) * length
            same = own[low : low + 64, None] == ids[None, :]
            lower[same], upper[same] = -np.inf, -np.inf
            least = np.partition(lower, len(ids) - k, axis=1)[:, len(ids) - k] if len(ids) > k else np.full(len(part), -np.inf)
            query, found = np.nonzero((upper >= least[:, None]) & ~same)
            scores = np.empty(len(query))
            for a in range(0, len(query), 1 << 16):  # a running sum adds in order, so equal vectors get equal scores
                b = a + (1 << 16)
                scores[a:b] = np.cumsum(raw[found[a:b]] * part[query[a:b]], axis=1)[:, -1]
            order = np.lexsort((ids[found], -scores, query))
            query, found, scores = query[order], found[order], scores[order]
            rank = np.arange(len(query)) - np.searchsorted(query, query)
            best = rank < k
            out.append(pd.DataFrame({"query_id": own[low + query[best]], "query_key": key[low + query[best]], "vec_id": ids[found[best]], "score": scores[best]}))
        return pd.concat(out)

    return search


def usable(vector: str) -> Column:
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.col(vector).isNotNull() & F.forall(vector, number) & F.exists(vector, lambda x: x != 0)


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, expansion: int = EXPANSION, epsilon: float = EPSILON) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows of each row that is a query. vectors: vec_id and embedding."""
    spark = vectors.sparkSession
    vectors = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", is_query.alias("asked")).filter(F.col("vec_id").isNotNull() & usable("embedding"))
    vectors = vectors.dropDuplicates(["vec_id", "embedding"]).withColumn("dimensions", F.size("embedding"))
    kind = vectors.schema["embedding"].dataType.simpleString()
    schema = f"vec_id long, embedding {kind}, dimensions int, bits binary, length double, correction double"
    coded = materialize(vectors.select("vec_id", "embedding", "dimensions").mapInArrow(_coding(expansion), schema), "codes")
    asked = vectors.filter("asked").select("vec_id", "embedding", "dimensions")
    # Blocks of each number of dimensions: as many as sizes need, and enough to keep the executors busy.
    counts = coded.groupBy("dimensions").agg(F.count("*").alias("n"))
    counts = counts.join(asked.groupBy("dimensions").agg(F.count("*").alias("n_asked")), "dimensions")
    spread = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = counts.select(
        "dimensions",
        F.ceil(F.col("n_asked") / MOST_QUERIES).cast("int").alias("query_blocks"),
        F.greatest(F.ceil(F.col("n") / MOST_CANDIDATES), F.least(F.lit(spread), F.ceil(F.col("n") / FEW_CANDIDATES))).cast("int").alias("candidate_blocks"),
    )
    key = F.xxhash64("vec_id", "embedding")
    queries = asked.join(blocks, "dimensions").select(
        "vec_id", "embedding", "dimensions", F.lit(None).cast("binary").alias("bits"), F.lit(None).cast("double").alias("length"), F.lit(None).cast("double").alias("correction"),
        F.lit(True).alias("is_query"), key.alias("query_key"), F.pmod(key, "query_blocks").alias("query_block"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("candidate_blocks") - F.lit(1).cast("long"))).alias("candidate_block"),
    )
    candidates = coded.join(blocks, "dimensions").select(
        "vec_id", "embedding", "dimensions", "bits", "length", "correction",
        F.lit(False).alias("is_query"), key.alias("query_key"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("query_blocks") - F.lit(1).cast("long"))).alias("query_block"), F.pmod(key, "candidate_blocks").alias("candidate_block"),
    )
    # A stated number of parts: few bytes of a block are much work, and adaptive execution would put all blocks into one task.
    met = queries.union(candidates).repartition(spread, "dimensions", "query_block", "candidate_block")
    found = met.groupBy("dimensions", "query_block", "candidate_block").applyInPandas(_searching(k, expansion, epsilon), "query_id long, query_key long, vec_id long, score double")
    best = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
