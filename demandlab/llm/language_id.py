"""Language identification by sparse multinomial logistic regression.

Features are the character n-grams (one to three) of the lower-cased whole text,
hashed to `DIMENSIONS` places and weighted by TF-IDF with unit length. Weights are
trained by follow-the-regularised-leader with L1 and L2 penalties on a bounded
sample: at most `PER_LANGUAGE` distinct texts are expected of each language,
chosen by the hash of the text. A part of the sample is kept from training and
sets the temperature that calibrates the probabilities.

Cases: a null text, and one without a letter, is `und` with score 0; so is every
text if there is nothing to learn from. Rows without a language are not learned
from; repeated texts count once in training; other columns pass through.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DIMENSIONS, SIZES, PER_LANGUAGE = 1 << 15, (1, 2, 3), 1500
ALPHA, BETA, L1, L2, EPOCHS, CALIBRATION = 0.5, 1.0, 0.02, 0.001, 3, 0.2
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")
_FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], dtype=np.uint64)


def features(text: str, dimensions: int = DIMENSIONS) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of a text: places and 1 + log of their counts."""
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    counts = np.zeros(dimensions, dtype=np.int64)
    shift = np.uint64(64 - dimensions.bit_length() + 1)
    for size in SIZES:
        hashed = np.full(max(0, len(codes) - size + 1), size, dtype=np.uint64)
        for k in range(size):
            hashed = (hashed + codes[k : k + len(hashed)]) * _FACTORS[k] * np.uint64(0x9E3779B97F4A7C15)
        counts += np.bincount((hashed >> shift).astype(np.int64), minlength=dimensions)
    places = np.flatnonzero(counts)
    return places, (1 + np.log(counts[places])).astype(np.float32)


@dataclass(frozen=True)
class Model:
    """Its size is bounded: dimensions x languages weights."""

    labels: list[str]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float

    def logits(self, text: str) -> np.ndarray:
        places, values = features(text, len(self.idf))
        return _unit(values * self.idf[places]) @ self.weights[places]

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.labels or not _LETTER.search(text):
            return UNKNOWN, 0.0
        shares = _softmax(self.logits(text) / self.temperature)
        best = int(np.argmax(shares))
        return self.labels[best], float(shares[best])


def _unit(values: np.ndarray) -> np.ndarray:
    return values / max(1e-12, float(np.sqrt(values @ values)))


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max())
    return e / e.sum()


def _fit(sample: pd.DataFrame, dimensions: int) -> Model:
    """Online training over the sample in the order of the texts' hashes."""
    sample = sample.sort_values("key", ignore_index=True)
    labels = sorted(sample["lang"].unique())
    target = np.searchsorted(labels, sample["lang"].to_numpy())
    df = np.zeros(dimensions)
    for places in sample["places"]:
        df[places] += 1
    idf = (np.log((1 + len(sample)) / (1 + df)) + 1).astype(np.float32)
    rows = [(places, _unit(values * idf[places])) for places, values in zip(sample["places"], sample["values"])]
    kept = max(1, int(len(rows) * CALIBRATION)) if len(rows) > len(labels) else 0
    z, n = np.zeros((dimensions, len(labels))), np.zeros((dimensions, len(labels)))

    def weights(places):
        own = z[places]
        return -np.sign(own) * np.maximum(np.abs(own) - L1, 0) / ((BETA + np.sqrt(n[places])) / ALPHA + L2)

    for _ in range(EPOCHS):
        for (places, values), label in zip(rows[kept:], target[kept:]):
            w = weights(places)
            error = _softmax(values @ w)
            error[label] -= 1
            gradient = values[:, None] * error[None, :]
            square = gradient**2
            own = n[places]
            z[places] += gradient - (np.sqrt(own + square) - np.sqrt(own)) / ALPHA * w
            n[places] = own + square
    w = weights(np.arange(dimensions)).astype(np.float32)
    logits = np.array([values @ w[places] for places, values in rows[:kept]]).reshape(kept, len(labels))

    def loss(temperature: float) -> float:
        scaled = logits / temperature
        top = scaled.max(axis=1)
        return float(np.mean(top + np.log(np.exp(scaled - top[:, None]).sum(axis=1)) - scaled[np.arange(kept), target[:kept]]))

    choices = np.geomspace(0.05, 5, 60)
    return Model(labels, idf, w, float(min(choices, key=loss)) if kept else 1.0)


def train(labelled: DataFrame, per_language: int = PER_LANGUAGE, dimensions: int = DIMENSIONS) -> Model:
    """A model from the columns text and lang. Only the sample reaches the training task, and only the model the driver."""
    labelled = labelled.select("text", "lang").filter(F.col("text").isNotNull() & F.col("lang").isNotNull())
    counts = {row["lang"]: row["n"] for row in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return Model([], np.zeros(dimensions, np.float32), np.zeros((dimensions, 0), np.float32), 1.0)
    share = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, per_language / n))])
    key = F.xxhash64("text")
    sample = labelled.filter(F.pmod(key, F.lit(1 << 30)) < share[F.col("lang")] * (1 << 30)).dropDuplicates(["text", "lang"])

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [features(text, dimensions) for text in batch["text"].to_pylist()]
            lists = [pa.array([r[k] for r in rows], pa.list_(t)) for k, t in ((0, pa.int64()), (1, pa.float32()))]
            yield pa.RecordBatch.from_arrays([batch["lang"], batch["key"], *lists], ["lang", "key", "places", "values"])

    def fitted(sample: pd.DataFrame) -> pd.DataFrame:
        model = _fit(sample, dimensions)
        return pd.DataFrame([{"labels": model.labels, "idf": model.idf.tobytes(), "weights": model.weights.tobytes(), "temperature": model.temperature}])

    sample = sample.withColumn("key", key).mapInArrow(featured, "lang string, key long, places array<long>, values array<float>")
    row = sample.groupBy(F.lit("all")).applyInPandas(fitted, "labels array<string>, idf binary, weights binary, temperature double").first()
    labels = list(row["labels"])
    return Model(labels, np.frombuffer(row["idf"], np.float32), np.frombuffer(row["weights"], np.float32).reshape(dimensions, len(labels)), row["temperature"])


def identify(documents: DataFrame, model: Model) -> DataFrame:
    """All rows and columns, and lang_pred and score."""
    held = documents.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predicted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([held.value.predict(text) for text in texts], columns=["lang_pred", "score"])

    return documents.withColumn("_language", predicted("text")).select(*[F.col(f"`{c}`") for c in documents.columns if c not in ("lang_pred", "score")], "_language.lang_pred", "_language.score")


def remainder(doc_id: str, modulus: int):
    """crc32 of an id as text, modulo `modulus`; null for a null id."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(modulus))
