"""Benchmark decontamination as a prefix-filtered set join.

A window is `window` consecutive words of a benchmark item; an item of fewer
words, but not none, is one window. A document word inside any occurrence of a
window is hit.

The join: every item is cut into shingles, and all documents are counted once to
order the shingles by rarity. Containment needs all shingles of a window, so its
prefix is the one rarest shingle; only prefixes are joined. Documents send the
occurrences that pass a Bloom filter of fixed size, with the words around them.
A pair stays if the document is as long as the window and the words on both
sides of the shared shingle agree over a whole window (compared as words, so the
result is exact).

Cases: a null or empty text has no words; a document row gets one result row,
also when it is repeated or its id is null; items without words match nothing;
repeated items count once; windows of an item without an id count as hits but
not as an item; other columns are ignored. Lists are bounded by one text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandlab.llm.bloom import FILTER_BITS, build, may_contain
from demandlab.llm.words import Words, shingle_hashes, text_slices
from demandlab.session import materialize

WINDOW, SHINGLE = 13, 4


def _item_shingles(window: int, shingle: int):
    """Rows (item_id, item_key, n_words, at, size, shingle, around, before) of every item."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            words = Words(batch["text"])
            hashes = words.hashes()
            runs = {k: shingle_hashes(hashes, k).view(np.int64) for k in range(1, shingle + 1)}
            out = []
            for row in range(words.rows):
                low, high = words.first[row], words.first[row + 1]
                size = min(shingle, int(high - low))
                text = words.texts(low, high)
                for at in range(high - low - size + 1 if size else 0):
                    start = max(0, at + size - window)
                    around = text[start : at + window]
                    out.append((batch["item_id"][row].as_py(), batch["item_key"][row].as_py(), len(text), at, size, int(runs[size][low + at]), around, at - start))
            yield pa.RecordBatch.from_pylist([dict(zip(_ITEM.names, x)) for x in out], schema=_ITEM)

    return rows


_ITEM = pa.schema([("item_id", pa.string()), ("item_key", pa.int64()), ("item_words", pa.int32()), ("at", pa.int32()), ("size", pa.int32()), ("shingle", pa.int64()), ("item_around", pa.list_(pa.string())), ("item_before", pa.int32())])
_ITEM_DDL = "item_id string, item_key long, item_words int, at int, size int, shingle long, item_around array<string>, item_before int"


def _occurrences(words: Words, sizes: list[int], held: np.ndarray):
    """(size, position of the first word, hash) of the shingles that may be in the filter."""
    hashes = words.hashes()
    for size in sizes:
        runs = shingle_hashes(hashes, size)
        found = np.flatnonzero(may_contain(held, runs))
        found = found[words.row[found] == words.row[found + size - 1]]
        yield size, found, runs[found].view(np.int64)


def _counting(sizes: list[int], held):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            for size, _, found in _occurrences(Words(batch["text"]), sizes, held.value):
                value, count = np.unique(found, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(value), size, np.int32)), pa.array(value), pa.array(count)], ["size", "shingle", "n"])

    return rows


_HITS = pa.list_(pa.struct([("size", pa.int32()), ("position", pa.int32()), ("shingle", pa.int64()), ("around", pa.list_(pa.string())), ("before", pa.int32())]))


def _finding(sizes: list[int], held, window: int):
    """Every document row with its number of words and the occurrences of possible prefixes."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            words = Words(batch["text"])
            hits = [[] for _ in range(words.rows)]
            for size, found, values in _occurrences(words, sizes, held.value):
                for word, value in zip(found.tolist(), values.tolist()):
                    row = int(words.row[word])
                    low = max(int(words.first[row]), word + size - window)
                    high = min(int(words.first[row + 1]), word + window)
                    hits[row].append({"size": size, "position": word - int(words.first[row]), "shingle": value, "around": words.texts(low, high), "before": word - low})
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["text_key"], pa.array(words.counts), pa.array(hits, _HITS)], ["doc_id", "text_key", "n_words", "hits"])

    return rows


def _run(doc, doc_at, item, item_at, length, step):
    """How many of `length` words from the two places on, in direction `step`, agree one after the other."""
    at = lambda words, place, i: F.get(words, place + i * step)
    same = F.transform(F.sequence(F.lit(0), length - 1), lambda i: at(doc, doc_at, i) == at(item, item_at, i))
    first = F.array_position(same, False).cast("int")
    return F.when(length <= 0, 0).when(first == 0, length).otherwise(first - 1)


def prefixes(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, bits: int = FILTER_BITS) -> DataFrame:
    """The rarest shingle of every window, rarity counted over all documents; ties go to the smaller hash."""
    spark = documents.sparkSession
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").distinct()
    items = items.withColumn("item_key", F.xxhash64("item_id", "text"))
    items = materialize(items.mapInArrow(_item_shingles(window, shingle), _ITEM_DDL), "benchmark-shingles")
    sizes = [r[0] for r in items.select("size").distinct().collect()]
    held = spark.sparkContext.broadcast(build(items.select("shingle").distinct(), F.col("shingle"), bits))
    counts = documents.select("text").mapInArrow(_counting(sizes, held), "size int, shingle long, n long")
    counts = counts.groupBy("size", "shingle").agg(F.sum("n").alias("n"))
    ranked = items.join(counts, ["size", "shingle"], "left").groupBy("item_id", "item_key", "item_words", "size").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("at", F.coalesce("n", F.lit(0)).alias("n"), "shingle"))), lambda x: F.struct(x["n"], x["shingle"], x["at"])).alias("all")
    )
    length = F.least(F.lit(window), F.col("item_words"))
    rarest = F.transform(F.sequence(F.lit(1), F.col("item_words") - length + 1), lambda start: F.array_min(F.slice("all", start, length - F.col("size") + 1)))
    chosen = ranked.select("item_key", F.explode(F.array_distinct(rarest)).alias("x")).select("item_key", F.col("x.at").alias("at"))
    return items.join(chosen, ["item_key", "at"])


def contamination(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, bits: int = FILTER_BITS) -> DataFrame:
    """Per document row: doc_id, text_key, n_words, n_hit, n_items and the sorted item ids (as strings)."""
    spark = documents.sparkSession
    documents = documents.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    prefix = materialize(prefixes(documents, benchmark, window, shingle, bits), "benchmark-prefixes")
    sizes = [r[0] for r in prefix.select("size").distinct().collect()]
    held = spark.sparkContext.broadcast(build(prefix.select("shingle").distinct(), F.col("shingle"), bits))
    kind = documents.schema["doc_id"].dataType.simpleString()
    found = documents.mapInArrow(
        _finding(sizes, held, window),
        f"doc_id {kind}, text_key long, n_words long, hits array<struct<size:int,position:int,shingle:long,around:array<string>,before:int>>",
    )
    found = materialize(found, "document-occurrences")
    pairs = found.select("doc_id", "text_key", "n_words", F.explode("hits").alias("h")).select("doc_id", "text_key", "n_words", "h.*").join(prefix, ["size", "shingle"])
    length = F.least(F.lit(window), F.col("item_words"))
    pairs = pairs.filter(F.col("n_words") >= length)
    size = F.col("size")
    behind = F.least("before", "item_before")
    ahead = F.least(F.size("around") - F.col("before"), F.size("item_around") - F.col("item_before"))
    pairs = pairs.select(
        "doc_id", "text_key", "item_id", "position", length.alias("length"),
        _run(F.col("around"), F.col("before") - 1, F.col("item_around"), F.col("item_before") - 1, behind, -1).alias("left"),
        _run(F.col("around"), F.col("before"), F.col("item_around"), F.col("item_before"), ahead, 1).alias("right"),
        "size",
    )
    pairs = pairs.filter((F.col("right") >= size) & (F.col("left") + F.col("right") >= F.col("length")))
    # Copies of one row find the same spans, and the sets keep one of each.
    spans = pairs.groupBy("doc_id", "text_key").agg(
        F.sort_array(F.collect_set(F.struct((F.col("position") - F.col("left")).alias("low"), (F.col("position") + F.col("right")).alias("high")))).alias("spans"),
        F.sort_array(F.collect_set("item_id")).alias("items"),
    )
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("reach"), F.lit(0).cast("long").alias("n")),
        lambda a, x: F.struct(F.greatest(a["reach"], x["high"]).alias("reach"), (a["n"] + F.greatest(F.lit(0), x["high"] - F.greatest(a["reach"], x["low"]))).cast("long").alias("n")),
        lambda a: a["n"],
    )
    spans = spans.select(F.col("doc_id").alias("id"), F.col("text_key").alias("key"), covered.alias("n_hit"), "items")
    joined = found.select("doc_id", "text_key", "n_words").join(spans, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_key") == F.col("key")), "left")
    return joined.select("doc_id", "text_key", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def judged(found: DataFrame, share: int = 20) -> DataFrame:
    """Adds n_items, the digest of the item ids, and whether one word in `share` or more is hit."""
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
        "text_key",
    )
