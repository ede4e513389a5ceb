"""Removal of byte strings that occur more than once, by bucket-pointer refinement.

Every byte that lies in a string of `length` bytes which also starts at another
place of the corpus is removed: another document, or another offset of the same
one; overlapping occurrences count. Strings never cross documents.

Suffixes are put into buckets by their first bytes, and buckets are refined by
the identifiers of the buckets at later offsets:

- Initial buckets: each window of `length` bytes is filed under the leftmost least
  of its q-grams (`gram` bytes), which depends on the window alone. Neighbouring
  windows share that place, so a text is a list of runs of windows, about one to
  70 bytes, each in the bucket of its q-gram. Equal windows are in one bucket at one
  distance from its q-gram.
- The identifier of a longer string is made from those of its parts at later
  offsets: 64 bytes from the q-gram, 128 from two of 64, 200 from two of 128 that
  overlap, and so on; each is reused by the next.
- A run is one of a bucket alone: none of its windows is repeated, and it is done.
  All runs of a bucket have equal first and last windows, at equal distances: all
  windows are repeated, and they are done. Else the bucket is refined: runs are
  split into shorter blocks of distances, whose windows have a longer part in
  common, by which they are filed again. Of equal runs only one goes on. In the
  last round a block is one window.

Spark groups and joins the runs by bucket; a task never holds a bucket. Buckets
are counted by partial sums and met by joins that adaptive execution can split, so
a passage of a third of all documents is no group of one task. Identifiers have 64
bits and are compared within a bucket, so two different windows are taken for equal
only if the identifiers of a q-gram and of the whole both collide.

Cases: a null text is empty; a text shorter than `length` has nothing to remove; a
repeated row is a repeated text, whose bytes are all removed from `length` bytes on; an
empty table gives no rows; the caller's row comes back whole in the column `row`, so
no name can clash; a long text is one slice of a task, whose memory is some 60
times its bytes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandlab.llm.row_filters import once, possible
from demandlab.llm.words import mix, text_slices, utf8
from demandlab.session import materialize

LENGTH, GRAM = 200, 64
#: Distances in a block, round after round; the last must be 1.
BLOCKS = (16, 1)
KEY = ("text_key", "n_bytes")
_RUN = "bucket long, class long, at int, lo int, hi int"
_PIECE = f"text_key long, n_bytes long, {_RUN}"

_CODES = np.random.default_rng(11).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_STEP = np.uint64(0xD1342543DE82EF95)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out, out=out)


def gram_names(data: np.ndarray, gram: int) -> np.ndarray:
    """The identifier of the q-gram at every place: equal for equal bytes."""
    n = len(data)
    if n < gram:
        return np.empty(0, dtype=np.uint64)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_CODES[data] * _powers(_BASE, n), out=sums[1:])
    return mix((sums[gram:] - sums[:-gram]) * _powers(pow(_BASE, -1, 1 << 64), n - gram + 1))


def longer_names(names: np.ndarray, at: np.ndarray, length: int, gram: int) -> np.ndarray:
    """The identifiers of the strings of `length` bytes at some places, from those at later offsets."""
    if length == gram:
        return names[at]
    half = gram
    while half * 2 < length:
        half *= 2
    return mix(longer_names(names, at, half, gram) * _STEP + longer_names(names, at + (length - half), half, gram))


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` values in a row."""
    size = 1
    while size * 2 <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def _class(names: np.ndarray, at: np.ndarray, lo: np.ndarray, hi: np.ndarray, length: int, gram: int) -> np.ndarray:
    """Equal for runs with equal first and last windows at equal distances from their places."""
    ends = longer_names(names, lo, length, gram) * _STEP + longer_names(names, hi, length, gram)
    return mix(mix(ends) + ((at - lo).astype(np.uint64) << np.uint64(32)) + (hi - lo).astype(np.uint64))


def first_runs(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(row, bucket, class, at, lo, hi) of all texts: the windows from lo to hi are filed under the q-gram at `at`."""
    windows = np.maximum(np.diff(offsets) - length + 1, 0)
    total = int(windows.sum())
    if not total:
        return tuple(np.empty(0, dtype=np.int64) for _ in range(6))
    names = gram_names(data, gram)
    places = (names & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(names), dtype=np.uint64)
    owner = (_least(places, length - gram + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    start = np.arange(total) + np.repeat(offsets[:-1] - (np.cumsum(windows) - windows), windows)
    own = owner[start]
    first = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
    lo, hi, at = start[first], start[np.append(first[1:], total) - 1], own[first]
    row = np.searchsorted(offsets, lo, side="right") - 1
    return row, names[at], _class(names, at, lo, hi, length, gram), at, lo, hi


def split_runs(names: np.ndarray, bucket: np.ndarray, at: np.ndarray, lo: np.ndarray, hi: np.ndarray, block: int, length: int, gram: int):
    """(run, bucket, class, at, lo, hi) of the blocks of each run.

    The windows at distances k * block to k * block + block - 1 have
    length - block + 1 bytes in common, from the place `at` less the first distance.
    """
    low = (at - hi) // block
    n = (at - lo) // block - low + 1
    run = np.repeat(np.arange(len(at)), n)
    k = low[run] + np.arange(len(run)) - np.repeat(np.cumsum(n) - n, n)
    at, nearest = at[run], at[run] - k * block
    lo, hi = np.maximum(lo[run], nearest - block + 1), np.minimum(hi[run], nearest)
    shared = longer_names(names, nearest, length - block + 1, gram)
    return run, mix(shared + mix(bucket[run] * _STEP + k.astype(np.uint64))), _class(names, at, lo, hi, length, gram), at, lo, hi


def _pieces(batch: pa.RecordBatch, row: np.ndarray, offsets: np.ndarray, bucket, kind, at, lo, hi) -> pa.RecordBatch:
    row = pa.array(row)
    begin = offsets[row.to_numpy()]
    columns = [batch["text_key"].take(row), batch["n_bytes"].take(row), pa.array(bucket.view(np.int64)), pa.array(kind.view(np.int64))]
    columns += [pa.array((x - begin).astype(np.int32)) for x in (at, lo, hi)]
    return pa.RecordBatch.from_arrays(columns, ["text_key", "n_bytes", "bucket", "class", "at", "lo", "hi"])


def _first(length: int, gram: int) -> Callable:
    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(once(batches)):
            data, offsets = utf8(batch["text"])
            row, *run = first_runs(data, offsets, length, gram)
            if len(row):
                yield _pieces(batch, row, offsets, *run)

    return first


def _split(block: int, length: int, gram: int) -> Callable:
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(once(batches)):
            data, offsets = utf8(batch["text"])
            runs = batch["runs"]
            row, flat = runs.value_parent_indices().to_numpy(), runs.flatten()
            if not len(row):
                continue
            bucket = flat.field("bucket").to_numpy().view(np.uint64)
            at, lo, hi = (flat.field(name).to_numpy().astype(np.int64) + offsets[row] for name in ("at", "lo", "hi"))
            run, *parts = split_runs(gram_names(data, gram), bucket, at, lo, hi, block, length, gram)
            yield _pieces(batch, row[run], offsets, *parts)

    return split


def keyed(documents: DataFrame, text: str = "text") -> DataFrame:
    """(row, text, text_key, n_bytes): a text is named by a hash and its size."""
    row = F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row")
    plain = documents.select(row, F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    return plain.withColumns({"text_key": F.xxhash64("text"), "n_bytes": F.octet_length("text").cast("long")})


def repeated_runs(texts: DataFrame, length: int = LENGTH, gram: int = GRAM, blocks: Sequence[int] = BLOCKS) -> DataFrame:
    """(text_key, n_bytes, lo, hi): from lo to hi all strings of `length` bytes also start elsewhere. Runs may be listed twice.

    ``texts`` has text_key, n_bytes and text, as ``keyed`` gives them.
    """
    if blocks[-1] != 1 or not 0 < gram <= length:
        raise ValueError("the last block must be 1, and a q-gram no longer than the strings")
    texts = texts.filter(F.col("n_bytes") >= length).select(*KEY, "text")
    copied = texts.groupBy(*KEY).agg(F.count("*").alias("n")).filter("n > 1")
    found = copied.select(*KEY, F.lit(0).alias("lo"), (F.col("n_bytes") - length).cast("int").alias("hi"))
    pieces = materialize(texts.mapInArrow(_first(length, gram), _PIECE), "runs")
    for block in (*blocks, None):
        # Buckets of one run are done; what is known of the others is one row a bucket.
        counts = pieces.groupBy("bucket").agg(F.count("*").alias("n"), (F.min("class") != F.max("class")).alias("mixed"))
        buckets = materialize(counts.filter("n > 1").select("bucket", "mixed"), "buckets")
        held = materialize(possible(pieces, buckets, "bucket").join(buckets, "bucket"), "held")
        if block is None:  # runs of one window: those of a bucket are equal
            return found.unionByName(held.select(*KEY, "lo", "hi"))
        found = found.unionByName(held.filter("not mixed").select(*KEY, "lo", "hi"))
        mixed = held.filter("mixed")
        one = F.min(F.struct(*KEY, "at", "lo", "hi")).alias("one")
        classes = materialize(mixed.groupBy("bucket", "class").agg(F.count("*").alias("n"), one), "classes")
        equal = classes.filter("n > 1").select("bucket", "class")
        found = found.unionByName(mixed.join(equal, ["bucket", "class"]).select(*KEY, "lo", "hi"))
        run = F.struct("bucket", F.col("one.at").alias("at"), F.col("one.lo").alias("lo"), F.col("one.hi").alias("hi"))
        # The runs of one text: no more than it has bytes.
        runs = classes.groupBy(*[F.col(f"one.{name}").alias(name) for name in KEY]).agg(F.collect_list(run).alias("runs"))
        runs = materialize(runs, "open-runs")
        near = possible(texts, runs.select("text_key"), "text_key")
        pieces = materialize(near.join(runs, list(KEY)).mapInArrow(_split(block, length, gram), _PIECE), "runs")


def _spans(length: int) -> Callable:
    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs = batch["runs"]
            row, flat = runs.value_parent_indices().to_numpy().astype(np.int64), runs.flatten()
            low = flat.field("lo").to_numpy().astype(np.int64) + (row << 32)
            high = flat.field("hi").to_numpy().astype(np.int64) + (row << 32) + length
            order = np.argsort(low, kind="stable")
            low, high, row = low[order], np.maximum.accumulate(high[order]), row[order]
            new = np.append(True, low[1:] > high[:-1])[: len(low)]
            start, last = low[new], high[np.append(np.flatnonzero(new)[1:], len(low)) - 1] if len(low) else high
            counts = np.bincount(row[new], minlength=len(runs))
            ends = [pa.array((x & 0xFFFFFFFF).astype(np.int32)) for x in (start, last)]
            lists = pa.ListArray.from_arrays(np.append(0, np.cumsum(counts)).astype(np.int32), pa.StructArray.from_arrays(ends, ["start", "end"]))
            yield pa.RecordBatch.from_arrays([batch["text_key"], batch["n_bytes"], lists], [*KEY, "spans"])

    return spans


def _kept(text: Column, n_bytes: Column, spans: Column) -> Column:
    """The bytes outside the spans: each piece is cut once, and all are joined once (as text of one character a byte)."""
    none = F.array().cast("array<int>")
    starts = F.concat(F.array(F.lit(0)), F.coalesce(F.transform(spans, lambda s: s["end"]), none))
    ends = F.concat(F.coalesce(F.transform(spans, lambda s: s["start"]), none), F.array(n_bytes.cast("int")))
    pieces = F.zip_with(starts, ends, lambda a, b: F.decode(F.substring(text.cast("binary"), a + 1, b - a), "ISO-8859-1"))
    return F.encode(F.array_join(pieces, ""), "ISO-8859-1")


def without_repeats(documents: DataFrame, text: str = "text", length: int = LENGTH, gram: int = GRAM, blocks: Sequence[int] = BLOCKS) -> DataFrame:
    """(row, n_bytes, spans, kept): the caller's row, the bytes of its text, the removed spans in order, and the bytes left.

    Spans have start and end (exclusive) in bytes and do not touch each other.
    """
    texts = keyed(documents, text)
    runs = repeated_runs(texts, length, gram, blocks).groupBy(*KEY).agg(F.collect_list(F.struct("lo", "hi")).alias("runs"))
    spans = materialize(runs.mapInArrow(_spans(length), "text_key long, n_bytes long, spans array<struct<start: int, end: int>>"), "spans")
    found = texts.join(spans, list(KEY), "left")
    kept = F.when(F.col("spans").isNull(), F.col("text").cast("binary")).otherwise(_kept(F.col("text"), F.col("n_bytes"), F.col("spans")))
    none = F.array().cast("array<struct<start: int, end: int>>")
    return found.select("row", "n_bytes", F.coalesce("spans", none).alias("spans"), kept.alias("kept"))
