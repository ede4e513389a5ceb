"""Encoding texts unit by unit.

A tokenizer that never joins characters across certain places can encode the
units between them one by one, so a unit that occurs often is encoded once: by a
table made for all texts beforehand, or by the first text of a task that has it.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandlab.llm.words import span_hashes, text_slices, utf8

#: Places where units may begin, besides each text's first byte: from the bytes of several texts to true for each.
Cuts = Callable[[np.ndarray], np.ndarray]
#: From several units to the number of ids of each, and all ids in turn.
Encoder = Callable[[list[str]], tuple[np.ndarray, np.ndarray]]
#: Units that a task remembers besides a table; it then starts anew. About 20 bytes each.
REMEMBERED = 1 << 20


def _runs(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of all runs, one run after the other."""
    ends = np.cumsum(sizes)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)


class Units:
    """The units of a column of texts: where each starts and ends, and the row it is in."""

    def __init__(self, column: pa.Array, cuts: Cuts, prefix: bytes = b""):
        data, offsets = utf8(column)
        if prefix:  # every text that is not empty gets the prefix
            sizes = np.diff(offsets)
            moved = offsets + np.append(0, np.cumsum(sizes > 0)) * len(prefix)
            out = np.empty(int(moved[-1]), dtype=np.uint8)
            for k, byte in enumerate(prefix):
                out[moved[:-1][sizes > 0] + k] = byte
            out[np.arange(len(data)) + np.repeat(moved[:-1] - offsets[:-1] + len(prefix) * (sizes > 0), sizes)] = data
            data, offsets = out, moved
        self.data, self.rows = data, len(column)
        begins = cuts(data) if len(data) else np.zeros(0, dtype=bool)
        begins[offsets[:-1][np.diff(offsets) > 0]] = True
        self.starts = np.flatnonzero(begins)
        self.ends = np.append(self.starts[1:], len(data))[: len(self.starts)]
        #: The units of row i are those from first[i] up to first[i + 1].
        self.first = np.append(np.searchsorted(self.starts, offsets[: self.rows]), len(self.starts))

    @functools.cached_property
    def hashes(self) -> np.ndarray:
        return span_hashes(self.data, self.starts, self.ends)

    def distinct(self) -> tuple[pa.StringArray, np.ndarray, np.ndarray]:
        """Distinct units in the order of their hashes, these hashes, and the number of each unit."""
        ends = np.append(self.starts, len(self.data)).astype(np.int32)  # units stand side by side
        coded = pa.StringArray.from_buffers(len(self.starts), pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(self.data))).dictionary_encode()
        data, edges = utf8(coded.dictionary)
        hashes = span_hashes(data, edges[:-1], edges[1:])
        order, rank = np.argsort(hashes), np.empty(len(hashes), np.int32)
        rank[order] = np.arange(len(hashes), dtype=np.int32)
        return coded.dictionary.take(pa.array(order)), hashes[order], rank[coded.indices.to_numpy()]


class Table:
    """Hashes of units in order, and the ids of each in one flat array."""

    def __init__(self, hashes: np.ndarray, lengths: np.ndarray, ids: np.ndarray):
        order = np.argsort(hashes)
        begin = np.cumsum(lengths) - lengths
        self.hashes, sizes = hashes[order], lengths[order]
        self.first = np.append(0, np.cumsum(sizes))
        self.ids = ids[np.arange(len(ids)) + np.repeat(begin[order] - self.first[:-1], sizes)]
        if len(ids) < 1 << 31:
            self.first = self.first.astype(np.int32)
        if not len(ids) or ids.max() < 1 << 16:
            self.ids = self.ids.astype(np.uint16)

    def __len__(self) -> int:
        return len(self.hashes)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The place of each hash, or -1."""
        if not len(self):
            return np.full(len(hashes), -1)
        place = np.minimum(np.searchsorted(self.hashes, hashes), len(self) - 1)
        return np.where(self.hashes[place] == hashes, place, -1)

    def sizes(self, place: np.ndarray) -> np.ndarray:
        return (self.first[place + 1] - self.first[place]).astype(np.int64)

    def gather(self, place: np.ndarray) -> np.ndarray:
        """The ids of the units at the places, one after the other."""
        return self.ids[_runs(self.first[place].astype(np.int64), self.sizes(place))].astype(np.int32)


def flattened(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(x) for x in ids], dtype=np.int64)
    return lengths, np.fromiter((i for x in ids for i in x), dtype=np.int32, count=int(lengths.sum()))


def no_table() -> Table:
    return Table(np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int32))


class TaskEncoder:
    """Encodes the texts of a task; a unit that is in no table is encoded when it first comes and remembered."""

    def __init__(self, encode: Encoder, table: Table | None = None):
        self.encode, self.tables = encode, [table] if table is not None else []
        self.own = no_table()

    def __call__(self, units: Units) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all units in turn, and where each row's begin."""
        texts, values, back = units.distinct()
        found = [table.find(values) for table in self.tables]
        fixed = np.zeros(len(values), dtype=bool)
        for place in found:
            fixed |= place >= 0
        own = self.own.find(values)
        new = ~fixed & (own < 0)
        if len(self.own) + int(new.sum()) > REMEMBERED:
            self.own, new = no_table(), ~fixed
        if new.any():
            old, fresh = self.own, Table(values[new], *self.encode(texts.filter(pa.array(new)).to_pylist()))
            sizes = np.concatenate([t.sizes(np.arange(len(t))) for t in (old, fresh)])
            self.own = Table(np.concatenate([old.hashes, fresh.hashes]), sizes, np.concatenate([t.ids.astype(np.int32) for t in (old, fresh)]))
            own = self.own.find(values)
        rank, left, sizes, parts, total = np.empty(len(values), dtype=np.int32), np.ones(len(values), dtype=bool), [], [], 0
        for table, place in zip([self.own, *self.tables], [own, *found]):
            at = np.flatnonzero((place >= 0) & left)
            rank[at], left[at] = np.arange(total, total + len(at)), False
            sizes.append(table.sizes(place[at]))
            parts.append(table.gather(place[at]))
            total += len(at)
        edges = np.append(0, np.cumsum(np.concatenate(sizes))).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(edges), pa.array(np.concatenate(parts))).take(pa.array(rank[back]))
        return lists.values.to_numpy(), lists.offsets.to_numpy()[units.first]


def encoded_batches(batches: Iterator[pa.RecordBatch], encoder: TaskEncoder, cuts: Cuts, prefix: bytes = b"") -> Iterator[pa.RecordBatch]:
    """The batches with the column ids, some megabytes of text at a time."""
    for batch in text_slices(batches):
        ids, first = encoder(Units(batch["text"], cuts, prefix))
        lists = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(ids, pa.int32()))
        yield pa.RecordBatch.from_arrays([*batch.columns, lists], [*batch.schema.names, "ids"])


def distinct_units(texts: DataFrame, cuts: Cuts, prefix: bytes = b"") -> DataFrame:
    """(hash, unit, tasks): each distinct unit and the number of tasks that met it.

    Two units of one hash, which are not expected, are both left out.
    """

    def units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.empty(0, dtype=np.uint64)
        for batch in text_slices(batches):
            own = Units(batch["text"], cuts, prefix)
            text, hashes, _ = own.distinct()
            new = ~np.isin(hashes, seen)
            seen = np.union1d(seen, hashes[new])
            yield pa.RecordBatch.from_arrays([pa.array(hashes[new].view(np.int64)), text.filter(pa.array(new))], ["hash", "unit"])

    found = texts.select("text").mapInArrow(units, "hash long, unit string").groupBy("hash")
    found = found.agg(F.min("unit").alias("unit"), F.max("unit").alias("other"), F.count("*").alias("tasks"))
    return found.filter(F.col("unit") == F.col("other")).drop("other")


def common_units(units: DataFrame, most: int) -> DataFrame:
    """The units that most tasks met: as many kinds of counts, from the highest, as `most` units allow."""
    total, least = 0, 1
    for row in sorted(units.groupBy("tasks").agg(F.count("*").alias("n")).collect(), reverse=True):
        if total + row["n"] > most:
            least = row["tasks"] + 1
            break
        total += row["n"]
    return units.filter(F.col("tasks") >= least)


def collected(encoded: DataFrame) -> Table:
    """A table from rows (hash, ids); for at most as many as common_units leaves."""
    arrow = encoded.select("hash", "ids").toArrow()
    lists = pa.concat_arrays(arrow["ids"].chunks) if arrow.num_rows else pa.array([], pa.list_(pa.int32()))
    lengths = np.diff(lists.offsets.to_numpy()).astype(np.int64) if len(lists) else np.empty(0, np.int64)
    return Table(arrow["hash"].to_numpy().view(np.uint64), lengths, lists.flatten().to_numpy().astype(np.int32))
