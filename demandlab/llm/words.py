"""Words of texts and their hashes, for whole Arrow batches at a time.

A word is a run of `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]` after A-Z is lower-cased:
ASCII letters and digits and everything beyond ASCII. Every byte of a character
beyond ASCII is at least 0x80, so the rule can be applied to UTF-8 bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: The same words as a Spark or DuckDB regular expression: what lies between them.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

SLICE_BYTES = 2 << 20
#: About so many bytes are hashed at a time, so the running sums stay in a processor's cache.
HASHED_BYTES = 1 << 17
_LOWERED = np.arange(256, dtype=np.uint8)
_LOWERED[65:91] += 32
_IN_WORD = np.zeros(256, dtype=bool)
_IN_WORD[48:58] = _IN_WORD[97:123] = _IN_WORD[128:] = True
_CODES = np.random.default_rng(20).integers(0, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose output bits all depend on all input bits."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(31)
    return values


def _powers(base: np.uint64, count: int) -> np.ndarray:
    powers = np.full(count, base, dtype=np.uint64)
    powers[0] = 1
    return np.multiply.accumulate(powers, out=powers)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each non-empty span of bytes."""
    out, lengths = np.empty(len(starts), dtype=np.uint64), ends - starts
    if not len(out):
        return out
    edges = np.searchsorted(np.cumsum(lengths), np.arange(0, int(lengths.sum()), HASHED_BYTES), side="right")
    edges = np.unique(np.append(edges, len(out)))
    pieces = [(low, high) for low, high in zip(np.append(0, edges)[:-1], edges) if low < high]
    powers = _powers(_BASE, max(int(lengths[low:high].sum()) for low, high in pieces))
    inverse = None
    for low, high in pieces:
        begin, end = starts[low:high], ends[low:high]
        if high - low > 1 and (end[:-1] == begin[1:]).all():
            # Spans side by side: differences of one running sum, divided by the power each starts with.
            if inverse is None:
                inverse = _powers(np.uint64(pow(int(_BASE), -1, 1 << 64)), len(powers))
            run = np.zeros(int(end[-1] - begin[0]) + 1, dtype=np.uint64)
            np.cumsum(_CODES[data[begin[0] : end[-1]]] * powers[: len(run) - 1], out=run[1:])
            edge = run[np.append(begin, end[-1]) - begin[0]]
            out[low:high] = np.diff(edge) * inverse[begin - begin[0]]
            continue
        size = lengths[low:high]
        begin = np.cumsum(size) - size
        within = np.arange(int(size.sum())) - np.repeat(begin, size)
        where = within + np.repeat(starts[low:high], size)
        out[low:high] = np.add.reduceat(_CODES[data[where]] * powers[within], begin)
    return mix(out + lengths.astype(np.uint64))


def text_slices(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """The same rows in batches of a few megabytes of text; one long text makes a batch of its own."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False)
        start, size = 0, 0
        for row, length in enumerate(sizes):
            if row > start and size + length > SLICE_BYTES:
                yield batch.slice(start, row - start)
                start, size = row, 0
            size += length
        if start < batch.num_rows:
            yield batch.slice(start)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts of a column, null as empty, and where each begins (and the last ends)."""
    column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.empty(0, np.uint8)
    return data, (offsets - offsets[0]).astype(np.int64)


class Words:
    """The words of a column of texts: where each starts and ends, and the row it is in."""

    def __init__(self, column: pa.Array):
        data, self.offsets = utf8(column)
        self.data, self.rows = _LOWERED[data], len(column)
        inside = np.zeros(len(data) + 2, dtype=bool)
        inside[1:-1] = _IN_WORD[self.data]
        cut = np.zeros(len(data) + 1, dtype=bool)
        cut[self.offsets] = True
        self.starts = np.flatnonzero(inside[1:] & (cut | ~inside[:-1]))
        self.ends = np.flatnonzero(inside[:-1] & (cut | ~inside[1:]))
        self.row = np.searchsorted(self.offsets, self.starts, side="right") - 1
        #: The words of row i are those from first[i] up to first[i + 1].
        self.first = np.searchsorted(self.row, np.arange(self.rows + 1))

    def __len__(self) -> int:
        return len(self.starts)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word."""
        return span_hashes(self.data, self.starts, self.ends)

    def text(self, word: int) -> str:
        return self.data[self.starts[word] : self.ends[word]].tobytes().decode()

    def texts(self, low: int, high: int) -> list[str]:
        return [self.text(word) for word in range(low, high)]


def shingle_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of `size` words; runs that cross rows are for the caller to leave out."""
    n = max(0, len(hashes) - size + 1)
    out = np.zeros(n, dtype=np.uint64)
    for k in range(size):
        out = out * _BASE + hashes[k : k + n]
    return mix(out + np.uint64(size))


def shingles(words: Words, size: int, short: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every shingle of `size` words, row by row.

    A row with fewer words, but not none, has one shingle of all its words if `short`.
    """
    hashes = words.hashes()
    runs = shingle_hashes(hashes, size)
    row = words.row[: len(runs)]
    whole = row == words.row[size - 1 :] if len(runs) else np.empty(0, dtype=bool)
    values, rows = [runs[whole]], [row[whole]]
    if short:
        for k in range(1, size):
            few = np.flatnonzero(words.counts == k)
            if len(few):
                values.append(shingle_hashes(hashes, k)[words.first[few]])
                rows.append(few)
    values, rows = np.concatenate(values), np.concatenate(rows)
    order = np.argsort(rows, kind="stable")
    return values[order], rows[order]
