"""Alignment of the tokens of two tokenizers over the bytes of each text.

Tokenizer A is a byte-level one of the tokenizers library and encodes a space and
the text; tokenizer B is of the sentencepiece library, which adds the space itself.
Special tokens are not added, and their strings in a text are plain text. Where an
A and a B token end at the same byte, a group ends. An A and a B token are linked
if their bytes overlap; a pair of ids counts the documents of the whole corpus
that have it linked.

A task works on Arrow arrays of some megabytes of text at a time:

- the ids of all texts are one flattened list with the index of each id's document;
- a cumulative sum of token sizes, less its value where the document starts, gives
  the byte at which each token ends; document and end make one key;
- an outer Acero hash join of the A and B keys, sorted by key, has one row for each
  place where a token ends: a group ends where both sides have a row, and each row is
  one link, of the tokens that end there or next;
- `Table.group_by` counts each document's pairs, and the documents of each pair in
  the task so far.

Spark adds up the tasks' counts. The documents' own pairs are kept in a written
table and meet the counts in a second pass: as two sorted arrays sent to the tasks
while the corpus has at most `most_pairs` kinds of pairs (twelve bytes each), else by
a join on the pair, which adaptive execution can split.

Encoding goes by units, as the tokenizers never join bytes across their borders;
each task encodes a unit when it first comes.

Cases: a null or empty text, and one whose A or B tokens are not the bytes of space
and text (as where it holds U+2581), has no tokens: zeros and no groups. Repeated
rows are documents of their own. An empty table gives no rows. The columns named in
`keep` come back in the struct `row`, so no name can clash. A long text is one
slice of a task and takes some 200 times its bytes there.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandlab.llm.repair_files import word_cuts
from demandlab.llm.unit_table import Encoder, TaskEncoder, Units, flattened
from demandlab.llm.words import text_slices
from demandlab.session import materialize

#: Kinds of pairs that are sent to every task; beyond them the counts are joined.
MOST_PAIRS = 1 << 23
#: Kinds of pairs that a task counts before it hands them on.
HELD_PAIRS = 1 << 20
SPACE = "▁"


@dataclass(frozen=True)
class Side:
    """A tokenizer: how it encodes units, where units begin, and the bytes of each id."""

    encode: Encoder
    cuts: Callable[[np.ndarray], np.ndarray]
    token_bytes: pa.Array

    @property
    def size(self) -> int:
        return len(self.token_bytes)


def _byte_of_letter() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes: printable ones as they are, others from 256 on, in order."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


def byte_level_side(path: str) -> Side:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    letters, entries = _byte_of_letter(), [b""] * tokenizer.get_vocab_size()
    for entry, number in tokenizer.get_vocab().items():
        entries[number] = bytes(letters.get(c, 0) for c in entry)

    def encode(units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return flattened([e.ids for e in tokenizer.encode_batch_fast(units, add_special_tokens=False)])

    return Side(encode, word_cuts(), pa.array(entries, pa.binary()))


def _space_cuts(data: np.ndarray) -> np.ndarray:
    """A space after anything else: no piece has a space behind another sign."""
    begins = data == 32
    begins[1:] &= data[:-1] != 32
    return begins


def piece_side(path: str) -> Side:
    from sentencepiece import SentencePieceProcessor

    pieces = SentencePieceProcessor(model_file=path)
    names = [pieces.id_to_piece(k) for k in range(pieces.get_piece_size())]
    if any(SPACE in name.lstrip(SPACE) for name in names):
        raise ValueError(f"{path} has pieces with a space behind another sign")
    entries = [bytes([int(name[3:5], 16)]) if pieces.is_byte(k) else name.replace(SPACE, " ").encode() for k, name in enumerate(names)]
    space = pieces.piece_to_id(SPACE)

    def encode(units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        # The library puts a space in front, which every unit already has.
        found = pieces.encode([unit[1:] for unit in units], num_threads=1)
        return flattened([ids if len(unit) > 1 else [space] for unit, ids in zip(units, found)])

    return Side(encode, _space_cuts, pa.array(entries, pa.binary()))


def _same_bytes(side: Side, ids: np.ndarray, first: np.ndarray, units: Units, offsets: np.ndarray) -> np.ndarray:
    """For each row, whether its tokens make up its bytes."""
    joined = side.token_bytes.take(pa.array(ids))
    ends = np.frombuffer(joined.buffers()[1], np.int32)[: len(ids) + 1].astype(np.int64) if len(ids) else np.zeros(1, np.int64)
    data = np.frombuffer(joined.buffers()[2], np.uint8)[: ends[-1]] if len(ids) and ends[-1] else np.empty(0, np.uint8)
    own = ends[first]
    if np.array_equal(own, offsets) and np.array_equal(data, units.data):
        return np.ones(units.rows, dtype=bool)
    pairs = zip(own[:-1], own[1:], offsets[:-1], offsets[1:])
    return np.array([np.array_equal(data[a:b], units.data[c:d]) for a, b, c, d in pairs], dtype=bool)


def _tokens(side: Side, encoder: TaskEncoder, column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The ids of each row as a list, and whether they are the row's bytes."""
    units = Units(column, side.cuts, prefix=b" ")
    ids, first = encoder(units)
    starts = np.append(units.starts, len(units.data))
    right = _same_bytes(side, ids, first, units, starts[units.first])
    return pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(ids.astype(np.int32))), right


def _ends(side: Side, lists: pa.Array) -> tuple[pa.Array, pa.Table]:
    """All ids, and a table of the document-end key of each with its index."""
    flat, document = pc.list_flatten(lists), pc.list_parent_indices(lists)
    sizes = pc.take(pc.cast(pc.binary_length(side.token_bytes), pa.int64()), flat)
    sums = pc.cumulative_sum(sizes)
    before = np.append(0, sums.to_numpy())[lists.offsets.to_numpy()[:-1]]  # the sum where each document starts
    end = pc.subtract(sums, pc.take(pa.array(before), document))
    key = pc.add(pc.shift_left(pc.cast(document, pa.int64()), pa.scalar(32, pa.int64())), end)
    return flat, pa.table({"key": key, "index": pa.array(np.arange(len(flat)))})


def _joined(lists: pa.Array, separator: str) -> pa.Array:
    return pc.binary_join(lists, separator)


def _array(column: pa.ChunkedArray) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


class Aligner:
    """Aligns the texts of a task, batch by batch, and counts the documents of each pair."""

    def __init__(self, a: Side, b: Side, digest: bool):
        self.a, self.b, self.digest = a, b, digest
        self.of_a, self.of_b = TaskEncoder(a.encode), TaskEncoder(b.encode)
        self.names = pa.array([str(k) for k in range(max(a.size, b.size))])

    def groups(self, flat: pa.Array, index: pa.Array) -> pa.Array:
        """The ids of each group, comma-joined; `index` is the last token of each."""
        ends = pa.array(np.append(0, index.to_numpy() + 1).astype(np.int32))
        return _joined(pa.ListArray.from_arrays(ends, pc.take(self.names, flat)), ",")

    def __call__(self, column: pa.Array) -> tuple[dict[str, pa.Array], pa.Table]:
        """The result's columns, and a table (pair, n) of documents by pair."""
        (lists_a, right_a), (lists_b, right_b) = _tokens(self.a, self.of_a, column), _tokens(self.b, self.of_b, column)
        right = right_a & right_b
        if not right.all():  # rows without tokens
            right = pa.array(right)
            none = pa.scalar([], pa.list_(pa.int32()))
            lists_a, lists_b = (pc.if_else(right, lists, none) for lists in (lists_a, lists_b))
        flat_a, ends_a = _ends(self.a, lists_a)
        flat_b, ends_b = _ends(self.b, lists_b)
        places = ends_a.join(ends_b, "key", join_type="full outer", right_suffix="_b", use_threads=False).sort_by("key")
        key, index_a, index_b = (_array(places[name]) for name in ("key", "index", "index_b"))
        document = pc.shift_right(key, pa.scalar(32, pa.int64()))
        cut = pc.and_(pc.is_valid(index_a), pc.is_valid(index_b))
        rows = len(column)

        # Groups end where both do; a document's last tokens always end together.
        group = pc.binary_join_element_wise(self.groups(flat_a, index_a.filter(cut)), self.groups(flat_b, index_b.filter(cut)), "|")
        n_groups = np.bincount(document.filter(cut).to_numpy(), minlength=rows)
        text = _joined(pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(n_groups)).astype(np.int32)), group), ";")
        if self.digest:
            text = pa.array([hashlib.sha256(x.encode()).hexdigest() if x else "" for x in text.to_pylist()])

        # The token that ends here or next; none reaches into the next document.
        linked_a, linked_b = pc.take(flat_a, pc.fill_null_backward(index_a)), pc.take(flat_b, pc.fill_null_backward(index_b))
        pair = pc.add(pc.multiply(pc.cast(linked_a, pa.int64()), self.b.size), pc.cast(linked_b, pa.int64()))
        links = pa.table({"document": document, "pair": pair})
        own = links.group_by(["document", "pair"], use_threads=False).aggregate([([], "count_all")])
        own = own.sort_by([("document", "ascending"), ("pair", "ascending")])
        kinds = np.append(0, np.cumsum(np.bincount(own["document"].to_numpy(), minlength=rows))).astype(np.int32)
        pairs = pa.ListArray.from_arrays(kinds, _array(own["pair"]))
        times = pa.ListArray.from_arrays(kinds, _array(own["count_all"]))
        count = lambda values: pa.array(values.astype(np.int64))
        columns = {
            "n_a": count(np.diff(lists_a.offsets.to_numpy())),
            "n_b": count(np.diff(lists_b.offsets.to_numpy())),
            "n_groups": count(n_groups),
            "n_links": count(np.bincount(document.to_numpy(), minlength=rows)),
            "groups": text,
            "pairs": pairs,
            "times": times,
        }
        counts = own.select(["pair"]).group_by("pair", use_threads=False).aggregate([([], "count_all")]).rename_columns(["pair", "n"])
        return columns, counts


def _merged(tables: Sequence[pa.Table]) -> pa.Table:
    if len(tables) == 1:
        return tables[0]
    return pa.concat_tables(tables).group_by("pair", use_threads=False).aggregate([("n", "sum")]).rename_columns(["pair", "n"])


_COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times")


def _aligned_batches(sides: Callable[[], tuple[Side, Side]], digest: bool) -> Callable:
    """Rows of documents (`counted` false), and rows that only have pairs and the task's counts of them in `times`."""

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, counts, kind = None, [], None

        def handed_on(table: pa.Table) -> Iterator[pa.RecordBatch]:
            for low in range(0, table.num_rows, 1 << 16):
                part = table.slice(low, 1 << 16)
                lists = [pa.ListArray.from_arrays(pa.array([0, len(part)], pa.int32()), _array(part[name])) for name in ("pair", "n")]
                numbers = [pa.nulls(1, pa.int64()) for _ in range(4)]
                yield pa.RecordBatch.from_arrays([pa.nulls(1, kind), pa.array([True]), *numbers, pa.nulls(1, pa.string()), *lists], ["row", "counted", *_COLUMNS])

        for batch in text_slices(batches):
            aligner, kind = aligner or Aligner(*sides(), digest), batch["row"].type
            columns, table = aligner(batch["text"])
            yield pa.RecordBatch.from_arrays([batch["row"], pa.array(np.zeros(len(batch), bool)), *[columns[name] for name in _COLUMNS]], ["row", "counted", *_COLUMNS])
            counts.append(table)
            if sum(len(x) for x in counts) > HELD_PAIRS:
                counts = [_merged(counts)]
                if len(counts[0]) > HELD_PAIRS // 2:
                    yield from handed_on(counts.pop())
        if counts:
            yield from handed_on(_merged(counts))

    return aligned


def _scored_batches(held) -> Callable:
    """Adds n_best and count_sum from the sent counts."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n, best = held.value
        for batch in batches:
            lists = batch["pairs"]
            place = np.searchsorted(known, lists.flatten().to_numpy())
            times = batch["times"].flatten().to_numpy()
            row = pc.list_parent_indices(lists).to_numpy()
            first = np.append(0, np.cumsum(np.bincount(row, minlength=len(batch))))
            sums = [np.append(0, np.cumsum(values))[first] for values in (times * best[place], times * n[place])] if len(place) else [np.zeros(len(batch) + 1, np.int64)] * 2
            added = [pa.array(np.diff(x)) for x in sums]
            yield pa.RecordBatch.from_arrays([*[batch[name] for name in ("row", *_COLUMNS[:5])], *added], ["row", *_COLUMNS[:5], "n_best", "count_sum"])

    return scored


def aligned(documents: DataFrame, a_file: str, b_file: str, keep: Sequence[str] = ("doc_id",), text: str = "text", digest: bool = False, most_pairs: int = MOST_PAIRS) -> DataFrame:
    """(row, n_a, n_b, n_groups, n_links, groups, n_best, count_sum) for each document.

    ``groups`` is `a1,a2|b1;a3|b2,b3` with the ids of each group in order, or with
    ``digest`` the SHA-256 of that ('' without tokens). n_best counts the links whose
    pair is in as many documents as any pair of their A id; count_sum sums the counts
    over the links. The files are paths that all machines can read.
    """
    row = F.struct(*[F.col(f"`{name}`") for name in keep]).alias("row")
    plain = documents.select(row, F.col(f"`{text}`").alias("text"))
    kind = plain.schema["row"].dataType.simpleString()
    numbers = "n_a long, n_b long, n_groups long, n_links long"
    schema = f"row {kind}, counted boolean, {numbers}, groups string, pairs array<long>, times array<long>"
    sides = lambda: (byte_level_side(a_file), piece_side(b_file))
    size_b = piece_side(b_file).size
    # Pairs fit into 31 bits for such vocabularies; the table is half as large for it.
    width = "int" if byte_level_side(a_file).size * size_b < 1 << 31 else "long"
    written = plain.mapInArrow(_aligned_batches(sides, digest), schema)
    narrow = [F.col(name).cast(f"array<{kind}>").alias(name) for name, kind in (("pairs", width), ("times", "int"))]
    written = materialize(written.select("row", "counted", *_COLUMNS[:5], *narrow), "alignments")
    # Sums of counts stay small; a task's own counts fit into an int.
    tasks = written.filter("counted").select(F.explode(F.arrays_zip("pairs", "times")).alias("x")).select(F.col("x.pairs").alias("pair"), F.col("x.times").cast("long").alias("n"))
    counts = materialize(tasks.groupBy("pair").agg(F.sum("n").alias("n")), "pair-counts")
    of_a = F.floor(F.col("pair") / size_b)
    most = counts.groupBy(of_a.alias("a")).agg(F.max("n").alias("most"))
    judged = materialize(counts.withColumn("a", of_a).join(most, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "judged-pairs")
    found = written.filter("not counted").drop("counted")
    if judged.count() <= most_pairs:
        table = judged.toArrow().sort_by("pair")
        sent = tuple(_array(table[name]).to_numpy(zero_copy_only=False) for name in ("pair", "n", "best"))
        held = documents.sparkSession.sparkContext.broadcast(sent)
        return found.mapInArrow(_scored_batches(held), f"row {kind}, {numbers}, groups string, n_best long, count_sum long")
    # The table is written, so its rows keep these numbers.
    found = found.withColumn("_number", F.monotonically_increasing_id())
    links = found.select("_number", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("_number", F.col("x.pairs").alias("pair"), F.col("x.times").cast("long").alias("times"))
    scores = links.join(judged, "pair").groupBy("_number").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    none = [F.coalesce(name, F.lit(0)).alias(name) for name in ("n_best", "count_sum")]
    return found.drop("pairs", "times").join(scores, "_number", "left").select("row", *_COLUMNS[:5], *none)
