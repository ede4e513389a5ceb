"""SentencePiece encoding and decoding as a relational lattice.

Texts are cut into units that no piece of the table crosses (checked against the
table). The distinct units are gathered over all texts, and those that most tasks
met, at most `MOST_UNITS`, are encoded once: their substrings of bounded length
are exploded and joined to the piece table, the matches are the edges of a unit's
lattice, and an ordered fold over them keeps the best path to every place. The
result is sent to all tasks; a unit beyond it takes the same fold in the task that
meets it, so the ids do not depend on the bound. A character that is no piece costs ten more than the worst piece and becomes its
UTF-8 bytes. Ties go to the path whose last piece is longer.

The best path is the one with the highest sum of the pieces' scores, as in a
unigram model; a model trained for merges may cut some words otherwise. Spaces
become the sign U+2581, one is put in front, and nothing else is normalised; a
model that normalises more is refused.

Cases: a null or empty text has no ids, and no ids decode to an empty text;
repeated rows and rows without an id are encoded like others; other columns pass
through. Units longer than `LONGEST` characters are folded in one pass over the
characters instead, because a fold that copies its state would take the square.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from demandlab.llm.unit_table import TaskEncoder, collected, common_units, distinct_units, encoded_batches, flattened
from demandlab.session import materialize

Batches = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]
SPACE, LONGEST, PENALTY = "▁", 256, 10.0
#: Rows decoded at a time.
ROWS = 512
#: Units sent to every task, about 20 bytes each.
MOST_UNITS = 1 << 20
#: The piece table is broadcast; a larger one is joined by shuffling.
MOST_PIECES = 1 << 20
_LETTER, _SIGN = np.zeros(256, dtype=bool), np.ones(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = True
_SIGN[48:58] = _SIGN[65:91] = _SIGN[97:123] = _SIGN[128:] = _SIGN[32] = _SIGN[95] = False


def space_cuts(data: np.ndarray) -> np.ndarray:
    """Before a space, unless another space or U+2581 stands before it."""
    space = data == 32
    begins = space.copy()
    begins[1:] &= ~space[:-1]
    begins[3:] &= ~((data[:-3] == 0xE2) & (data[1:-2] == 0x96) & (data[2:-1] == 0x81))
    return begins


def sign_cuts(data: np.ndarray) -> np.ndarray:
    """Also between an ASCII letter and an ASCII sign."""
    begins = space_cuts(data)
    letter, sign = _LETTER[data], _SIGN[data]
    begins[1:] |= (letter[:-1] & sign[1:]) | (sign[:-1] & letter[1:])
    return begins


@dataclass(frozen=True)
class Pieces:
    """The pieces that text can be cut into, the ids of the 256 bytes, and all pieces by id."""

    scores: dict[str, tuple[int, float]]
    bytes: list[int]
    by_id: list[str]
    cuts: Callable[[np.ndarray], np.ndarray]
    longest: int
    unknown: float


def read_pieces(model_file: str) -> Pieces:
    """The piece table of a model file that the driver can read."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    probe = " ﬁ  Ａ "
    if model.decode(model.encode(probe)) != probe:
        raise ValueError("only models that keep the text as it is are supported")
    ids = range(model.vocab_size())
    by_id = [model.id_to_piece(i) for i in ids]
    hexes = {f"<0x{b:02X}>": b for b in range(256)}
    of_byte = {hexes[by_id[i]]: i for i in ids if model.is_byte(i)}
    if len(of_byte) < 256:
        raise ValueError("only models with pieces for all bytes are supported")
    scores = {by_id[i]: (i, model.get_score(i)) for i in ids if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))}
    for cuts in (sign_cuts, space_cuts):
        if not any(cuts(np.frombuffer(p.replace(SPACE, " ").encode(), np.uint8))[1:].any() for p in scores):
            return Pieces(scores, [of_byte[b] for b in range(256)], by_id, cuts, max(map(len, scores)), min(s for _, s in scores.values()) - PENALTY)
    raise ValueError("pieces cross the spaces between words")


def folder(pieces: Pieces) -> Callable[[str], list[int]]:
    """The same fold for one unit at a time, from each place on while some piece begins like what follows."""
    starts: dict[str, tuple[int, float] | None] = {piece[:n]: None for piece in pieces.scores for n in range(1, len(piece))}
    starts.update(pieces.scores)
    missing = object()

    def fold(unit: str) -> list[int]:
        unit = unit.replace(" ", SPACE)
        size = len(unit)
        score, back, piece = [0.0] + [-np.inf] * size, [0] * (size + 1), [0] * (size + 1)
        for start in range(size):
            before = score[start]
            for end in range(start + 1, size + 1):
                found = starts.get(unit[start:end], missing)
                if found is missing or found is None:
                    if end == start + 1 and before + pieces.unknown > score[end]:
                        score[end], back[end], piece[end] = before + pieces.unknown, start, -1 - ord(unit[start])
                    if found is missing:
                        break
                elif before + found[1] > score[end]:
                    score[end], back[end], piece[end] = before + found[1], start, found[0]
        out, at = [], size
        while at:
            out.append(piece[at])
            at = back[at]
        out.reverse()
        if min(out, default=0) < 0:
            return [i for p in out for i in ([p] if p >= 0 else [pieces.bytes[b] for b in chr(-1 - p).encode()])]
        return out

    return fold


def best_path(unit: str, pieces: Pieces) -> list[int]:
    """The ids of the best path over one unit, or over a whole text."""
    return folder(pieces)(unit)


def _edges(units: DataFrame, pieces: Pieces) -> DataFrame:
    """The lattice of each unit: (hash, end, start, id, score), and its text and count on one row."""
    spark = units.sparkSession
    table = spark.createDataFrame(pd.DataFrame([(p, i, s) for p, (i, s) in pieces.scores.items()], columns=["piece", "id", "score"]), "piece string, id int, score double")
    if len(pieces.scores) <= MOST_PIECES:
        table = F.broadcast(table)
    word = F.translate("unit", " ", SPACE)
    size = F.char_length("unit")
    spans = F.flatten(
        F.transform(
            F.sequence(F.lit(0), size - 1),
            lambda s: F.transform(F.sequence(F.lit(1), F.least(F.lit(pieces.longest), size - s)), lambda n: F.struct(s.alias("start"), (s + n).alias("end"), F.substring(word, s + 1, n).alias("piece"))),
        )
    )
    spans = units.select("hash", "unit", "tasks", F.explode(spans).alias("x")).select("hash", F.when(F.col("x.end") == 1, F.col("unit")).alias("unit"), F.when(F.col("x.end") == 1, F.col("tasks")).alias("tasks"), "x.*")
    edges = spans.join(table, "piece", "left").filter(F.col("id").isNotNull() | (F.col("end") - F.col("start") == 1))
    return edges.select("hash", "unit", "tasks", "end", "start", F.coalesce("id", -1 - F.ascii("piece")).alias("id"), F.coalesce("score", F.lit(pieces.unknown)).alias("score"))


def _utf8(code: Column, bytes_: Column) -> Column:
    """The ids of the bytes of a character."""
    tail = lambda shift: 128 + F.shiftright(code, shift).bitwiseAND(63)
    head = lambda shift, mark: mark + F.shiftright(code, shift)
    places = F.when(code < 0x80, F.array(code)).when(code < 0x800, F.array(head(6, 0xC0), tail(0)))
    places = places.when(code < 0x10000, F.array(head(12, 0xE0), tail(6), tail(0))).otherwise(F.array(head(18, 0xF0), tail(12), tail(6), tail(0)))
    return F.transform(places, lambda b: F.get(bytes_, b))


def encode_units(units: DataFrame, pieces: Pieces, longest: int = LONGEST) -> DataFrame:
    """Rows (hash, unit, tasks) with the ids of the unit."""
    short = units.filter(F.char_length("unit") <= longest)
    edges = F.sort_array(F.collect_list(F.struct("end", "start", "id", "score")))
    lattice = _edges(short, pieces).groupBy("hash").agg(F.max("unit").alias("unit"), F.max("tasks").alias("tasks"), edges.alias("edges"))

    def step(best: Column, edge: Column) -> Column:
        before = best[edge["start"]]
        path = F.array(F.struct((before["score"] + edge["score"]).alias("score"), F.concat(before["ids"], F.array(edge["id"])).alias("ids")))
        better = before["score"] + edge["score"] > F.element_at(best, -1)["score"]
        return F.when(F.size(best) == edge["end"], F.concat(best, path)).when(better, F.concat(F.slice(best, 1, edge["end"]), path)).otherwise(best)

    nothing = F.array(F.struct(F.lit(0.0).alias("score"), F.array().cast("array<int>").alias("ids")))
    path = F.aggregate("edges", nothing, step, lambda best: F.element_at(best, -1)["ids"])
    bytes_ = F.array(*[F.lit(i) for i in pieces.bytes])
    whole = F.when(F.exists("path", lambda i: i < 0), F.flatten(F.transform("path", lambda i: F.when(i < 0, _utf8(-1 - i, bytes_)).otherwise(F.array(i))))).otherwise(F.col("path"))
    short = lattice.select("hash", "unit", "tasks", path.alias("path")).select("hash", "unit", "tasks", whole.alias("ids"))

    @F.pandas_udf("array<int>")
    def folded(texts: pd.Series) -> pd.Series:
        return texts.map(folder(pieces))

    long = units.filter(F.char_length("unit") > longest).select("hash", "unit", "tasks", folded("unit").alias("ids"))
    return short.union(long)


def encode_texts(documents: DataFrame, pieces: Pieces, most_units: int = MOST_UNITS, longest: int = LONGEST, then: Batches | None = None, added: str = "") -> DataFrame:
    """All rows and columns, and ids: array<int>, of the column text.

    `then` goes on with the batches in the same task; `added` are the columns that it adds.
    """
    documents = documents.drop("ids")
    units = materialize(distinct_units(documents, pieces.cuts, b" "), "units")
    table = collected(encode_units(common_units(units, most_units), pieces, longest))
    held = documents.sparkSession.sparkContext.broadcast(table)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fold = folder(pieces)
        encoder = TaskEncoder(lambda texts: flattened([fold(text) for text in texts]), held.value)
        out = encoded_batches(batches, encoder, pieces.cuts, b" ")
        return then(out) if then else out

    schema = StructType([*documents.schema.fields, *StructType.fromDDL("ids array<int>" + (f", {added}" if added else "")).fields])
    return documents.mapInArrow(rows, schema)


def decode_batches(pieces: Pieces, name: str = "decoded") -> Batches:
    """Adds the text of the column ids: pieces joined, byte pieces as UTF-8, the space in front dropped."""
    raw = [p.replace(SPACE, " ").encode() for p in pieces.by_id]
    for byte, i in enumerate(pieces.bytes):
        raw[i] = bytes([byte])
    flat, lengths = np.frombuffer(b"".join(raw), np.uint8), np.array([len(r) for r in raw])
    begin = np.cumsum(lengths) - lengths

    def texts(lists: pa.Array) -> pa.Array:
        ids = lists.flatten().to_numpy()
        first = np.append(0, np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)))
        size = lengths[ids]
        ends = np.append(0, np.cumsum(size))
        data = flat[np.arange(int(ends[-1])) + np.repeat(begin[ids] - ends[:-1], size)]
        edges = ends[first]
        kept = np.ones(len(data), dtype=bool)
        front = edges[:-1][edges[1:] > edges[:-1]]
        kept[front] = data[front] != 32
        offsets = np.append(0, np.cumsum(kept))[edges]
        out = pa.StringArray.from_buffers(len(lists), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data[kept].tobytes()))
        try:
            out.validate(full=True)
        except pa.ArrowInvalid:  # bytes that are no UTF-8 come from ids that no text gives
            return pa.array([data[kept][a:b].tobytes().decode(errors="replace") for a, b in zip(offsets[:-1], offsets[1:])], pa.string())
        return out

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, ROWS):
                part = batch.slice(low, ROWS)
                yield pa.RecordBatch.from_arrays([*part.columns, texts(part["ids"])], [*part.schema.names, name])

    return decode


def decode_texts(rows: DataFrame, pieces: Pieces, name: str = "decoded") -> DataFrame:
    """All rows and columns, and the text of the column ids."""
    return rows.mapInArrow(decode_batches(pieces, name), StructType([*rows.schema.fields, StructField(name, StringType())]))


def crc32_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds ids_crc32: the unsigned CRC-32 of the column ids as little-endian unsigned 32-bit integers."""
    for batch in batches:
        offsets, values = batch["ids"].offsets.to_numpy(), batch["ids"].values.to_numpy().astype("<u4")
        crc = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:])]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(crc, pa.int64())], [*batch.schema.names, "ids_crc32"])
