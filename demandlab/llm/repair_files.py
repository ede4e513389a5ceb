"""Token files compressed by grammars: Re-Pair per shard.

Documents are encoded with a public tokenizer, each ends with an end id, and they
are written in ascending doc_id order as shards of whole documents. In each
shard frequent pairs of neighbouring symbols are repeatedly replaced by new
symbols (rules); no pair spans two documents. Every rule is stored with the
number of ids it expands to, so a place in a document is found, and decoded,
without expanding what stands before it.

The file format is Parquet with a row per shard:
  part, shard    the place of the shard in the order of the file
  n_ids          ids of its documents with their end ids
  low, high      the least and largest id of its documents, nulls aside
  doc_id, n_tokens, n_symbols   arrays, one entry per document
  rules          little-endian uint32 pairs; rule k is the symbol `first_rule` + k
  expansions     little-endian uint32: the number of ids of each rule
  width, symbols little-endian unsigned symbols of `width` bytes, document after document

Encoding goes by units: a byte-level tokenizer of this kind starts anew before a
space with a sign after it, before other white space, and between letters and
signs, so the library encodes what lies between once: for the units of a bounded
sample beforehand, for others when a task first meets them.

Cases: a null or empty text has the end id alone; a null id comes first; repeated
ids are ordered by a hash of the text and repeated rows are written like any others; an empty
table gives files without shards; other columns are not written.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from demandlab.llm.unit_table import Cuts, TaskEncoder, collected, common_units, distinct_units, encoded_batches, flattened
from demandlab.session import materialize

END, SHARD_IDS = 2, 1 << 20
#: About so many documents' units are encoded beforehand, and sent to every task; it only saves time.
SAMPLE, MOST_UNITS = 10_000, 1 << 20
#: Units given to the library in one string.
LINE = 64
#: The least count of a pair that is replaced, and the most bins in which pairs are counted, as a power of two.
LEAST, BIN_BITS = 8, 18
_SPACES, _ASCII_SPACE, _LETTER = (np.zeros(256, dtype=bool) for _ in range(3))
#: White space of ASCII, and the first bytes of all white space beyond it.
_SPACES[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 0xC2, 0xE1, 0xE2, 0xE3]] = True
_ASCII_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LETTER[65:91] = _LETTER[97:123] = True
#: Signs beside which a letter starts or ends a token: an apostrophe may belong to the letters after it.
_SIGN = np.zeros(256, dtype=bool)
_SIGN[33:127] = True
_SIGN[48:58] = _SIGN[39] = False
_SIGN &= ~_LETTER
#: Bits of a byte, and of one after it; where they meet a token begins: before the second byte, or (16) before the first.
_KIND = (_LETTER * 1 | _SIGN * 2 | (np.arange(256) == 32) * 16).astype(np.uint8).tobytes()
_NEXT = (_LETTER * 2 | _SIGN * 1 | _ASCII_SPACE * 3 | ~_SPACES * 16).astype(np.uint8).tobytes()


def word_cuts(special: tuple[bytes, ...] = ()) -> Cuts:
    """Places where a token must begin, except inside special tokens."""

    def cuts(data: np.ndarray) -> np.ndarray:
        raw = data.tobytes()
        met = np.frombuffer(raw.translate(_KIND), np.uint8)[:-1] & np.frombuffer(raw.translate(_NEXT), np.uint8)[1:]
        begins = np.zeros(len(data), dtype=bool)
        begins[:-1] = met & 16  # a space that a character other than white space follows
        begins[1:] |= (met & 3) > 0
        for token in special:
            at = raw.find(token)
            while at >= 0:
                begins[at + 1 : at + len(token)] = False
                at = raw.find(token, at + len(token))
        return begins

    return cuts


def _frequent(code: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(at, number, values): which of the codes occur `least` times or more, and which of `values` each is."""
    # A bin with too few codes holds no frequent one; what is left is counted by a hash table.
    bits = min(BIN_BITS, max(1, len(code).bit_length()))
    bins = (code.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - bits)).view(np.int64)
    inside = np.flatnonzero((np.bincount(bins, minlength=1 << bits) >= least)[bins])
    coded = pa.array(code[inside]).dictionary_encode()
    which, values = coded.indices.to_numpy(), coded.dictionary.to_numpy()
    full = np.bincount(which, minlength=len(values)) >= least
    enough = np.flatnonzero(full[which])
    return inside[enough], (np.cumsum(full) - 1)[which[enough]], values[full]


def compress(ids: np.ndarray, last: np.ndarray, first_rule: int, least: int = LEAST):
    """(symbols, last, rules): `last` marks the final symbol of each document.

    A round replaces all pairs that occur `least` times or more; rounds go on until
    there is no such pair. A new frequent pair has a symbol of the round before, so
    most rounds look at those places alone; when they find nothing all are looked at.
    Symbols stay in their places and know those beside them, so a round costs what it
    looks at; place n stands for what lies beyond a document.
    """
    n, rules = len(ids), [np.empty((0, 2), dtype=np.int64)]
    symbols, first = np.append(ids, 0).astype(np.int32), np.append(True, last[:-1])[:n]
    after, before = np.arange(1, n + 2, dtype=np.int32), np.arange(-1, n, dtype=np.int32)
    after[:n][last] = after[n] = n
    before[:n][first] = n
    alive, near, next_rule = np.ones(n, dtype=bool), None, first_rule
    while True:
        places = np.flatnonzero(alive if near is None else near)
        second = after[places]
        inner = np.flatnonzero(second < n)
        places, second = places[inner], second[inner]
        pair = np.empty((len(places), 2), dtype="<i4")
        pair[:, 1], pair[:, 0] = symbols[places], symbols[second]
        at, number, values = _frequent(pair.view("<i8").ravel(), least)
        at, second = places[at], second[at]
        # Of overlapping pairs in a row every second one is taken, from the left.
        begins = np.flatnonzero(np.append(True, second[:-1] != at[1:])[: len(at)])
        in_row = np.arange(len(at)) - np.repeat(begins, np.diff(np.append(begins, len(at))))
        taken = np.flatnonzero(in_row & 1 == 0)
        at, second, number = at[taken], second[taken], number[taken]
        # What its neighbours left with a single place is no rule yet; half of all places are taken, so with four or more a pair some pair has two.
        used = np.bincount(number, minlength=len(values)) > 1
        if not used.all():
            kept = np.flatnonzero(used[number])
            at, second, number = at[kept], second[kept], (np.cumsum(used) - 1)[number[kept]]
        if not len(at):
            if near is None:
                break
            near = None
            continue
        symbols[at] = next_rule + number
        beyond = after[second]
        after[at], before[beyond], alive[second] = beyond, at, False
        near = np.zeros(n + 1, dtype=bool)
        near[at] = near[before[at]] = True
        near[n] = False
        values = values[used]
        rules.append(np.stack([values >> 32, values & 0xFFFFFFFF], axis=1))
        next_rule += len(values)
    return symbols[:n][alive].astype(np.int64), after[:n][alive] == n, np.concatenate(rules)


def packed(symbols: np.ndarray, width: int) -> bytes:
    return symbols.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :width].tobytes()


def unpacked(raw: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(raw) // width, 4), dtype=np.uint8)
    out[:, :width] = np.frombuffer(raw, np.uint8).reshape(-1, width)
    return out.view("<u4").ravel().astype(np.int64)


def expansions(rules: np.ndarray, first_rule: int) -> np.ndarray:
    """The number of ids that each rule stands for."""
    size = []
    for a, b in rules.tolist():
        size.append((size[a - first_rule] if a >= first_rule else 1) + (size[b - first_rule] if b >= first_rule else 1))
    return np.array(size, dtype=np.int64)


def _lengths(symbols: np.ndarray, sizes: np.ndarray, first_rule: int) -> np.ndarray:
    lengths, rule = np.ones(len(symbols), dtype=np.int64), symbols >= first_rule
    lengths[rule] = sizes[symbols[rule] - first_rule]
    return lengths


def expand(symbols: np.ndarray, rules: np.ndarray, first_rule: int, sizes: np.ndarray | None = None) -> np.ndarray:
    """All ids, by replacing rules by their pairs until none is left; each id goes to its place at once."""
    symbols = symbols.astype(np.int64)
    sizes = expansions(rules, first_rule) if sizes is None else sizes
    ends = np.cumsum(_lengths(symbols, sizes, first_rule))
    out, place = np.empty(int(ends[-1]) if len(ends) else 0, dtype=np.int64), np.append(0, ends[:-1])[: len(ends)]
    while len(symbols):
        rule = symbols >= first_rule
        out[place[~rule]] = symbols[~rule]
        pair, place = rules[symbols[rule] - first_rule], place[rule]
        symbols = np.concatenate([pair[:, 0], pair[:, 1]])
        place = np.concatenate([place, place + _lengths(pair[:, 0], sizes, first_rule)])
    return out


def expand_shard(symbols: np.ndarray, rules: np.ndarray, first_rule: int, sizes: np.ndarray) -> np.ndarray:
    """As ``expand``; each rule is expanded once, and its ids are copied to all its places."""
    ends = np.cumsum(_lengths(symbols, sizes, first_rule))
    if not len(ends) or sizes.sum() > ends[-1]:  # rules within rules that together are longer than the ids
        return expand(symbols, rules, first_rule, sizes)
    ids = np.append(np.arange(first_rule), expand(np.arange(len(rules)) + first_rule, rules, first_rule, sizes))
    starts = np.append(np.arange(first_rule), np.cumsum(sizes) - sizes + first_rule)[symbols]
    lengths = np.diff(ends, prepend=0)
    return ids[np.arange(int(ends[-1])) + np.repeat(starts - ends + lengths, lengths)]


def ids_between(symbols: np.ndarray, rules: np.ndarray, sizes: np.ndarray, first_rule: int, start: int, stop: int) -> np.ndarray:
    """The ids from start up to stop of a run of symbols; only what covers them is expanded."""
    ends = np.cumsum(_lengths(symbols, sizes, first_rule))
    low, high = np.searchsorted(ends, start, side="right"), np.searchsorted(ends, stop, side="left") + 1
    before = int(ends[low - 1]) if low else 0
    return expand(symbols[low:high], rules, first_rule, sizes)[start - before : stop - before]


_SHARD = "part int, shard int, n_ids long, low {kind}, high {kind}, doc_id array<{kind}>, n_tokens array<int>, n_symbols array<int>, first_rule int, rules binary, expansions binary, width int, symbols binary"


@functools.cache
def _library(tokenizer_file: str):
    """The tokenizer, its special tokens as bytes, and a function from units to their ids; a process loads them once.

    A line feed between two units that neither start nor end with white space (but
    for one space in front) is a token of its own, so such units are encoded some
    hundreds at a time and told apart by it; others one by one.
    """
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_file)
    special = tuple(token.content for token in tokenizer.get_added_tokens_decoder().values())
    feed = tokenizer.encode("\n", add_special_tokens=False).ids

    def ids_of(texts: list[str]) -> list[list[int]]:
        return [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    signed = not any(token.isalnum() for token in special)

    def apart(unit: str) -> bool:
        body = unit[1:] if unit[0] == " " else unit
        if signed and body.isalnum():  # most units; they hold no special token, for each has a sign
            return True
        return bool(body) and not (body[0].isspace() or body[-1].isspace() or "\n" in body or any(token in body for token in special))

    def encode(units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        alone = np.array([not apart(unit) for unit in units], dtype=bool)
        joined = np.flatnonzero(~alone)
        lines = ["\n".join([units[k] for k in joined[low : low + LINE]]) + "\n" for low in range(0, len(joined), LINE)]
        flat = np.array([i for ids in ids_of(lines) for i in ids], dtype=np.int32)
        ends = np.flatnonzero(flat == feed[0]) if len(feed) == 1 else np.empty(0, np.int64)
        if len(ends) != len(joined):  # not a tokenizer of this kind
            return flattened(ids_of(units))
        lengths = np.empty(len(units), dtype=np.int64)
        lengths[joined] = np.diff(np.append(-1, ends)) - 1
        lengths[alone], others = flattened(ids_of([units[k] for k in np.flatnonzero(alone)]))
        out, of_alone = np.empty(int(lengths.sum()), dtype=np.int32), np.repeat(alone, lengths)
        out[of_alone], out[~of_alone] = others, np.delete(flat, ends)
        return lengths, out

    return tokenizer, tuple(token.encode() for token in special), encode


def _sample_table(documents: DataFrame, tokenizer_file: str, sample: int):
    """The encoded units of about `sample` documents, chosen by the hash of their text."""
    share = min(1.0, sample / max(1, documents.count()))
    chosen = documents.filter(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < int(share * (1 << 30))).select("text").distinct()
    _, special, _ = _library(tokenizer_file)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, _, encode = _library(tokenizer_file)
        for batch in batches:
            lengths, ids = encode(batch["unit"].to_pylist())
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(lengths)).astype(np.int32)), pa.array(ids))
            yield pa.RecordBatch.from_arrays([batch["hash"], lists], ["hash", "ids"])

    units = materialize(distinct_units(chosen, word_cuts(special)), "units")
    return collected(common_units(units, MOST_UNITS).select("hash", "unit").mapInArrow(encoded, "hash long, ids array<int>"))


def write_shards(documents: DataFrame, path: str, tokenizer_file: str, end: int = END, shard_ids: int = SHARD_IDS, sample: int = SAMPLE) -> None:
    """Encode the columns doc_id and text and write the shards. tokenizer_file: a path that all machines can read."""
    documents = documents.select("doc_id", "text")
    held = documents.sparkSession.sparkContext.broadcast(_sample_table(documents, tokenizer_file, sample))
    kind = documents.schema["doc_id"].dataType.simpleString()
    names = ["part", "shard", "n_ids", "low", "high", "doc_id", "n_tokens", "n_symbols", "first_rule", "rules", "expansions", "width", "symbols"]

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tokenizer, special, encode = _library(tokenizer_file)
        first_rule, encoder = tokenizer.get_vocab_size(), TaskEncoder(encode, held.value)
        part, shard, docs, parts, size = TaskContext.get().partitionId(), 0, [], [], 0

        def finished() -> pa.RecordBatch:
            lengths, ids = np.array([len(x) for x in parts]), np.concatenate(parts)
            last = np.zeros(len(ids), dtype=bool)
            last[np.cumsum(lengths) - 1] = True
            symbols, last, rules = compress(ids, last, first_rule)
            width = next(w for w in (2, 3, 4) if len(rules) + first_rule <= 1 << 8 * w)
            known = [doc for doc in docs if doc is not None]
            low, high = (known[0], known[-1]) if known else (None, None)
            n_symbols = np.diff(np.append(-1, np.flatnonzero(last)))
            row = [part, shard, len(ids), low, high, docs, lengths.tolist(), n_symbols.tolist(), first_rule, rules.astype("<u4").tobytes(), expansions(rules, first_rule).astype("<u4").tobytes(), width, packed(symbols, width)]
            types = [pa.int32(), pa.int32(), pa.int64(), doc_type, doc_type, pa.list_(doc_type), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.int32(), pa.binary(), pa.binary(), pa.int32(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names)

        for batch in encoded_batches(batches, encoder, word_cuts(special)):
            doc_type = batch.schema.field("doc_id").type
            offsets = batch["ids"].offsets.to_numpy()
            values = np.insert(batch["ids"].values.to_numpy(), offsets[1:], np.int32(end))
            offsets = offsets + np.arange(len(offsets))
            for k, doc in enumerate(batch["doc_id"].to_pylist()):
                ids = values[offsets[k] : offsets[k + 1]]
                if parts and size + len(ids) > shard_ids:
                    yield finished()
                    shard, docs, parts, size = shard + 1, [], [], 0
                docs.append(doc)
                parts.append(ids)
                size += len(ids)
        if parts:
            yield finished()

    # Ranges are found from a sample of the keys, which must not hold texts.
    keyed = documents.withColumn("text_key", F.xxhash64("text"))
    ordered = keyed.repartitionByRange("doc_id", "text_key").sortWithinPartitions("doc_id", "text_key")
    ordered.select("doc_id", "text").mapInArrow(shards, _SHARD.format(kind=kind)).write.mode("overwrite").parquet(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files: doc_id, start (ids of all documents before it), n_tokens and ids_crc32, by decoding its symbols."""
    files = spark.read.parquet(path)
    # Running sums in two steps: over the parts, which are as many as the writer's tasks, then over a part's shards.
    parts = files.groupBy("part").agg(F.sum("n_ids").alias("n")).select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    within = F.sum("n_ids").over(Window.partitionBy("part").orderBy("shard")) - F.col("n_ids")
    starts = files.select("part", "shard", within.alias("within"), "n_ids").join(parts, "part").select("part", "shard", (F.col("before") + F.col("within")).alias("start"))
    kind = files.schema["doc_id"].dataType.elementType.simpleString()

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                rules = np.frombuffer(row["rules"], "<u4").astype(np.int64).reshape(-1, 2)
                sizes = np.frombuffer(row["expansions"], "<u4").astype(np.int64)
                ids = expand_shard(unpacked(row["symbols"], row["width"]), rules, row["first_rule"], sizes).astype("<u4")
                lengths = np.array(row["n_tokens"], dtype=np.int64)
                edges = np.append(0, np.cumsum(lengths))
                crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(edges[:-1], edges[1:])]
                place = [pa.array(np.full(len(lengths), row[k], np.int32)) for k in ("part", "shard")]
                columns = [*place, pa.array(row["doc_id"], batch.schema.field("doc_id").type.value_type), pa.array(edges[:-1]), pa.array(lengths), pa.array(crc, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["part", "shard", "doc_id", "at", "n_tokens", "ids_crc32"])

    # Starts meet the few numbers of each document, never the symbols.
    rows = files.drop("n_symbols", "n_ids", "low", "high").mapInArrow(decoded, f"part int, shard int, doc_id {kind}, at long, n_tokens long, ids_crc32 long")
    return rows.join(starts, ["part", "shard"]).select("doc_id", (F.col("start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def document_slice(spark: SparkSession, path: str, doc_id, start: int, stop: int) -> list[int]:
    """The ids from start up to stop of the first document with this id: shards of other ids are passed over by their bounds, and only the symbols over that place are expanded."""
    near = spark.read.parquet(path).filter((F.col("low") <= F.lit(doc_id)) & (F.col("high") >= F.lit(doc_id)))
    row = near.filter(F.array_contains("doc_id", doc_id)).orderBy("part", "shard").first()
    if row is None:
        raise KeyError(doc_id)
    at = row["doc_id"].index(doc_id)
    low = sum(row["n_symbols"][:at])
    symbols = unpacked(row["symbols"], row["width"])[low : low + row["n_symbols"][at]]
    rules = np.frombuffer(row["rules"], "<u4").astype(np.int64).reshape(-1, 2)
    return ids_between(symbols, rules, np.frombuffer(row["expansions"], "<u4").astype(np.int64), row["first_rule"], start, min(stop, row["n_tokens"][at])).tolist()
