"""Phrases that are frequent and stick together, by dynamic itemset counting.

Texts are dealt into shards that are scanned in a circle, one shard a step. All
words are counted from the first step on. A longer phrase is counted as soon as both
its parts (all words but the last, and all but the first) have reached the threshold
in the shards scanned so far, whatever the step; it is counted for one full circle
from there, beside words and phrases of other lengths, and is done then. The scans
end when no phrase is still being counted. So counts are exact, and a phrase with a
rare part is never counted.

What a task needs to know of the parts is in two arrays of at most 2^24 bytes: the
first and the last step at which a phrase of each hash slot reached the threshold.
They tell exactly which phrases cannot be counted now; slots that several phrases
share only let more through. As a shard gives a phrase the same count whenever it is
scanned, a phrase counted in a shard twice takes the larger count, and one that
passed for another reason than its own parts is not let in at the end. Beyond a few million
frequent phrases slots fill up and more rare phrases are counted; results stay.

Spark adds up the tasks' counts by 64-bit identifiers of language and words, and keeps
for each the least hash of a text that has it. In the end the texts so named, and no
others, give the frequent phrases their words. No task or driver holds a table that
grows with the corpus.

A phrase's score is the least, over its cuts into two parts, of
floor(1000 * a * n / (l * r)), in decimals of 38 digits: a its occurrences, l and r
those of the parts, n all words of the language.

Cases: a null text is empty, a null language is `und`; a text without words adds
nothing; repeated rows count again; an empty table gives no rows; other columns are
not read. A long text is one slice of a task and takes some 100 times its bytes
there. Identifiers that two phrases share, which is not expected, would add up.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandlab.llm.row_filters import once, possible
from demandlab.llm.words import mix, span_hashes, text_slices, utf8
from demandlab.session import fresh_path, materialize

LONGEST, THRESHOLD, SHARDS = 5, 100, 2
#: What splits pieces, as a character class; within a piece words are runs of anything but spaces and tabs.
BREAKS = ".,;:!?\n\x0b\x0c\r"
UNKNOWN = "und"
#: Slots of the arrays that say when parts became frequent: 64 a phrase within these bounds.
LEAST_SLOTS, MOST_SLOTS = 1 << 16, 1 << 24
#: Identifiers that a task holds before it counts them.
HELD = 1 << 22
#: Up to so many frequent phrases (about 32 MB) are sent to the counts; more are joined.
MOST_SENT = 1 << 19
#: Steps are at most LONGEST * SHARDS, which a byte holds; this one never comes.
NEVER = 255
_STEP = np.uint64(0x9E3779B97F4A7C15)
_SPACE, _BREAK = 32, 10


#: Bytes as they count: lower-cased, line feeds between pieces, spaces between words.
_NORMAL = np.arange(256, dtype=np.uint8)
_NORMAL[65:91] += 32
_NORMAL[list(BREAKS.encode())] = _BREAK
_NORMAL[9] = _SPACE


class Phrases:
    """The words of texts, and the identifiers of the phrases that start at each."""

    def __init__(self, languages: pa.Array, column: pa.Array):
        data, offsets = utf8(column)
        data = _NORMAL[data]
        inside = np.zeros(len(data) + 2, dtype=bool)
        inside[1:-1] = (data != _SPACE) & (data != _BREAK)
        cut = np.zeros(len(data) + 1, dtype=bool)
        cut[offsets] = True
        self.data = data
        self.starts = np.flatnonzero(inside[1:] & (cut | ~inside[:-1]))
        self.ends = np.flatnonzero(inside[:-1] & (cut | ~inside[1:]))
        self.row = np.searchsorted(offsets, self.starts, side="right") - 1
        breaks = np.append(0, np.cumsum(data == _BREAK))
        #: Words of one piece have one number.
        self.piece = breaks[self.starts] + self.row
        names = languages.dictionary_encode()
        codes = names.indices.to_numpy(zero_copy_only=False)
        kinds, begin = utf8(names.dictionary)
        own = np.zeros(len(begin) - 1, dtype=np.uint64)
        filled = np.diff(begin) > 0
        own[filled] = span_hashes(kinds, begin[:-1][filled], begin[1:][filled])
        #: The identifier of each row's language.
        self.language = mix(own + np.uint64(1))[codes]
        self.words = span_hashes(data, self.starts, self.ends)
        #: identifiers[k] is that of the phrase of k words at each place; at the end of a piece it means nothing.
        self.identifiers = [None, mix(self.words * _STEP + self.language[self.row])]

    def __len__(self) -> int:
        return len(self.starts)

    def fits(self, size: int) -> np.ndarray:
        """Whether the `size` words from each place are of one piece, for all places with so many words behind."""
        return self.piece[: len(self) - size + 1] == self.piece[size - 1 :] if len(self) >= size else np.empty(0, dtype=bool)

    def of_size(self, size: int) -> np.ndarray:
        while len(self.identifiers) <= size:
            k = len(self.identifiers)
            n = max(0, len(self) - k + 1)
            self.identifiers.append(mix(self.identifiers[-1][:n] * _STEP + self.words[k - 1 :][:n]))
        return self.identifiers[size]

    def texts(self, places: np.ndarray, size: int) -> pa.Array:
        """The phrases of `size` words at some places, their words joined by single spaces."""
        words = (places[:, None] + np.arange(size)).ravel()
        lengths = self.ends[words] - self.starts[words] + 1
        ends = np.append(0, np.cumsum(lengths))
        where = np.arange(int(ends[-1])) + np.repeat(self.starts[words] - ends[:-1], lengths)
        last = ends[1:] - 1
        out = np.full(int(ends[-1]), _SPACE, dtype=np.uint8)
        keep = np.ones(len(out), dtype=bool)
        keep[last] = False
        out[keep] = self.data[where[keep]]
        keep[last] = np.arange(len(words)) % size < size - 1  # no space behind the last word
        sizes = np.add.reduceat(lengths, np.arange(0, len(words), size)) - 1 if len(words) else lengths
        return pa.StringArray.from_buffers(len(places), pa.py_buffer(np.append(0, np.cumsum(sizes)).astype(np.int32)), pa.py_buffer(out[keep].tobytes()))


class Reached:
    """For each slot of identifiers, the first and last step at which one of them was frequent. An identifier has two slots."""

    def __init__(self, first: np.ndarray, last: np.ndarray):
        self.first, self.last = first, last

    def _slots(self, identifiers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        mask = np.uint64(len(self.first) - 1)
        return (identifiers & mask).astype(np.int64), (identifiers >> np.uint64(32) & mask).astype(np.int64)

    def open(self, phrases: Phrases, size: int, step: int, shards: int) -> np.ndarray:
        """The places whose phrase of `size` words may be in its circle at this step."""
        fits = phrases.fits(size)
        one, two = self._slots(phrases.of_size(size - 1))
        known = np.maximum(self.first[one], self.first[two]) <= step
        n = len(fits)
        places = np.flatnonzero(fits & known[:n] & known[1 : n + 1])
        last = lambda at: np.minimum(self.last[one[at]], self.last[two[at]]).astype(np.int64)
        return places[np.maximum(last(places), last(places + 1)) + shards > step]


def _counted(sizes: list[int], step: int, shards: int, held) -> Callable:
    """(size, id, n, spot): the task's count of each phrase of the sizes that may be in its circle, and a text that has it; size 0 counts a language's words."""

    def total(size: int, parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        found, spots = (np.concatenate(x) for x in zip(*parts))
        # Any text that has the phrase will do, so the order of equal identifiers does not matter.
        order = np.argsort(found)
        ids = found[order]
        first = np.flatnonzero(np.append(len(ids) > 0, ids[1:] != ids[:-1]))
        ids, n, first = ids[first], np.diff(np.append(first, len(ids))), order[first]
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), size, np.int32)), pa.array(ids.view(np.int64)), pa.array(n), pa.array(spots[first])], ["size", "id", "n", "spot"])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, list] = {size: [] for size in sizes}
        for batch in text_slices(batches):
            phrases, spot = Phrases(batch["lang"], batch["text"]), batch["spot"].to_numpy()
            for size in sizes if len(phrases) else ():
                if size < 2:
                    places, found = slice(None), phrases.of_size(1) if size else phrases.language[phrases.row]
                else:
                    places = held.value.open(phrases, size, step, shards)
                    found = phrases.of_size(size)[places]
                parts[size].append((found, spot[phrases.row[places]]))
                if sum(len(x) for x, _ in parts[size]) > HELD:
                    yield total(size, parts[size])
                    parts[size] = []
        for size, found in parts.items():
            if found:
                yield total(size, found)

    return counted


def _named(longest: int) -> Callable:
    """(size, id, lang, phrase): the words of the phrases that each text is to name (a list of sizes and identifiers)."""

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(once(batches)):
            phrases, wanted = Phrases(batch["lang"], batch["text"]), batch["wanted"].flatten()
            sizes, ids = wanted.field("size").to_numpy(), wanted.field("id").to_numpy().view(np.uint64)
            for size in np.unique(sizes).tolist():
                # At the end of a piece an identifier is of no phrase, but of words that stand together elsewhere.
                places = np.flatnonzero(phrases.fits(max(size, 1)))
                found = phrases.language[phrases.row[places]] if size == 0 else phrases.of_size(size)[places]
                places = places[np.isin(found, ids[sizes == size])]
                found, first = np.unique(phrases.language[phrases.row[places]] if size == 0 else phrases.of_size(size)[places], return_index=True)
                places = places[first]
                names = pa.array([""] * len(places), pa.string()) if size == 0 else phrases.texts(places, size)
                langs = batch["lang"].take(pa.array(phrases.row[places]))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(places), size, np.int32)), pa.array(found.view(np.int64)), langs, names], ["size", "id", "lang", "phrase"])

    return named


def _reached(frequent: DataFrame) -> Reached:
    """The arrays for phrases (id, step). At most MOST_SLOTS rows come to the driver."""
    count = frequent.count()
    slots = min(MOST_SLOTS, max(LEAST_SLOTS, 1 << (64 * count).bit_length()))
    places = F.array(F.col("id"), F.shiftrightunsigned("id", 32))
    slot = F.col("place").bitwiseAND(F.lit(slots - 1)).cast("int").alias("slot")
    rows = frequent.select(F.explode(places).alias("place"), "step").groupBy(slot).agg(F.min("step").cast("short").alias("first"), F.max("step").cast("short").alias("last")).toArrow()
    first, last = np.full(slots, NEVER, dtype=np.uint8), np.zeros(slots, dtype=np.uint8)
    place = rows["slot"].to_numpy()
    first[place], last[place] = rows["first"].to_numpy(), rows["last"].to_numpy()
    return Reached(first, last)


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def frequent_phrases(documents: DataFrame, longest: int = LONGEST, threshold: int = THRESHOLD, shards: int = SHARDS) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, size, n) of all phrases of up to `longest` words with n of at least `threshold`, and (lang, n) of all words."""
    if longest * shards >= NEVER:
        raise ValueError("too many shards")
    spark, path = documents.sparkSession, fresh_path(documents.sparkSession, "phrase-shards")
    lang, text = F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), F.coalesce("text", F.lit("")).alias("text")
    # Equal texts are spread over the shards by their row's id.
    shard = F.pmod(F.xxhash64("doc_id", "text"), F.lit(shards)).cast("int").alias("shard")
    stored = documents.select(lang, text, shard).withColumn("spot", F.hash("text"))
    stored.write.partitionBy("shard").parquet(path)
    stored = spark.read.schema("lang string, text string, spot int, shard int").parquet(path)

    none = spark.createDataFrame([], "size int, id long, step int")
    steps: list[DataFrame] = []  # counts by size and phrase, one table a step
    frequent: list[DataFrame] = []  # phrases by the step from which their extensions may count them
    upto = {1: shards - 1}  # the last step at which phrases of each size are still counted
    total_words, step = [], 0
    while step <= max(upto.values()):
        sizes = [size for size in range(1, longest + 1) if upto.get(size, -1) >= step]
        sent = spark.sparkContext.broadcast(_reached(_union(frequent).filter(F.col("size") < longest)) if frequent else None)
        wanted = ([0] if step < shards else []) + sizes
        rows = stored.filter(F.col("shard") == step % shards).select("lang", "text", "spot").mapInArrow(_counted(wanted, step, shards, sent), "size int, id long, n long, spot int")
        # Written once: what later steps read of it is its phrases alone.
        # A task has counted its own already; without the shuffle in front Spark would hash all of them once more before it.
        counts = materialize(rows.repartition("size", "id").groupBy("size", "id").agg(F.sum("n").alias("n"), F.min("spot").alias("spot")), "phrase-counts")
        total_words.append(counts.filter("size = 0"))
        steps.append(counts.filter("size > 0"))
        recent = [frame.withColumn("shard", F.lit(k % shards)) for k, frame in enumerate(steps)][-shards:]
        known = _union(frequent).select("size", "id") if frequent else none.select("size", "id")
        # A circle ends with this step at the latest for what was counted before; the last `shards` steps hold all of it.
        sums = _union(recent).filter(F.col("size").isin(sizes)).groupBy("size", "id").agg(F.sum("n").alias("n")).filter(F.col("n") >= threshold)
        new = materialize(sums.join(known, ["size", "id"], "left_anti").select("size", "id", F.lit(step + 1).alias("step")), "frequent")
        frequent.append(new)
        for row in new.groupBy("size").agg(F.count("*").alias("n")).collect():
            if row["size"] < longest:  # its extensions have a circle from the next step on
                upto[row["size"] + 1] = step + shards
        sent.unpersist()
        step += 1

    # Of two scans of one shard either gives the phrase's count; a phrase is whole with one count for each shard.
    by_shard = _union([frame.withColumn("shard", F.lit(k % shards)) for k, frame in enumerate(steps)])
    held = materialize(_union(frequent).select("size", "id").distinct(), "held")
    best = by_shard.join(F.broadcast(held) if held.count() <= MOST_SENT else held, ["size", "id"]).groupBy("size", "id", "shard").agg(F.max("n").alias("n"), F.min("spot").alias("spot"))
    total = (F.sum("n").alias("n"), F.min("spot").alias("spot"))
    words = _union(total_words).groupBy("size", "id").agg(*total)
    whole = materialize(best.groupBy("size", "id").agg(*total).filter(F.col("n") >= threshold).union(words), "phrase-totals")
    # The phrases of one text: no more than its words allow.
    wanted = materialize(whole.groupBy("spot").agg(F.collect_list(F.struct("size", "id")).alias("wanted")), "phrase-spots")
    texts = possible(stored.select("lang", "text", "spot"), wanted.select("spot"), "spot").join(wanted, "spot")
    names = texts.withColumn("text_key", F.xxhash64("lang", "text")).mapInArrow(_named(longest), "size int, id long, lang string, phrase string")
    names = names.groupBy("size", "id").agg(F.min("lang").alias("lang"), F.min("phrase").alias("phrase"))
    phrases = materialize(names.join(whole, ["size", "id"]).select("lang", "phrase", "size", "n"), "phrases")
    return phrases.filter("size > 0"), phrases.filter("size = 0").select("lang", "n")


def collocations(documents: DataFrame, longest: int = LONGEST, threshold: int = THRESHOLD, shards: int = SHARDS, best: int = 2000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first `best` phrases of each language by score, a, and phrase.

    ``documents`` has doc_id, lang and text. A phrase inside a longer one that occurs
    as often is left out.
    """
    phrases, languages = frequent_phrases(documents, longest, threshold, shards)
    candidates = phrases.filter("size >= 2")
    words = F.split("phrase", " ")
    # A phrase is in a longer one as often as both occur only if that holds for one that is a word longer.
    part = lambda start: F.array_join(F.slice(words, start, F.col("size") - 1), " ")
    longer = candidates.filter("size >= 3").select("lang", F.explode(F.array(part(1), part(2))).alias("phrase"), F.col("n").alias("a")).distinct()
    own = candidates.withColumnRenamed("n", "a").join(longer, ["lang", "phrase", "a"], "left_anti")
    cuts = own.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    first = F.array_join(F.slice(words, F.lit(1), F.col("k")), " ")
    rest = F.array_join(F.slice(words, F.col("k") + 1, F.col("size") - F.col("k")), " ")
    cuts = cuts.select("lang", "phrase", "a", "k", first.alias("first"), rest.alias("rest"))
    of = lambda name, count: phrases.select("lang", F.col("phrase").alias(name), F.col("n").alias(count))
    cuts = cuts.join(of("first", "l"), ["lang", "first"]).join(of("rest", "r"), ["lang", "rest"]).join(languages, "lang")
    wide = lambda name: F.col(name).cast("decimal(38,0)")
    cuts = cuts.select("lang", "phrase", "a", "l", "r", "n", "k", (F.lit(1000).cast("decimal(38,0)") * wide("a") * wide("n")).cast("decimal(38,0)").alias("_over"), (wide("l") * wide("r")).cast("decimal(38,0)").alias("_under"))
    cut = F.min(F.struct(F.expr("_over div _under").alias("score"), "k", "l", "r", "n")).alias("cut")
    scored = cuts.groupBy("lang", "phrase", "a").agg(cut).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.n", "cut.score")
    # Each of some parts of a language first gives up all that cannot be among its first.
    order = [F.desc("score"), F.desc("a"), "phrase"]
    spread = Window.partitionBy("lang", "_part").orderBy(*order)
    near = scored.withColumn("_part", F.pmod(F.xxhash64("phrase"), F.lit(64))).withColumn("_rank", F.row_number().over(spread)).filter(F.col("_rank") <= best)
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= best)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
