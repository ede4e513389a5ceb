"""Toxicity by a lexicon that also catches misspelled terms, judged in context.

The lexicon is learned: words and word beginnings that occur in far more toxic
than other texts. Its trie is walked together with the Levenshtein automata of
all distinct words of a batch: a node keeps, for each word still alive, the few
cells of the edit distance that can lead to a match, as columns over the words.
Two swapped letters are one edit; long terms may have two edits, those of three
letters none. A misspelled term counts unless it is an ordinary word of texts that are not
toxic. Each hit is scored in a window of words around it: more with other hits
near, less within quotation marks, where a text reports instead of insulting.
A logistic regression turns the hits of the whole text into a score.

Terms are counted over all labelled texts, and every one that passes the test is
in the lexicon. A trie holds `PART` terms; a larger lexicon is walked part by part.
Only the regression uses a bounded sample: about `PER_LABEL` documents of each
label, chosen by a hash of the id.

Cases: null and empty texts have no hits and get the score of such a text; with
nothing to learn from every score is 0; ids with several labels count as toxic if
one is; repeated rows are scored alike; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandlab.llm import bloom
from demandlab.llm.words import Words, mix, text_slices
from demandlab.session import materialize

PER_LABEL, LEAST_DOCUMENTS, LEAST_WEIGHT = 8000, 4, 2.5
#: Terms of one trie; words whose match a task remembers; terms counted before a task hands them on.
PART, REMEMBERED, COUNTED = 50_000, 300_000, 300_000
#: Letters up to which words are sifted before the walk, and the bits of the sieve.
SIFTED, SIEVE_BITS = 32, 1 << 26
BEGINNINGS, FUZZY_FROM, WINDOW, QUOTE_BYTES = (4, 5, 6), 5, 10, 200
#: Letters from which a term may be misspelled by one edit and by two.
ONE_EDIT, TWO_EDITS = 4, 8
_QUOTES = "[“”„‟«»‹›]"
_FEATURES = 5


@dataclass
class Node:
    children: dict[int, Node] = field(default_factory=dict)
    word: int = -1
    beginning: int = -1
    #: The most letters of a whole term below.
    longest: int = 0


def trie(terms: list[tuple[str, bool]]) -> Node:
    """Terms are (text, whether it is only the beginning of a word)."""
    root = Node()
    for k, (text, beginning) in enumerate(terms):
        node = root
        for c in text:
            node = node.children.setdefault(ord(c), Node())
            if not beginning:
                node.longest = max(node.longest, len(text))
        if beginning:
            node.beginning = k
        else:
            node.word = k
    return root


def allowed_edits(length: int) -> int:
    return (length >= ONE_EDIT) + (length >= TWO_EDITS)


def matches(words: list[str], terms: list[tuple[str, bool]], root: Node | None = None, most: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """For each word the nearest term (-1: none) and its distance.

    Whole terms match within the edits that their length allows, a swap of
    neighbours being one; beginnings exactly. With `most`, terms of `FUZZY_FROM`
    letters or more match within so many edits without swaps, shorter ones exactly.
    Ties go to the earlier term.
    """
    swaps, most = most is None, 2 if most is None else most
    allowed = allowed_edits if swaps else lambda length: most if length >= FUZZY_FROM else 0
    best, distance = np.full(len(words), -1), np.full(len(words), most + 1)
    if not words or not terms:
        return best, distance
    lengths = np.array([len(w) for w in words])
    starts = np.cumsum(lengths) - lengths
    letters = np.frombuffer("".join([*words, " "]).encode("utf-32-le"), np.uint32)
    far = most + 1

    def take(alive: np.ndarray, found: np.ndarray, term: int) -> None:
        better = (found < distance[alive]) | ((found == distance[alive]) & (found <= most) & (term < best[alive]))
        best[alive[better]], distance[alive[better]] = term, found[better]

    start = np.full((2 * most + 1, len(words)), far, dtype=np.int8)
    start[most:] = np.arange(most + 1)[:, None]
    steps = np.arange(2 * most + 1)[:, None]
    # Of a node: depth, letter, words alive, cells and its parent's cells. cells[t] are
    # edits between the node's letters and the word's first depth - most + t letters.
    todo = [(root or trie(terms), 0, -1, np.arange(len(words)), start, None)]
    while todo:
        node, depth, last, alive, cells, older = todo.pop()
        size = lengths[alive]
        # The word's letter at the place of each cell, and the one before; where there is none, a cell is far.
        at = letters[np.clip(starts[alive] + steps + (depth - most), 0, len(letters) - 1)]
        before = letters[np.clip(starts[alive] + steps + (depth - most - 1), 0, len(letters) - 1)]
        outside = size < steps + (depth + 1 - most)
        swap = None if older is None else at == last
        for letter, child in node.children.items():
            new = cells + (at != letter)
            new[:-1] = np.minimum(new[:-1], cells[1:] + 1)
            if older is not None:
                new = np.where(swap & (before == letter), np.minimum(new, older + 1), new)
            for t in range(1, 2 * most + 1):
                np.minimum(new[t], new[t - 1] + 1, out=new[t])
            new[outside] = far
            new = np.minimum(new, far).astype(np.int8)
            # Only what can still match below goes on: within the edits and letters of the longest term, or exactly so far.
            kept = np.flatnonzero((new.min(axis=0) <= allowed(child.longest)) & (size <= child.longest + most) | (new[most] == 0))
            if not len(kept):
                continue
            own, cut = alive[kept], new[:, kept]
            if child.beginning >= 0:
                exact = cut[most] == 0
                take(own[exact], np.zeros(int(exact.sum()), dtype=np.int64), child.beginning)
            if child.word >= 0:
                place = lengths[own] - (depth + 1) + most
                inside = (place >= 0) & (place <= 2 * most)
                found = np.where(inside, cut[np.clip(place, 0, 2 * most), np.arange(len(own))], far)
                found = np.where(found <= allowed(depth + 1), found, far)
                take(own, found.astype(np.int64), child.word)
            if child.children:
                todo.append((child, depth + 1, letter, own, cut, cells[:, kept] if swaps else None))
    return best, distance


def matches_in_parts(words: list[str], terms: list[tuple[str, bool]], tries: list[Node], part: int = PART) -> tuple[np.ndarray, np.ndarray]:
    """`matches` of any number of terms, by tries of `part` of them. The only trie of a small lexicon is kept in `tries`."""
    if len(terms) <= part:
        tries[:] = tries or [trie(terms)]
        return matches(words, terms, tries[0])
    best, distance = matches(words, [])
    # Neighbours in the alphabet share most of their nodes.
    order = sorted(range(len(terms)), key=lambda k: terms[k])
    for low in range(0, len(order), part):
        chosen = np.array(sorted(order[low : low + part]))
        own, edits = matches(words, [terms[k] for k in chosen])
        own = np.where(own >= 0, chosen[own], -1)
        better = (own >= 0) & ((edits < distance) | (edits == distance) & (own < best))
        best[better], distance[better] = own[better], edits[better]
    return best, distance


_CODE, _BACK = np.uint64(0x9E3779B97F4A7C15), np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def shortened(words: list[str], most: int) -> tuple[np.ndarray, np.ndarray]:
    """(place of the word, hash) of every text that up to `most` deletions make of it."""
    places, hashes = [np.empty(0, dtype=np.int64)], [np.empty(0, dtype=np.uint64)]
    lengths = np.array([len(w) for w in words], dtype=np.int64)
    for length in np.unique(lengths[lengths > 0]):
        own = np.flatnonzero(lengths == length)
        letters = np.array([words[k] for k in own]).view(np.uint32).reshape(len(own), length).astype(np.uint64)
        sums = np.zeros((length + 1, len(own)), dtype=np.uint64)
        np.cumsum((mix(letters) * _CODE ** np.arange(length, dtype=np.uint64)).T, axis=0, out=sums[1:])
        found = [sums[length]]
        for i in range(length if most else 0):
            found.append(sums[i] + (sums[length] - sums[i + 1]) * _BACK)
            for j in range(i + 1, length if most > 1 else 0):
                found.append(sums[i] + (sums[j] - sums[i + 1]) * _BACK + (sums[length] - sums[j + 1]) * _BACK * _BACK)
        places.append(np.tile(own, len(found)))
        hashes.append(mix(np.concatenate(found)))
    return np.concatenate(places), np.concatenate(hashes)


class Sieve:
    """Leaves out words that no term can match: words within n edits share a text that n deletions make of both."""

    def __init__(self, terms: list[tuple[str, bool]]):
        self.beginnings = {t for t, b in terms if b}
        self.sizes = sorted({len(t) for t in self.beginnings})
        whole = [t for t, b in terms if not b and len(t) <= SIFTED]
        self.bits = [np.zeros(SIEVE_BITS // 8, dtype=np.uint8) for _ in range(3)]
        for n, bits in enumerate(self.bits):
            _, hashes = shortened([t for t in whole if allowed_edits(len(t)) == n], n)
            place = hashes & np.uint64(SIEVE_BITS - 1)
            np.bitwise_or.at(bits, (place >> np.uint64(3)).astype(np.int64), np.uint8(1) << (place & np.uint64(7)).astype(np.uint8))

    def possible(self, words: list[str]) -> np.ndarray:
        out = np.array([len(w) >= SIFTED - 1 or any(w[:n] in self.beginnings for n in self.sizes) for w in words], dtype=bool)
        for n, bits in enumerate(self.bits):
            shortest, longest = (1, ONE_EDIT - 1) if n == 0 else (ONE_EDIT - 1, TWO_EDITS) if n == 1 else (TWO_EDITS - 2, SIFTED)
            own = np.array([k for k, w in enumerate(words) if shortest <= len(w) <= longest and not out[k]], dtype=np.int64)
            for low in range(0, len(own), 20_000):
                part = own[low : low + 20_000]
                at, hashes = shortened([words[k] for k in part], n)
                place = hashes & np.uint64(SIEVE_BITS - 1)
                hit = bits[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8) & 1
                out[part[at[hit == 1]]] = True
        return out


@dataclass
class Lexicon:
    """Terms with what a task makes of them once: the sieve, and the trie if one holds them all."""

    terms: list[tuple[str, bool]]

    def matches(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """As `matches`."""
        if not hasattr(self, "_sieve"):
            self._sieve, self._tries = Sieve(self.terms), []
        best, distance = matches(words, [])
        own = np.flatnonzero(self._sieve.possible(words))
        if len(own):
            best[own], distance[own] = matches_in_parts([words[k] for k in own], self.terms, self._tries)
        return best, distance

    def __getstate__(self) -> dict:
        return {"terms": self.terms}


@dataclass
class Model:
    terms: list[tuple[str, bool]]
    weights: np.ndarray
    ordinary: frozenset[str]
    coefficients: np.ndarray

    def features(self, column: pa.Array) -> np.ndarray:
        """Per text: the highest and the summed score of exact hits, the sum of misspelled ones, hits by length, the share in quotation marks."""
        words = Words(pc.replace_substring_regex(column.cast(pa.string()), _QUOTES, '"'))
        out = np.zeros((words.rows, _FEATURES))
        if not self.terms or not len(words):
            return out
        distinct, first, back = np.unique(words.hashes(), return_index=True, return_inverse=True)
        term, distance = self._met_nearest(distinct, words, first)
        hits = np.flatnonzero(term[back] >= 0)
        rows, terms, edits = words.row[hits], term[back[hits]], distance[back[hits]]
        low, high = np.maximum(hits - WINDOW, words.first[rows]), np.minimum(hits + WINDOW, words.first[rows + 1] - 1)
        near = np.searchsorted(hits, high, side="right") - np.searchsorted(hits, low) - 1
        quote = words.data == 0x22
        for k in range(len(hits)):
            row = rows[k]
            low, high = words.offsets[row], words.offsets[row + 1]
            start, end = words.starts[hits[k]], words.ends[hits[k]]
            quoted = quote[max(low, start - QUOTE_BYTES) : start].sum() % 2 == 1 and quote[end : min(high, end + QUOTE_BYTES)].any()
            score = self.weights[terms[k]] * (1 + 0.5 * min(2, int(near[k]))) * (0.25 if quoted else 1.0)
            if edits[k] == 0:
                out[row, 0] = max(out[row, 0], score)
                out[row, 1] += score
            else:
                out[row, 2] += score
            out[row, 3] += 1
            out[row, 4] += quoted
        out[:, 4] /= np.maximum(1, out[:, 3])
        out[:, 3] /= np.sqrt(np.maximum(1, words.counts))
        out[:, 1:4] = np.log1p(out[:, 1:4])
        return out

    def nearest(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """As `matches`, but an ordinary word is no misspelled term."""
        if not hasattr(self, "_lexicon"):
            self._lexicon = Lexicon(self.terms)
        term, distance = self._lexicon.matches(words)
        term[[d > 0 and w in self.ordinary for w, d in zip(words, distance.tolist())]] = -1
        return term, distance

    def _met_nearest(self, hashes: np.ndarray, words: Words, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """`nearest` of the words at the places, by their hashes; a task remembers those it has met."""
        if not hasattr(self, "_met"):
            self._met: dict[int, int] = {}
        keys = hashes.tolist()
        new = [k for k, h in enumerate(keys) if h not in self._met]
        if len(self._met) + len(new) > REMEMBERED:
            self._met, new = {}, list(range(len(keys)))
        term, distance = self.nearest([words.text(places[k]).lower() for k in new])
        self._met.update(zip([keys[k] for k in new], (4 * term + distance).tolist()))
        found = np.array([self._met[h] for h in keys], dtype=np.int64)
        return found >> 2, found & 3

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if not k.startswith("_")}

    def scores(self, column: pa.Array) -> np.ndarray:
        if not len(self.coefficients):
            return np.zeros(len(column))
        return 1 / (1 + np.exp(-np.clip(self.features(column) @ self.coefficients[1:] + self.coefficients[0], -30, 30)))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Coefficients by Newton's method; the first is the intercept."""
    x = np.column_stack([np.ones(len(x)), x])
    w, penalty = np.zeros(x.shape[1]), np.diag([1e-3] + [ridge] * (x.shape[1] - 1))
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + penalty, x.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, beginning, toxic, clean): in how many texts a word or beginning occurs; the empty term is in all."""
    names: dict[tuple[str, bool], int] = {("", False): 0}
    counts = np.zeros((1, 2), dtype=np.int64)

    def counted() -> pa.RecordBatch:
        columns = ([t for t, _ in names], pa.string()), ([b for _, b in names], pa.bool_()), (counts[:, 0], pa.int64()), (counts[:, 1], pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], ["term", "beginning", "toxic", "clean"])

    for batch in text_slices(batches):
        words = Words(pc.replace_substring_regex(batch["text"], _QUOTES, '"'))
        clean = (batch["toxic"].to_numpy(zero_copy_only=False) == 0).astype(np.int64)
        _, first, back = np.unique(words.hashes(), return_index=True, return_inverse=True)
        terms = np.full((len(first), 1 + len(BEGINNINGS)), -1)
        for k, w in enumerate(first):
            text = words.text(w).lower()
            terms[k, 0] = names.setdefault((text, False), len(names))
            for i, n in enumerate(BEGINNINGS):
                if len(text) > n:
                    terms[k, 1 + i] = names.setdefault((text[:n], True), len(names))
        row, term = np.repeat(words.row, terms.shape[1]), terms[back].ravel()
        pairs = np.unique(row[term >= 0] * len(names) + term[term >= 0])
        row, term = np.append(pairs // len(names), np.arange(batch.num_rows)), np.append(pairs % len(names), np.zeros(batch.num_rows, dtype=np.int64))
        new = np.bincount(2 * term + clean[row], minlength=2 * len(names)).reshape(-1, 2)
        new[: len(counts)] += counts
        counts = new
        if len(names) > COUNTED:
            yield counted()
            names, counts = {("", False): 0}, np.zeros((1, 2), dtype=np.int64)
    yield counted()


def _lexicon(ranked: list) -> list:
    """Terms from the strongest on; a beginning that a stronger one covers, or that only shortens a stronger term, is left out.

    Whole words stay beside a beginning that covers them, as only they can be misspelled.
    """
    out: list = []
    beginnings: set[str] = set()
    most: dict[str, int] = {}  # by beginning: toxic texts of the strongest term that has it
    for row in ranked:
        text = row["term"]
        if row["beginning"] and (any(text[:n] in beginnings for n in BEGINNINGS) or row["toxic"] < 1.3 * most.get(text, 0)):
            continue
        out.append(row)
        if row["beginning"]:
            beginnings.add(text)
        for n in BEGINNINGS:
            if len(text) >= n:
                most[text[:n]] = max(most.get(text[:n], 0), row["toxic"])
    return out


def _labelled(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, toxic) of all documents with a label, which no table has to be small for; of several texts of an id the first."""
    key = F.xxhash64("doc_id")
    held = documents.sparkSession.sparkContext.broadcast(bloom.build(labels, key))

    @F.pandas_udf("boolean")
    def possible(keys: pd.Series) -> pd.Series:
        return pd.Series(bloom.may_contain(held.value, keys.to_numpy(np.int64).view(np.uint64)))

    # The filter keeps most texts without a label out of the shuffle.
    texts = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).filter(F.col("doc_id").isNotNull() & possible(key))
    return texts.groupBy("doc_id").agg(F.min("text").alias("text")).join(labels, "doc_id").select("text", "toxic")


def train(documents: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> Model:
    """A model from documents (doc_id, text) and labels (doc_id, toxic)."""
    spark = documents.sparkSession
    labels = labels.withColumn("doc_id", F.col("doc_id").cast(documents.schema["doc_id"].dataType))
    labels = labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = {row["toxic"]: row["n"] for row in labels.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not counts.get(1) or not counts.get(0):
        return Model([], np.empty(0), frozenset(), np.empty(0))
    share = F.when(F.col("toxic") == 1, min(1.0, per_label / counts[1])).otherwise(min(1.0, per_label / counts[0]))
    chosen = labels.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share * (1 << 30))
    # About two times per_label ids: small enough to be sent to the documents.
    sample = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    sample = sample.groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    sample = materialize(sample, "labelled-sample")
    total = {row["toxic"]: row["n"] for row in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not total.get(1) or not total.get(0):
        return Model([], np.empty(0), frozenset(), np.empty(0))
    terms = _labelled(documents, labels.filter("toxic in (0, 1)")).mapInArrow(_term_counts, "term string, beginning boolean, toxic long, clean long")
    terms = materialize(terms.groupBy("term", "beginning").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).filter("toxic + clean > 1"), "terms")
    all_texts = terms.filter("term = ''").first()
    terms = terms.filter("term <> ''")
    weight = F.log((F.col("toxic") + 0.5) / (all_texts["toxic"] + 1)) - F.log((F.col("clean") + 0.5) / (all_texts["clean"] + 1))
    strong = terms.withColumn("weight", weight).filter((F.col("weight") >= LEAST_WEIGHT) & (F.col("toxic") >= LEAST_DOCUMENTS) & (F.char_length("term") >= 3))
    rank = lambda row: (-row["toxic"] * row["weight"], row["beginning"], -len(row["term"]), row["term"])
    chosen_terms = _lexicon(sorted(strong.collect(), key=rank))
    entries = [(row["term"], row["beginning"]) for row in chosen_terms]

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(entries)
        for batch in batches:
            term, distance = lexicon.matches(batch["term"].to_pylist())
            yield batch.filter(pa.array((term >= 0) & (distance > 0)))

    common = terms.filter("not beginning and clean > 1 and clean > toxic / 4").select("term").mapInArrow(near, "term string")
    ordinary = frozenset(row["term"] for row in common.collect())
    model = Model(entries, np.array([row["weight"] for row in chosen_terms]), ordinary, np.empty(0))
    held = spark.sparkContext.broadcast(model)

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            x = held.value.features(batch["text"])
            yield pa.RecordBatch.from_arrays([batch["toxic"], pa.array(list(x), pa.list_(pa.float64()))], ["toxic", "x"])

    rows = sample.select("text", F.col("toxic").cast("int").alias("toxic")).mapInArrow(featured, "toxic int, x array<double>").toPandas()
    y = rows["toxic"].to_numpy(dtype=float)
    # The sample has its own share of toxic texts; weights of the intercept bring back that of the labels.
    w = _logistic(np.stack(rows["x"].to_numpy()), y)
    w[0] += np.log(counts[1] / counts[0]) - np.log(total[1] / total[0])
    return Model(entries, model.weights, ordinary, w)


def scored(documents: DataFrame, model: Model) -> DataFrame:
    """All rows and columns, and score."""
    held = documents.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])
            yield pd.Series(np.concatenate([held.value.scores(part["text"]) for part in text_slices(iter([batch]))] or [np.empty(0)]))

    return documents.withColumn("score", score("text"))
