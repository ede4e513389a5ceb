"""N-gram Jaccard self-join of texts by MinHash banding.

The n-grams of a text are the set of its runs of five words; a text of fewer
words, but not none, has one n-gram of all of them. Two texts are linked if their
sets' Jaccard similarity is the threshold or more.

1. Texts with equal sets form one class (similarity 1 without a comparison), and
   one row represents it from here on.
2. Rows and bands are chosen for the wanted recall of a pair just at the
   threshold. Representatives meet where a band hash is equal.
3. A pair is verified on its full sets in the first band that it shares, so once.
   A first pass over the band hashes alone finds out who has such a pair where;
   only those send their n-grams there. A large bucket is dealt into chunks by its
   number of n-grams and each two chunks meet by themselves; small buckets share a
   group. So a group's size is bounded whatever a bucket holds.
4. A bucket returns counts and a star of links per text of its linked texts, never
   the pairs.

Cases: texts without a word (null, empty, only signs) are alone; repeated rows
and ties are copies of a class; rows without an id are classed and counted too;
an empty table gives no rows; other columns are ignored. Ties go to smaller ids.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandlab.llm.bloom import build, may_contain
from demandlab.llm.components import components
from demandlab.llm.words import Words, mix, shingles, text_slices
from demandlab.session import materialize

NGRAM, THRESHOLD, RECALL, MOST_ROWS = 5, Fraction(4, 5), 0.9995, 5
#: N-grams in a chunk of a bucket; a group holds two chunks.
CHUNK = 1 << 20
#: Rows without n-grams in a group.
PACK_ROWS = 1 << 16


def choose_bands(threshold: float, recall: float, most_rows: int = MOST_ROWS) -> tuple[int, int]:
    """(bands, rows) so that a pair at the threshold shares a band with probability `recall` at least.

    More rows let fewer unlike pairs meet and need more bands: `most_rows` is the
    most selective choice wanted; fewer rows are taken where 64 bands do not do.
    """
    for rows in range(most_rows, 0, -1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows)) if threshold < 1 else 1
        if bands <= 64 or rows == 1:
            return bands, rows
    raise ValueError("most_rows must be 1 or more")


def _sets(words: Words, ngram: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-grams of each row, sorted within it, and where each row's begin."""
    values, row = shingles(words, ngram)
    order = np.lexsort((values, row))
    values, row = values[order], row[order]
    new = np.ones(len(values), dtype=bool)
    new[1:] = (values[1:] != values[:-1]) | (row[1:] != row[:-1])
    values, row = values[new], row[new]
    return values, np.searchsorted(row, np.arange(words.rows + 1))


def _signing(ngram: int, bands: int, rows: int):
    random = np.random.default_rng(5)
    factors = random.integers(0, 1 << 63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    terms = random.integers(0, 1 << 63, bands * rows, dtype=np.uint64)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """set_key (128 bits of the whole set; null without words), number of n-grams, band hashes."""
        for batch in text_slices(batches):
            values, first = _sets(Words(batch["text"]), ngram)
            n = np.diff(first)
            full = np.flatnonzero(n)
            key = np.zeros((len(n), 2), dtype=np.uint64)
            band = np.zeros((len(n), bands), dtype=np.uint64)
            if len(full):
                at = first[:-1][full]
                for k in range(2):
                    key[full, k] = mix(np.add.reduceat(mix(values + np.uint64(k + 1)), at) + n[full].astype(np.uint64))
                for k in range(bands * rows):
                    least = np.minimum.reduceat(values * factors[k] + terms[k], at)
                    band[full, k // rows] = mix(band[full, k // rows] ^ least) + np.uint64(k)
            keys = [f"{a:016x}{b:016x}" if m else None for (a, b), m in zip(key.tolist(), n)]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1, dtype=np.int32) * bands), pa.array(band.view(np.int64).ravel()))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["row_key"], pa.array(keys, pa.string()), pa.array(n), lists], ["doc_id", "row_key", "set_key", "n", "bands"])

    return sign


def _set_reading(ngram: int, held):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The n-grams of rows that may be wanted."""
        for batch in text_slices(batches):
            wanted = may_contain(held.value, batch["row_key"].to_numpy().view(np.uint64))
            if wanted.any():
                batch = batch.filter(pa.array(wanted))
                values, first = _sets(Words(batch["text"]), ngram)
                lists = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(values.view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch["row_key"], lists], ["row_key", "ngrams"])

    return read


def _may_link(n_a, n_b, threshold: Fraction):
    """Sets so unequal in size can't reach the threshold."""
    return threshold.denominator * np.minimum(n_a, n_b) >= threshold.numerator * np.maximum(n_a, n_b)


def _segments(rows: pd.DataFrame) -> Iterator[tuple[int, int]]:
    """The ranges of rows of each bucket and two chunks; the rows are sorted by them."""
    keys = rows[["bucket", "i", "j"]].to_numpy()
    edges = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(axis=1)))
    return zip(edges, np.append(edges[1:], len(rows)))


def _open_pairs(bands: np.ndarray, n: np.ndarray, chunk: np.ndarray, band: int, across: bool, threshold: Fraction) -> Iterator[tuple[int, int, np.ndarray]]:
    """(low, high, pairs): members low..high against all, True for the pairs that this bucket verifies."""
    order = np.arange(len(n))
    for low in range(0, len(n), 256):
        high = min(len(n), low + 256)
        pairs = order[low:high, None] < order[None, :]
        pairs &= _may_link(n[low:high, None], n[None, :], threshold)
        if across:
            pairs &= chunk[low:high, None] != chunk[None, :]
        for k in range(band):
            pairs &= bands[low:high, k][:, None] != bands[None, :, k]
        yield low, high, pairs


def _who(threshold: Fraction):
    def who(pack: pd.DataFrame) -> pd.DataFrame:
        """The members of the buckets of a pack that have a pair to verify there."""
        pack = pack.sort_values(["bucket", "i", "j"], ignore_index=True)
        bands, n, chunk = np.stack(pack["bands"].to_numpy()), pack["n"].to_numpy(), pack["chunk"].to_numpy()
        band, across = pack["band"].to_numpy(), (pack["i"] != pack["j"]).to_numpy()
        active = np.zeros(len(pack), dtype=bool)
        for a, b in _segments(pack):
            for low, high, pairs in _open_pairs(bands[a:b], n[a:b], chunk[a:b], int(band[a]), bool(across[a]), threshold):
                active[a + low : a + high] |= pairs.any(axis=1)
                active[a:b] |= pairs.any(axis=0)
        return pack.loc[active, ["bucket", "band", "i", "j", "chunk", "set_key"]]

    return who


def _links(values: list[np.ndarray], n: np.ndarray, copies: np.ndarray, blocks, threshold: Fraction) -> tuple[np.ndarray, np.ndarray]:
    """Per member of a bucket: the copies of other members linked to it here, and the first member it leads to."""
    row = np.repeat(np.arange(len(n)), n)
    _, place, times = np.unique(np.concatenate(values), return_inverse=True, return_counts=True)
    shared = times[place] > 1  # what only one member has is in no intersection
    number = np.cumsum(times > 1) - 1
    row, place, width = row[shared], number[place[shared]], int((times > 1).sum())
    first = np.searchsorted(row, np.arange(len(n) + 1))

    def dense(low: int, high: int) -> np.ndarray:
        out = np.zeros((high - low, width), dtype=np.float32)
        out[row[first[low] : first[high]] - low, place[first[low] : first[high]]] = 1
        return out

    step = int(max(1, min(256, (1 << 23) // max(1, width))))
    links, label = np.zeros(len(n), dtype=np.int64), np.arange(len(n))
    for low, high, pairs in blocks:
        if not pairs.any():
            continue
        for a in range(low, high, step):
            b = min(high, a + step)
            left = dense(a, b)
            for c in range(a, len(n), step):
                d = min(len(n), c + step)
                wanted = pairs[a - low : b - low, c:d]
                if not wanted.any():
                    continue
                common = (left @ dense(c, d).T).astype(np.int64)
                linked = wanted & ((threshold.numerator + threshold.denominator) * common >= threshold.numerator * (n[a:b, None] + n[None, c:d]))
                links[a:b] += linked @ copies[c:d]
                links[c:d] += copies[a:b] @ linked
                for x in np.flatnonzero(linked.any(axis=1)):
                    met = np.unique(np.append(label[c:d][linked[x]], label[a + x]))
                    if len(met) > 1:
                        label[np.isin(label, met)] = met[0]
    return links, label


def _verifying(threshold: Fraction):
    def verify(pack: pd.DataFrame) -> pd.DataFrame:
        """Per member and bucket: the rows of other classes linked to it there, and the smallest class it leads to."""
        pack = pack.sort_values(["bucket", "i", "j", "set_key"], ignore_index=True)
        bands, n, chunk, copies = np.stack(pack["bands"].to_numpy()), pack["n"].to_numpy(), pack["chunk"].to_numpy(), pack["copies"].to_numpy()
        band, across, keys, values = pack["band"].to_numpy(), (pack["i"] != pack["j"]).to_numpy(), pack["set_key"].to_numpy(), pack["ngrams"].to_list()
        links, least = np.zeros(len(pack), dtype=np.int64), keys.copy()
        for a, b in _segments(pack):
            blocks = _open_pairs(bands[a:b], n[a:b], chunk[a:b], int(band[a]), bool(across[a]), threshold)
            links[a:b], label = _links(values[a:b], n[a:b], copies[a:b], blocks, threshold)
            least[a:b] = keys[a:b][label]
        out = pd.DataFrame({"set_key": keys, "links": links, "least": least})
        return out[out["links"] > 0]

    return verify


def _pack(packs: int):
    """Buckets are dealt into packs, which are the groups: most buckets are far too small for one of their own."""
    return F.pmod(F.xxhash64("bucket", "i", "j"), F.lit(packs)).alias("pack")


def jaccard_join(documents: DataFrame, ngram: int = NGRAM, threshold: Fraction = THRESHOLD, recall: float = RECALL, most_rows: int = MOST_ROWS, chunk: int = CHUNK) -> DataFrame:
    """Per document row: doc_id, n_ngrams, copy_id (the smallest id with the same n-grams), n_copies, class_id
    (the smallest id that links lead to), n_links (other rows of the threshold's similarity or more), and row_key and
    class_key (null without words), which name the row's content and its class also where ids are null."""
    spark = documents.sparkSession
    threshold = Fraction(threshold).limit_denominator(1000)
    bands, rows = choose_bands(float(threshold), recall, most_rows)
    documents = documents.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("row_key"))
    kind = documents.schema["doc_id"].dataType.simpleString()
    signed = materialize(documents.mapInArrow(_signing(ngram, bands, rows), f"doc_id {kind}, row_key long, set_key string, n long, bands array<long>"), "signatures")
    classes = materialize(
        signed.filter("set_key is not null").groupBy("set_key").agg(F.min(F.struct("doc_id", "row_key")).alias("r"), F.min("doc_id").alias("copy_id"), F.count("*").alias("copies"), F.max("n").alias("n"), F.max("bands").alias("bands"))
        .select("set_key", "copy_id", "copies", "n", "bands", F.col("r.row_key").alias("row_key")),
        "classes",
    )
    places = classes.select("set_key", "n", F.posexplode("bands").alias("band", "hash")).select("set_key", "n", "band", F.xxhash64("band", "hash").alias("bucket"))
    crowded = places.groupBy("bucket").agg(F.count("*").alias("members"), F.sum(F.col("n") + 64).alias("weight")).filter("members > 1")
    crowded = crowded.select("bucket", F.ceil(F.col("weight") / chunk).cast("int").alias("chunks"))
    members = materialize(places.select("set_key", "band", "bucket").join(crowded, "bucket"), "members")
    members = members.withColumn("chunk", F.pmod(F.hash("set_key", "bucket"), "chunks")).join(classes.select("set_key", "n", "bands"), "set_key")
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other")
    members = members.select("set_key", "n", "bands", "band", "bucket", "chunk", other).withColumns({"i": F.least("chunk", "other"), "j": F.greatest("chunk", "other")})
    spread = int(spark.conf.get("spark.sql.shuffle.partitions"))
    packs = max(spread, math.ceil(members.count() / PACK_ROWS))
    wanted = materialize(members.groupBy(_pack(packs)).applyInPandas(_who(threshold), "bucket long, band int, i int, j int, chunk int, set_key string"), "members-with-pairs")
    # The sets of those alone: found again in the texts by a filter of fixed size, then exactly.
    rows_wanted = classes.join(wanted.select("set_key").distinct(), "set_key", "left_semi").select("set_key", "row_key", "n", "bands", "copies")
    held = spark.sparkContext.broadcast(build(rows_wanted, F.col("row_key")))
    sets = documents.select("row_key", "text").mapInArrow(_set_reading(ngram, held), "row_key long, ngrams array<long>")
    sets = materialize(rows_wanted.join(sets, "row_key").dropDuplicates(["set_key"]), "ngram-sets")
    joined = wanted.join(sets, "set_key")
    packs = max(spread, math.ceil((wanted.join(sets.select("set_key", "n"), "set_key").agg(F.sum("n")).first()[0] or 0) / chunk))
    found = joined.groupBy(_pack(packs)).applyInPandas(_verifying(threshold), "set_key string, links long, least string")
    found = materialize(found, "links")
    labelled = components(found.select(F.col("set_key").alias("a"), F.col("least").alias("b")))
    links = found.groupBy("set_key").agg(F.sum("links").alias("links"))
    labels = classes.select("set_key", "copy_id", "copies").join(labelled.withColumnRenamed("node", "set_key"), "set_key", "left").join(links, "set_key", "left")
    labels = materialize(labels.select("set_key", "copy_id", "copies", F.coalesce("component", "set_key").alias("component"), F.coalesce("links", F.lit(0).cast("long")).alias("links")), "labels")
    least = labels.groupBy("component").agg(F.min("copy_id").alias("class_id"))
    labels = labels.join(least, "component").select("set_key", "copy_id", "copies", "class_id", "links", F.col("component").alias("class_key"))
    return _rows(signed, labels)


def _rows(signed: DataFrame, labels: DataFrame) -> DataFrame:
    """Every document row with what its class has found; rows without words are alone and need no join."""
    with_words = signed.filter("set_key is not null").select("doc_id", "row_key", "set_key", "n").join(labels, "set_key")
    columns = ["doc_id", "row_key", F.col("n").alias("n_ngrams"), "copy_id", F.col("copies").alias("n_copies"), "class_id", (F.col("links") + F.col("copies") - 1).alias("n_links"), "class_key"]
    alone = signed.filter("set_key is null").select("doc_id", "row_key", F.lit(0).cast("long"), "doc_id", F.lit(1).cast("long"), "doc_id", F.lit(0).cast("long"), F.lit(None).cast("string"))
    return with_words.select(*columns).union(alone)
