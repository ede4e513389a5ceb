import random
import re
from collections import Counter

import pytest

from demandlab.llm import phrase_counting, words
from demandlab.llm.phrase_counting import collocations, frequent_phrases


def lower(text):
    return "".join(c.lower() if c.isascii() else c for c in text or "")


def plain(rows, longest, threshold, best):
    """Every phrase counted, and every cut and every longer phrase tried."""
    n, f = Counter(), Counter()
    for lang, text in ((lang if lang is not None else "und", text) for lang, text in rows):
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, tuple(w[i : i + k])) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    candidates = {key: a for key, a in f.items() if a >= threshold and len(key[1]) > 1}
    inside = lambda short, long: any(long[i : i + len(short)] == short for i in range(len(long) - len(short) + 1))
    out = []
    for (lang, w), a in candidates.items():
        if any(m == lang and len(x) > len(w) and c >= a and inside(w, x) for (m, x), c in candidates.items()):
            continue
        cuts = [(1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        out.append((lang, " ".join(w), a, f[lang, w[:k]], f[lang, w[k:]], n[lang], score))
    ranked, seen = [], Counter()
    for lang, phrase, a, l, r, m, score in sorted(out, key=lambda x: (x[0], -x[6], -x[2], x[1].encode())):
        seen[lang] += 1
        if seen[lang] <= best:
            ranked.append((lang, seen[lang], phrase, a, l, r, m, score))
    return sorted(ranked)


def corpus(seed, n):
    random.seed(seed)
    common = ["new", "york", "ÉTÉ", "Été", "语", "of", "the", "the", "of", "x-1"]
    say = lambda: "".join(random.choice(common + ["rare%d" % random.randint(0, 40)]) + random.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r"]) for _ in range(random.randint(0, 30)))
    fixed = "Kind regards from the new york office team. "
    rows = [(random.choice(["en", "fr", None]), say() + random.choice(["", fixed]) + say()) for _ in range(n)]
    return rows + [("en", None), (None, ""), ("de", " .,\t "), rows[0], rows[0], ("", "a b a b"), ("und", "new york")]


@pytest.fixture
def frame(spark):
    def make(rows):
        rows = [(k if k % 7 else None, lang, text, 0.5, "x", 3) for k, (lang, text) in enumerate(rows)]
        return spark.createDataFrame(rows, "doc_id long, lang string, text string, n double, phrase string, shard int")

    return make


@pytest.mark.parametrize("seed, shards, slots, threshold, best", [(1, 1, 1 << 16, 3, 50), (2, 2, 1 << 16, 4, 2000), (3, 3, 4, 3, 7)])
def test_equal_to_counting_every_phrase(frame, monkeypatch, seed, shards, slots, threshold, best):
    monkeypatch.setattr(phrase_counting, "LEAST_SLOTS", slots)
    monkeypatch.setattr(phrase_counting, "MOST_SLOTS", slots)
    rows = corpus(seed, 50)
    expected = plain(rows, 5, threshold, best)
    assert sorted(map(tuple, collocations(frame(rows), threshold=threshold, shards=shards, best=best).collect())) == expected
    assert len(expected) > 10


def test_lengths_are_interleaved(frame, monkeypatch):
    """Phrases of frequent words are counted while the circle of the words goes on, and each for one circle."""
    seen = []
    counted = phrase_counting._counted
    monkeypatch.setattr(phrase_counting, "_counted", lambda sizes, step, shards, held: seen.append((step, sizes)) or counted(sizes, step, shards, held))
    phrases, _ = frequent_phrases(frame([("en", "one two three four five six")] * 600), threshold=50, shards=3)
    assert (1, [0, 1, 2]) in seen and (2, [0, 1, 2, 3]) in seen and (3, [2, 3, 4]) in seen
    assert {r["n"] for r in phrases.collect()} == {600} and phrases.count() == 6 + 5 + 4 + 3 + 2


def test_counts_beyond_64_bits_are_exact(spark, monkeypatch):
    a, n = 3_000_000_001, 4_000_000_000_000_001
    phrases = spark.createDataFrame([("en", "new york", 2, a), ("en", "new", 1, a + 7), ("en", "york", 1, a + 13)], "lang string, phrase string, size int, n long")
    languages = spark.createDataFrame([("en", n)], "lang string, n long")
    monkeypatch.setattr(phrase_counting, "frequent_phrases", lambda *args: (phrases, languages))
    assert [r["score"] for r in collocations(None).collect()] == [1000 * a * n // ((a + 7) * (a + 13))]


def test_long_texts_slices_and_an_empty_table(frame, monkeypatch):
    monkeypatch.setattr(words, "SLICE_BYTES", 100)
    monkeypatch.setattr(phrase_counting, "HELD", 500)
    random.seed(6)
    rows = corpus(5, 30) + [("en", " ".join(random.choice(["of", "the", "new", "york", "w%d" % random.randint(0, 300)]) for _ in range(60_000)))]
    assert sorted(map(tuple, collocations(frame(rows), threshold=20).collect())) == plain(rows, 5, 20, 2000)
    assert collocations(frame([])).collect() == []


def test_counts_joined_to_frequent_phrases_are_the_same(spark, monkeypatch):
    from demandlab.llm import phrase_counting

    rows = [(k, "en", "a b c d. a b c, x y") for k in range(6)]
    table = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    found = lambda: sorted(map(tuple, phrase_counting.frequent_phrases(table, threshold=5)[0].collect()))
    sent = found()
    monkeypatch.setattr(phrase_counting, "MOST_SENT", 0)
    assert found() == sent and ("en", "a b c d", 4, 6) in sent
