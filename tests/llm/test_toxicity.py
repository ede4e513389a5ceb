import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from demandlab.llm.toxicity import Lexicon, Model, matches, matches_in_parts, scored, train

TERMS = [("idiot", False), ("moron", False), ("scum", False), ("lowei", True), ("pathetic", False)]


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        old, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]


def brute(word, most):
    best = (most + 1, -1)
    for k, (term, beginning) in enumerate(TERMS):
        if beginning:
            d = 0 if word.startswith(term) else most + 1
        else:
            d = edits(word, term)
            d = d if len(term) >= 5 or d == 0 else most + 1
        if d <= most:
            best = min(best, (d, k))
    return best


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.text(alphabet="idotmrnscuplwehaé", max_size=9), st.sampled_from(["idiot", "idiots", "idot", "xidiot", "moron", "morn", "loweiä", "lowe", "scum", "scums", "patetic", "pathetics"])), min_size=1, max_size=8), st.sampled_from([1, 2]))
def test_trie_walk_equals_edit_distances(words, most):
    term, distance = matches(words, TERMS, most=most)
    assert [(int(d), int(t)) if t >= 0 else None for t, d in zip(term, distance)] == [b if (b := brute(w, most))[1] >= 0 else None for w in words]


def test_context_tells_quotation_from_abuse():
    model = Model(TERMS, np.full(len(TERMS), 5.0), frozenset({"morn"}), np.array([-3.0, 0.5, 0.5, 0.2, 0.2, -1.0]))
    texts = ["you idiot", "they said “you idiot” once", "you idoit idot", "good morn", "", None, "you idiot moron " + "word " * 50]
    plain, quoted, misspelled, ordinary, empty, null, both = model.features(pa.array(texts))
    assert plain[0] > quoted[0] > 0 and quoted[4] == 1 and plain[4] == 0
    assert misspelled[2] > 0 == misspelled[0]
    assert not ordinary.any() and not empty.any() and not null.any()
    assert both[0] > plain[0]
    scores = model.scores(pa.array(texts))
    assert scores[0] > scores[1] > scores[4] == scores[5]


@pytest.fixture(scope="module")
def corpus(spark):
    random.seed(1)
    common = [f"word{k}" for k in range(300)]
    rows, labels = [], []
    for k in range(400):
        text = random.choices(common, k=random.randint(5, 80))
        if toxic := int(k % 5 == 0):
            text[random.randrange(len(text))] = random.choice(["idiot", "moron", f"loweixx{random.choice('abcdefgh')}", f"loweiyy{random.choice('abcdefgh')}"])
        rows.append((k, " ".join(text), "clash"))
        labels.append((k, toxic))
    rows += [(1000, "an idiot word1", "x"), (1001, "an idjot word1", "x"), (1002, "a loweizzz word2", "x"), (1003, None, "x"), (1004, "", "x"), (None, "word5", "x"), (1000, "an idiot word1", "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, score string"), spark.createDataFrame(labels + [(0, None), (None, 1), (5, 0)], "doc_id long, toxic int")


def test_learns_terms_beginnings_and_misspellings(corpus):
    documents, labels = corpus
    model = train(documents, labels)
    assert ("idiot", False) in model.terms and any(b and t.startswith("lowei"[: len(t)]) for t, b in model.terms)
    rows = scored(documents, model).collect()
    assert len(rows) == 407
    scores = {r.doc_id: r.score for r in rows}
    assert all((scores[k] >= 0.3) == (k % 5 == 0) for k in range(400))
    assert scores[1000] >= 0.3 and scores[1002] >= 0.3 and scores[1001] > scores[1003] == scores[1004]


def test_nothing_to_learn_from(corpus):
    documents, labels = corpus
    for part in (labels.filter("toxic = 2"), labels.filter("toxic = 1")):
        assert {r.score for r in scored(documents, train(documents, part)).collect()} == {0.0}


def test_every_term_over_the_thresholds_is_counted_and_kept(spark):
    random.seed(2)
    common, rare = [f"word{k}" for k in range(100)], [f"{a}{b}{c}zq" for a in "bcdfghjk" for b in "aeiouy" for c in "lmnprstvwx"]
    rows = [(k, " ".join([*random.choices(common, k=5), *rare[10 * k % 480 : 10 * k % 480 + 10]]), 1) for k in range(240)]
    rows += [(k, " ".join(random.choices(common, k=9)), 0) for k in range(240, 2000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = train(frame.select("doc_id", "text"), frame.select("doc_id", "toxic"), per_label=60)
    # 480 terms, of which a sample of 60 texts has few four times.
    assert all(np.asarray(model.nearest(rare)[0]) >= 0)
    assert len(model.terms) > 400


@pytest.mark.parametrize("part", [1, 2, 3, 5])
def test_parts_of_a_lexicon_match_as_the_whole(part):
    words = ["idiot", "idot", "morn", "scum", "loweiä", "patetic", "xyz", "idiots"]
    assert [list(x) for x in matches_in_parts(words, TERMS, [], part)] == [list(x) for x in matches(words, TERMS)]


def swaps_and_edits(a, b):
    d = {(i, -1): i + 1 for i in range(-1, len(a))} | {(-1, j): j + 1 for j in range(-1, len(b))}
    for i in range(len(a)):
        for j in range(len(b)):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i] != b[j]))
            if i and j and a[i] == b[j - 1] and a[i - 1] == b[j]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a) - 1, len(b) - 1]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.text(alphabet="idotmrnscuplwehaé", max_size=10), st.sampled_from(["idiot", "idoit", "diiot", "scmu", "csum", "scam", "patehtci", "pahtetci", "ptahetics", "moorn", "loewi"])), min_size=1, max_size=8))
def test_edits_grow_with_the_term_and_a_swap_is_one(words):
    term, distance = matches(words, TERMS)
    for word, t, d in zip(words, term, distance):
        fits = [(0, k) if b and word.startswith(x) else (swaps_and_edits(word, x), k) for k, (x, b) in enumerate(TERMS) if word.startswith(x) or not b]
        fits = [(e, k) for e, k in fits if e <= (0 if TERMS[k][1] else (len(TERMS[k][0]) >= 4) + (len(TERMS[k][0]) >= 8))]
        assert (int(d), int(t)) == min(fits) if fits else t == -1


def test_long_words_and_swaps():
    term, distance = matches(["idoit", "scmu", "pathteicc", "x" * 5000 + "y", "loewi"], [*TERMS, ("x" * 5000, False)])
    assert list(term) == [0, 2, 4, 5, -1] and list(distance[:4]) == [1, 1, 2, 1]


def test_whole_words_stay_beside_a_beginning_that_covers_them(spark):
    rows = [(k, f"you {['idiot', 'idiots', 'idiotic', 'idiota'][k % 4]} word{k % 50}", 1) for k in range(40)]
    rows += [(k, f"you word{k % 50} word{k % 30}", 0) for k in range(40, 1000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = train(frame.select("doc_id", "text"), frame.select("doc_id", "toxic"))
    assert any(b and "idiot".startswith(t) for t, b in model.terms) and {("idiot", False), ("idiotic", False)} <= set(model.terms)
    assert all(np.asarray(model.nearest(["idjot", "ediot", "idoit", "idoitic"])[0]) >= 0)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.text(alphabet="idotmrnscuplwehaé", max_size=10), st.sampled_from(["idoit", "scmu", "pahtetci", "patehtic", "pathetc", "moorn", "loweier", "x" * 39, "x" * 41])), max_size=8))
def test_the_sieve_loses_no_match(words):
    terms = [*TERMS, ("x" * 40, False), ("é", False)]
    assert [list(x) for x in Lexicon(terms).matches(words)] == [list(x) for x in matches(words, terms)]
