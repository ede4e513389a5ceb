import random
import re
from fractions import Fraction

from demandlab.llm.components import components
from demandlab.llm.jaccard_join import choose_bands, jaccard_join

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def grams(text):
    words = WORD.findall((text or "").lower())
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(docs):
    """(doc_id, class_id, n_links) per row, by comparing all pairs."""
    sets = [grams(text) for _, text in docs]
    near = [[j for j, b in enumerate(sets) if j != i and a and b and 5 * len(a & b) >= 4 * len(a | b)] for i, a in enumerate(sets)]
    group = list(range(len(docs)))
    changed = True
    while changed:
        changed = False
        for i, others in enumerate(near):
            least = min([group[i], *(group[j] for j in others)])
            for k in (i, *others):
                if group[k] != least:
                    group[k], changed = least, True
    ids = lambda g: [docs[i][0] for i in range(len(docs)) if group[i] == g and docs[i][0] is not None]
    return sorted(((docs[i][0], min(ids(group[i]), default=None), len(near[i])) for i in range(len(docs))), key=str)


def varied():
    random.seed(8)
    say = lambda n: [f"w{random.randrange(3000)}" for _ in range(n)]
    docs = [(k, " ".join(say(random.randint(1, 120)))) for k in range(25)]
    for base in range(4):
        text = say(150)
        for k in range(12):
            copy = list(text)
            for _ in range(random.randrange(5)):
                copy[random.randrange(len(copy))] = f"x{random.randrange(3000)}"
            docs.append((100 * base + 200 + k, " ".join(copy)))
    return docs


def found(frame):
    return sorted(((r.doc_id, r.class_id, r.n_links) for r in frame.collect()), key=str)


def test_equals_all_pairs(documents):
    docs = varied()
    docs += [(900, None), (901, ""), (902, "?!"), (903, "?!"), (904, "too few words"), (905, "Too few WORDS!"), (None, docs[0][1]), (None, None), docs[3], docs[3], (5, docs[4][1] + " tail")]
    assert found(jaccard_join(documents(*docs), recall=1 - 1e-9)) == brute(docs)


def test_chunks_of_a_large_group_lose_no_link(documents):
    docs = varied()
    assert found(jaccard_join(documents(*docs), recall=1 - 1e-9, chunk=300)) == brute(docs)


def test_copies_have_one_class_and_count_each_other(documents):
    rows = jaccard_join(documents((3, "One two three four five six."), (1, "one, two three four five six"), (2, "one two three four five six"), (9, "other words here"))).collect()
    assert {r.doc_id: (r.copy_id, r.n_copies, r.n_links) for r in rows} == {1: (1, 3, 2), 2: (1, 3, 2), 3: (1, 3, 2), 9: (9, 1, 0)}


def test_empty_table(documents):
    assert jaccard_join(documents()).collect() == []


def test_bands_reach_the_recall():
    for recall in (0.9, 0.99, 0.9995):
        bands, rows = choose_bands(0.8, recall)
        assert 1 - (1 - 0.8**rows) ** bands >= recall
        assert 1 - (1 - 0.8**rows) ** (bands - 1) < recall
    assert choose_bands(0.8, 0.9995, 5) == (20, 5)
    assert jaccard_join.__defaults__[1] == Fraction(4, 5)


def test_components_of_chains_stars_and_loops(spark):
    links = [(f"{k:03}", f"{k + 1:03}") for k in range(100, 160)] + [("500", "501"), ("502", "500"), ("501", "502"), ("700", "700"), ("800", "801"), ("800", "801")]
    rows = components(spark.createDataFrame(links, "a string, b string")).collect()
    assert {r.node: r.component for r in rows} == {**{f"{k:03}": "100" for k in range(100, 161)}, **{f"{k}": "500" for k in (500, 501, 502)}, "800": "800", "801": "800"}
    assert len(rows) == len({r.node for r in rows})
