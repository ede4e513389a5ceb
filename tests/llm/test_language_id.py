import random

import pytest

from demandlab.llm.language_id import UNKNOWN, identify, remainder, train

VOICES = {"en": ["the", "and", "thing", "with", "other"], "de": ["der", "und", "schön", "nicht", "ich"], "fr": ["le", "être", "où", "avec", "ça"]}


@pytest.fixture(scope="module")
def rows(spark):
    random.seed(5)
    out = [(k, " ".join(random.choices(VOICES[lang], k=random.randint(3, 60))), lang, "clash") for k in range(300) for lang in [random.choice(list(VOICES))]]
    out += [(900, None, "en", ""), (901, "", "en", ""), (902, "12 34 !?", None, ""), (903, "und nicht", None, ""), (None, "the other", None, ""), (0, out[0][1], out[0][2], ""), (904, "der " * 20000, None, "")]
    return spark.createDataFrame(out, "doc_id long, text string, lang string, score string")


def test_held_out_texts_are_recognised(rows):
    model = train(rows.filter(remainder("doc_id", 3) != 1))
    found = identify(rows, model).collect()
    assert len(found) == 307 and model.labels == ["de", "en", "fr"]
    held = [r for r in found if r.doc_id is not None and r.doc_id < 300]
    assert sum(r.lang_pred == r.lang for r in held) >= 0.98 * len(held)
    by_id = {r.doc_id: r for r in found}
    for k in (900, 901, 902):
        assert (by_id[k].lang_pred, by_id[k].score) == (UNKNOWN, 0.0)
    assert by_id[903].lang_pred == by_id[904].lang_pred == "de" and by_id[None].lang_pred == "en"
    assert all(0 <= r.score <= 1 for r in found)


def test_sample_is_bounded_and_training_repeats(rows):
    small, again = train(rows, per_language=30), train(rows, per_language=30)
    assert (small.weights == again.weights).all() and small.temperature == again.temperature
    assert (small.weights == 0).mean() > 0.9


def test_nothing_to_learn_from(rows):
    model = train(rows.filter("doc_id > 5000"))
    assert {(r.lang_pred, r.score) for r in identify(rows, model).collect()} == {(UNKNOWN, 0.0)}
