import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from demandlab.llm.queries import tokenizer_file
from demandlab.llm.sentencepiece_lattice import best_path, read_pieces
from tests.llm.test_decontamination import brute as contaminated
from tests.llm.test_jaccard_join import brute as grouped
from tests.llm.test_secret_ledger import brute as spans

VOICES = {"en": "the and thing with other than from have which would".split(), "de": "der und schön nicht ich über größe wäre dass auch".split()}
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row_key string"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Rows of every kind that a stage rejects, and clean ones."""
    random.seed(6)
    folder = tmp_path_factory.mktemp("corpus")
    say = lambda lang, n: " ".join(random.choice(VOICES[lang]) + random.choice(["", "", "a", "en", "st"]) for _ in range(n))
    rows = []
    for k in range(120):
        lang = random.choice(list(VOICES))
        rows.append((k, say(lang, random.randint(20, 90)), lang))
    item = say("en", 30)
    rows += [(200, rows[3][1], "en"), (201, ''.join(c.upper() if c.isascii() else c for c in rows[3][1]), None), (202, rows[5][1] + " tail", "de"), rows[7], rows[7]]
    rows += [(300, say("en", 20) + " " + item, "en"), (301, say("de", 30) + " password = hunter2hunter2", "de"), (302, "12345 !!", "en"), (303, None, "en"), (304, "", None), (305, "???", "de")]
    rows += [(None, say("en", 40), None), (400, say("de", 40) + " token=abc", "de")]
    frame = spark.createDataFrame([(d, t, lang, "s", len(t or ""), "own") for d, t, lang in rows], SCHEMA)
    frame.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, folder)
        out.write.mode("overwrite").parquet(f"{folder}/out-{k}")
        yield name, docs, (docs := spark.read.parquet(f"{folder}/out-{k}"))


def key(row):
    return str((row.doc_id, row.text))


def test_every_stage_against_brute_force(spark, corpus):
    seen = []
    for name, before, after in stages(spark, corpus):
        rows, kept = before.collect(), after.collect()
        seen.append(name)
        if name != "sentencepiece":
            assert after.schema == before.schema
        if name == "language_id":
            assert {r.doc_id for r in rows} - {r.doc_id for r in kept} == {302, 303, 304, 305}
        elif name == "jaccard_join":
            groups = {}
            for doc_id, class_id, _ in grouped([(r.doc_id, r.text) for r in rows]):
                groups.setdefault(class_id if doc_id is not None else "no id", doc_id)
            assert sorted(map(str, (r.doc_id for r in kept))) == sorted(map(str, (None if g == "no id" else g for g in groups)))
            assert not {200, 201, 202} & {r.doc_id for r in kept} and sum(r.doc_id == 7 for r in kept) == 1
        elif name == "decontamination":
            bad = {d for d, *_, flag in contaminated([(r.doc_id, r.text) for r in rows], [(1, spark.read.parquet(f"{corpus}/benchmark.parquet").first().text)]) if flag}
            assert bad == {300} and sorted(map(key, kept)) == sorted(key(r) for r in rows if r.doc_id not in bad)
        elif name == "secret_ledger":
            assert sorted(map(key, kept)) == sorted(key(r) for r in rows if not spans(r.text)) and len(rows) - len(kept) == 1
        else:
            pieces = read_pieces(tokenizer_file("piece_bpe_32k.model"))
            assert len(kept) == len(rows) and all(r.ids == best_path(" " + r.text, pieces) and r.n_tokens == len(r.ids) for r in kept)
    assert seen == ["language_id", "jaccard_join", "decontamination", "secret_ledger", "sentencepiece"]


def test_run_gives_the_rows_of_the_stages(spark, corpus):
    whole = corpus_pipeline.run(spark, corpus)
    *_, (_, _, last) = stages(spark, corpus)
    rows = lambda frame: sorted(map(str, frame.select("doc_id", "text", "ids").collect()))
    assert rows(whole) == rows(last)


def test_empty_documents(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).filter(F.lit(True)).collect() == []
