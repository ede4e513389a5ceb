import zlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from demandlab.llm.sentencepiece_lattice import best_path, crc32_batches, decode_texts, encode_texts, read_pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    "Hello  wörld\n  x\ty ", "", None, "été, \"quoted\" (a_b) -- 12.5%", "語語語 русский \U0001f600\u0001", "   ", " lead", "a.b,c;d", "under_score__x _ y", "the the the",
    "x" * 700, "aaaa bbbb " * 50, "▁literal▁ sign", "a▁ b", "².5 ½",
]


@pytest.fixture(scope="module")
def pieces():
    return read_pieces(MODEL)


@pytest.mark.parametrize("options", [{}, {"most_units": 4}, {"longest": 3}])
def test_ids_are_those_of_the_best_path_over_the_whole_text(spark, documents, pieces, options):
    rows = [(k, t) for k, t in enumerate(TEXTS)] + [(None, TEXTS[0]), (3, TEXTS[3])]
    found = decode_texts(encode_texts(documents(*rows), pieces, then=crc32_batches, added="ids_crc32 long", **options), pieces, "back")
    for row in found.collect():
        assert row.ids == (best_path(" " + row.text, pieces) if row.text else [])
        assert row.back == (row.text or "").replace("▁", " ")
        assert row.score == 7.0 and row.ids_crc32 == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in row.ids))
    assert found.count() == len(rows)


def test_best_path_is_the_best_of_all(pieces):
    def all_paths(unit):
        if not unit:
            yield 0.0, ()
        for n in range(1, len(unit) + 1):
            if unit[:n] in pieces.scores:
                i, s = pieces.scores[unit[:n]]
                for score, rest in all_paths(unit[n:]):
                    yield s + score, (i, *rest)

    for unit in ("▁thing", "▁the", "nation", "▁a", "heron"):
        best = max(score for score, _ in all_paths(unit))
        ids = best_path(unit, pieces)
        assert sum(pieces.scores[pieces.by_id[i]][1] for i in ids) == best
        assert "".join(pieces.by_id[i] for i in ids) == unit


def test_empty_table(documents, pieces):
    assert encode_texts(documents(), pieces).filter(F.size("ids") > 0).collect() == []


def test_any_ids_decode(spark, pieces):
    rows = spark.createDataFrame([(1, [pieces.bytes[0xC3]]), (2, []), (3, None), (4, best_path(" é語 x", pieces))], "doc_id int, ids array<int>")
    assert {r.doc_id: r.decoded for r in decode_texts(rows, pieces).collect()} == {1: "\ufffd", 2: "", 3: "", 4: "é語 x"}
