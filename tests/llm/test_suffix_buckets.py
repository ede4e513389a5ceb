import hashlib
import random
from collections import Counter

import pytest

from demandlab.llm.queries import QUERIES
from demandlab.llm.suffix_buckets import without_repeats

SF = "/root/testdata/sf0.001"


def plain(texts, length):
    """What is left of each text, and the removed spans, by counting every string."""
    texts = [(t or "").encode() for t in texts]
    times = Counter(t[p : p + length] for t in texts for p in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for p in range(len(t) - length + 1):
            if times[t[p : p + length]] > 1:
                gone[p : p + length] = b"\1" * length
        edges = [p for p in range(len(t) + 1) if (gone[p - 1] if p else 0) != (gone[p] if p < len(t) else 0)]
        out.append((bytes(b for b, g in zip(t, gone) if not g), list(zip(edges[::2], edges[1::2]))))
    return out


def found(frame):
    return [(r["row"]["doc_id"], bytes(r["kept"]), [tuple(s) for s in r["spans"]], r["n_bytes"]) for r in frame.collect()]


def check(documents, texts, **options):
    length = options.get("length", 200)
    rows = found(without_repeats(documents(*enumerate(texts)), **options))
    expected = [(k, kept, spans, len((t or "").encode())) for k, (t, (kept, spans)) in enumerate(zip(texts, plain(texts, length)))]
    assert sorted(rows) == sorted(expected)


def corpus(seed, n, alphabet="ab éЖ"):
    random.seed(seed)
    say = lambda size: "".join(random.choice(alphabet) for _ in range(size))
    shared = [say(random.randint(10, 90)) for _ in range(4)]
    texts = [say(random.randint(0, 60)) + "".join(random.choice([say(5), random.choice(shared), random.choice(shared)[random.randint(0, 20) :]]) for _ in range(random.randint(0, 6))) for _ in range(n)]
    return texts + [None, "", "x" * 300, "xy" * 70, texts[0], texts[0], shared[1] * 3]


@pytest.mark.parametrize("seed, length, gram, blocks", [(1, 20, 8, (4, 1)), (2, 21, 5, (1,)), (3, 33, 33, (8, 1)), (4, 24, 8, (16, 5, 1))])
def test_equal_to_counting_every_string(documents, seed, length, gram, blocks):
    check(documents, corpus(seed, 60), length=length, gram=gram, blocks=blocks)


def test_a_passage_of_a_third_of_all_documents_in_changing_surroundings(documents, monkeypatch):
    from demandlab.llm import row_filters

    monkeypatch.setattr(row_filters, "MOST_BITS", 0)  # without filters in front of the joins
    random.seed(9)
    word = lambda: "".join(random.choice("abcdefgh") for _ in range(6))
    passage = " ".join(word() for _ in range(40))
    near = [word() for _ in range(60)]
    texts = [" ".join([word(), passage[random.randint(0, 40) :], word()]) for _ in range(40)]
    texts += [" ".join(near[:k] + [word()] + near[k + 1 :]) for k in range(0, 60, 3)] + [" ".join(word() for _ in range(60)) for _ in range(60)]
    check(documents, texts)


def test_a_long_text_is_cut_whole(documents):
    random.seed(4)
    long = "".join(random.choice("abcdefghij ") for _ in range(3_000_000))
    rows = dict((r[0], r) for r in found(without_repeats(documents((1, long), (2, long[1_000_000:1_000_300]), (3, "é" * 100 + long[-199:])))))
    assert rows[1][2] == [(1_000_000, 1_000_300)] and rows[1][1] == (long[:1_000_000] + long[1_000_300:]).encode()
    assert rows[2][1:3] == (b"", [(0, 300)])
    assert rows[3][2] == []


def test_empty_table_and_clashing_names(spark, documents):
    assert without_repeats(documents()).collect() == []
    rows = spark.createDataFrame([(1, "t" * 250, 5, 6, "k"), (1, "t" * 250, 5, 6, "k"), (None, None, 0, 0, None)], "doc_id long, text string, n_bytes int, lo int, spans string")
    out = without_repeats(rows).orderBy("row.doc_id").collect()
    assert [(tuple(r["row"]), r["n_bytes"], [tuple(s) for s in r["spans"]]) for r in out] == [((None, None, 0, 0, None), 0, [])] + [((1, "t" * 250, 5, 6, "k"), 250, [(0, 250)])] * 2


def test_query_equals_counting_every_string(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    expected = []
    for row, (kept, spans) in zip(rows, plain([r["text"] for r in rows], 200)):
        n = len((row["text"] or "").encode())
        expected.append((row["doc_id"], n, n - len(kept), len(spans), hashlib.sha256(kept).hexdigest()))
    columns = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    frame = QUERIES["op11_suffix_buckets"](spark, SF).select(*columns)
    assert sorted(map(tuple, frame.collect())) == sorted(expected)
    assert sum(row[2] for row in expected) > 0
