import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from demandlab.llm.words import SLICE_BYTES, Words, shingles, span_hashes, text_slices

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TEXT = st.text(alphabet="aB1_ .éЖ語\n'", max_size=40)


def plain(text):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT), max_size=6))
def test_words_are_those_of_the_pattern(texts):
    words = Words(pa.array(texts, pa.string()))
    assert [words.texts(words.first[i], words.first[i + 1]) for i in range(len(texts))] == [plain(t) for t in texts]


def test_slices_of_a_column_give_the_same_words_and_hashes():
    column = pa.array(["one two", None, "", "two one", "one"])
    whole, part = Words(column), Words(column.slice(3))
    assert whole.hashes()[2:].tolist() == part.hashes().tolist()
    assert len(set(whole.hashes().tolist())) == 2


def test_equal_runs_have_equal_hashes_within_rows_only():
    words = Words(pa.array(["a b c d", "b c", None, "c d a b", "z"]))
    values, rows = shingles(words, 2)
    runs = [tuple(w[i : i + 2]) for t in ("a b c d", "b c", "", "c d a b") if (w := t.split()) for i in range(len(w) - 1)] + [("z",)]
    assert rows.tolist() == [0, 0, 0, 1, 3, 3, 3, 4]
    assert len(set(values.tolist())) == len(set(runs))
    assert all((runs[i] == runs[j]) == (values[i] == values[j]) for i in range(8) for j in range(8))


def test_batches_are_cut_between_rows_and_lose_none():
    most = SLICE_BYTES * 3 // 4  # two such texts do not fit into one slice, one and a short one do
    batch = pa.RecordBatch.from_pydict({"text": ["x" * most, None, "y" * most, "z", "", "w" * 3 * SLICE_BYTES]})
    parts = list(text_slices(iter([batch])))
    assert [len(p) for p in parts] == [2, 3, 1]
    assert np.concatenate([p["text"].to_pylist() for p in parts]).tolist() == batch["text"].to_pylist()


def test_spans_side_by_side_have_the_hashes_of_lone_spans():
    data = np.random.default_rng(3).integers(0, 256, 5000).astype(np.uint8)
    starts = np.unique(np.append(0, np.random.default_rng(4).integers(0, 5000, 700)))
    ends = np.append(starts[1:], 5000)
    alone = [span_hashes(data, starts[k : k + 1], ends[k : k + 1])[0] for k in range(len(starts))]
    assert span_hashes(data, starts, ends).tolist() == alone
    assert span_hashes(data, starts[::2], ends[::2]).tolist() == alone[::2]
