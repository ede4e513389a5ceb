import random
import zlib

import numpy as np
import public_tokenizers
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from demandlab.llm.repair_files import compress, document_slice, expand, expand_shard, expansions, ids_between, packed, read_documents, unpacked, word_cuts, write_shards

FILE = public_tokenizers.path("byte_bpe_50k.json")


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), min_size=1, max_size=60), min_size=1, max_size=8))
def test_grammar_gives_back_every_id(docs):
    ids, lengths = np.array(sum(docs, [])), [len(d) for d in docs]
    last = np.zeros(len(ids), dtype=bool)
    last[np.cumsum(lengths) - 1] = True
    symbols, last, rules = compress(ids, last, 100, least=2)
    assert expand(symbols, rules, 100).tolist() == ids.tolist()
    sizes = expansions(rules, 100)
    assert sizes.tolist() == [len(expand(np.array([100 + k]), rules, 100)) for k in range(len(rules))]
    at = np.append(0, np.flatnonzero(last) + 1)
    for k, doc in enumerate(docs):
        own = symbols[at[k] : at[k + 1]]
        assert expand(own, rules, 100).tolist() == doc
        assert ids_between(own, rules, sizes, 100, 1, len(doc) - 1).tolist() == doc[1:-1]


def test_no_frequent_pair_is_left():
    rng = np.random.default_rng(5)
    said = rng.integers(0, 3000, (40, 200))
    ids = np.concatenate([said[k] if k < 40 else rng.integers(0, 3000, 30) for k in rng.integers(0, 60, 1500)] + [np.full(5000, 7)])
    last = np.zeros(len(ids), dtype=bool)
    last[rng.integers(0, len(ids), 50)] = last[-1] = True
    symbols, ends, rules = compress(ids, last, 3000, least=8)
    assert expand(symbols, rules, 3000).tolist() == ids.tolist()
    assert expansions(rules, 3000).max() >= 100  # a passage said again and again is one symbol, or few
    code = (symbols[:-1] << 32 | symbols[1:])[~ends[:-1]]
    run = np.append(False, (code[1:] == code[:-1]) & (symbols[1:][~ends[:-1]][1:] == symbols[:-1][~ends[:-1]][1:]))
    assert np.unique(code[~run], return_counts=True)[1].max() < 8


def test_symbols_of_every_width():
    for width, top in ((2, 1 << 16), (3, 1 << 24), (4, 1 << 31)):
        symbols = np.array([0, 1, top - 1, 300], dtype=np.int64)
        assert len(packed(symbols, width)) == 4 * width and unpacked(packed(symbols, width), width).tolist() == symbols.tolist()


def texts():
    random.seed(2)
    say = lambda n: " ".join(random.choice(["the", "cat", "sat,", "on", "x1", "été", "語語", "don't"]) for _ in range(n))
    rows = [(k, say(random.randint(0, 80))) for k in range(60, 0, -1)]
    odd = ["a  b   c ", "\n\n x\t y \n", " lead", "tail ", "   ", "a b  c 　d \x1c e", "<|endoftext|> a <|endoftext|>b", "it's we'll  'tis 12 34", "x" * 5000, "語" * 500, "\U0001f600 \U0001f600", "", None, "a \x85b", "x<|endoftext|>, y(z)\n\nw;\tq", "a's,'t b.c\r\nd"]
    return rows + [(100 + k, t) for k, t in enumerate(odd)] + [(None, "no id"), (500, "again"), (500, "again"), (7, "other text of a used id")]


def check(spark, documents, path, **options):
    rows = texts()
    write_shards(documents(*rows), path, FILE, **options)
    found = [tuple(r) for r in read_documents(spark, path).orderBy("start").collect()]
    tokenizer, start, expected = Tokenizer.from_file(FILE), 0, []
    # Spark's hash of a text, by which the rows of one id are ordered.
    key = lambda t: 42 if t is None else np.uint64(xxhash.xxh64_intdigest(t.encode(), 42)).astype(np.int64).item()
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, key(r[1]))):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        expected.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert found == expected


def test_files_hold_what_the_library_encodes(spark, documents, tmp_path):
    check(spark, documents, str(tmp_path / "a"))


def test_small_shards_and_tasks_that_forget(spark, documents, tmp_path):
    check(spark, documents, str(tmp_path / "b"), shard_ids=300, sample=5)
    tokenizer = Tokenizer.from_file(FILE)
    rows = dict(texts()[:60])
    ids = tokenizer.encode(rows[33], add_special_tokens=False).ids
    assert document_slice(spark, str(tmp_path / "b"), 33, 3, 9) == ids[3:9]
    files = spark.read.parquet(str(tmp_path / "b"))
    inside = files.selectExpr("low", "high", "array_min(filter(doc_id, x -> x is not null)) as a", "array_max(doc_id) as b")
    assert files.count() > 5 and inside.filter("not (low <=> a and high <=> b)").count() == 0


def test_empty_table(spark, documents, tmp_path):
    write_shards(documents(), str(tmp_path / "c"), FILE)
    assert read_documents(spark, str(tmp_path / "c")).collect() == []


def test_a_task_that_forgets_units_encodes_them_again(monkeypatch):
    import pyarrow as pa

    from demandlab.llm import unit_table

    monkeypatch.setattr(unit_table, "REMEMBERED", 3)
    encoder = unit_table.TaskEncoder(lambda texts: unit_table.flattened([[ord(c) for c in t] for t in texts]), unit_table.Table(unit_table.Units(pa.array(["a"]), word_cuts()).hashes, np.array([1]), np.array([ord("a")])))
    for text in ("a b c", "b d e f g", "a b", "", "a a c g"):
        ids, first = encoder(unit_table.Units(pa.array([text, None]), word_cuts()))
        assert ids.tolist() == [ord(c) for c in text] and first.tolist() == [0, len(text), len(text)]


def test_a_round_costs_what_it_looks_at(monkeypatch):
    """After the first rounds few places are looked at, and pairs sharing a bin do not wait for another round."""
    from demandlab.llm import repair_files

    looked, frequent = [], repair_files._frequent
    monkeypatch.setattr(repair_files, "_frequent", lambda code, least: looked.append(len(code)) or frequent(code, least))
    ids = np.random.default_rng(6).zipf(1.3, 200_000) % 3000
    last = np.zeros(len(ids), dtype=bool)
    last[999::1000] = True
    compress(ids, last, 3000)
    assert sum(looked) < 4 * len(ids)
    monkeypatch.undo()
    codes = np.random.default_rng(7).integers(0, 4000, 20_000)
    monkeypatch.setattr(repair_files, "BIN_BITS", 2)  # all bins are shared, the last pairs are sorted
    at, number, values = frequent(codes, 5)
    found, times = np.unique(codes, return_counts=True)
    assert sorted(values.tolist()) == found[times >= 5].tolist()
    assert values[number].tolist() == codes[at].tolist() and len(at) == times[times >= 5].sum()


def test_a_process_loads_the_library_once_and_joins_plain_units():
    """The tokenizer is not read again by every task, and units are told apart without a search in each."""
    from demandlab.llm import repair_files

    tokenizer, special, encode = repair_files._library(FILE)
    assert repair_files._library(FILE)[0] is tokenizer and special == (b"<|endoftext|>",)
    units = [" word", "word", " x1", "don't", " ", "\n", "\nword", "a\n", "語", " 語語", "\x85b", "<|endoftext|>", "a<|endoftext|>", " \u3000x", "²", "!"] * 70
    lengths, flat = encode(units)
    own = [tokenizer.encode(unit, add_special_tokens=False).ids for unit in units]
    assert lengths.tolist() == [len(ids) for ids in own] and flat.tolist() == sum(own, [])


def test_distinct_units_are_hashed_once(monkeypatch):
    """Hashes are taken of distinct units only, and each unit knows its own."""
    import pyarrow as pa

    from demandlab.llm import unit_table

    hashed, hashes_of = [], unit_table.span_hashes
    monkeypatch.setattr(unit_table, "span_hashes", lambda data, starts, ends: hashed.append(len(starts)) or hashes_of(data, starts, ends))
    units = unit_table.Units(pa.array(["a b a b a", None, "", "a é b"]).slice(0), word_cuts())
    text, hashes, number = units.distinct()
    assert hashed == [4] and sorted(text.to_pylist()) == [" a", " b", " é", "a"]
    assert [text.to_pylist()[k] for k in number] == ["a", " b", " a", " b", " a", "a", " é", " b"]
    assert (np.diff(hashes.astype(object)) > 0).all() and hashes[number].tolist() == units.hashes.tolist()
    assert unit_table.Units(pa.array([], pa.string()), word_cuts()).distinct()[0].to_pylist() == []


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 2), min_size=1, max_size=200))
def test_shards_are_expanded_by_copies(ids):
    last = np.zeros(len(ids), dtype=bool)
    last[len(ids) // 2] = last[-1] = True
    symbols, _, rules = compress(np.array(ids), last, 3, least=2)
    assert expand_shard(symbols, rules, 3, expansions(rules, 3)).tolist() == ids


def test_rules_are_expanded_once(monkeypatch):
    from demandlab.llm import repair_files

    asked = []
    monkeypatch.setattr(repair_files, "expand", lambda symbols, *a: asked.append(len(symbols)) or expand(symbols, *a))
    said = np.random.default_rng(8).integers(0, 50, (20, 12))
    ids = said[np.random.default_rng(9).integers(0, 20, 5000)].ravel()
    last = np.zeros(len(ids), dtype=bool)
    last[-1] = True
    symbols, _, rules = compress(ids, last, 50)
    assert expand_shard(symbols, rules, 50, expansions(rules, 50)).tolist() == ids.tolist()
    assert asked == [len(rules)] and len(rules) < len(symbols)
