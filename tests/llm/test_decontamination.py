import hashlib
import random
import re

from demandlab.llm.decontamination import contamination, judged

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain(text):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def brute(documents, items):
    windows = {}
    for item_id, text in items:
        words = plain(text)
        size = min(13, len(words))
        for start in range(len(words) - size + 1 if size else 0):
            windows.setdefault(tuple(words[start : start + size]), set()).add(item_id)
    out = []
    for doc_id, text in documents:
        words, hit, found = plain(text), set(), set()
        for size in {len(w) for w in windows}:
            for start in range(len(words) - size + 1):
                if ids := windows.get(tuple(words[start : start + size])):
                    hit.update(range(start, start + size))
                    found |= ids
        names = ",".join(sorted(str(i) for i in found if i is not None))
        n_items = len([i for i in found if i is not None])
        out.append((doc_id, len(words), len(hit), n_items, hashlib.sha256(names.encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(words)))
    return out


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r))


def test_equals_brute_force_on_every_kind_of_row(spark, documents):
    random.seed(3)
    words = [f"w{k}" for k in range(12)]
    say = lambda n: " ".join(random.choice(words) for _ in range(n))
    items = [(1, say(30)), (2, say(13)), (3, say(14)), (10, "Only Three words"), (4, "single"), (5, None), (6, ""), (7, "!!!"), (3, say(20)), (8, say(13)), (None, say(15))]
    items.append((9, items[0][1]))
    docs = [(k, say(random.randint(0, 60))) for k in range(40)]
    docs += [(100, items[0][1].upper()), (101, say(5) + " " + items[1][1] + ". " + items[0][1] + say(9)), (102, "a only three WORDS b"), (103, "single"), (104, "Single single."), (105, None), (106, ""), (107, "!?"), (None, items[2][1]), (None, None)]
    docs += [docs[40], docs[40], (100, say(20) + " " + items[-2][1]), (110, say(300) + " " + items[3][1]), (111, " ".join(items[-2][1].split()[:12]))]
    table = spark.createDataFrame(items, "item_id long, text string")
    found = [tuple(r)[:6] for r in judged(contamination(documents(*docs), table)).collect()]
    assert ordered(found) == ordered(brute(docs, items))


def test_empty_tables(spark, documents):
    table = spark.createDataFrame([], "item_id long, text string")
    (row,) = judged(contamination(documents((1, "some words")), table)).collect()
    assert (row.n_words, row.n_hit, row.n_items, row.contaminated) == (2, 0, 0, False)
    assert judged(contamination(documents(), spark.createDataFrame([(1, "a b")], "item_id long, text string"))).collect() == []
