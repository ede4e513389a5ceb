import re
from dataclasses import replace

from demandlab.llm.row_filters import possible
from demandlab.llm.secret_ledger import RULES, blob_of, create_ledger, findings, scan, scanned, spans_text, unseen

HEX = "0123456789abcdef" * 2
TEXTS = [
    f"password = 'hunter2hunter2' AKIA{'A' * 12} {HEX}", f"Token: secret: abcdefgh API_KEY=short apikey : \"{HEX}\"", "passwd:abcdefg", f"x{HEX}{HEX}g", f"AKIAAKIA{'B' * 8} AKIA123", "éé語 secret=ÄBCDEFGH token==abcdefgh",
    "PASSWORD  =  \"abc.def-gh\"", "ſecret=abcdefgh", "-----BEGIN RSA PRIVATE KEY-----", "", None, "nothing", "token=secret=abcdefghij",
]


def brute(text):
    out, text = [], text or ""
    kinds = [("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8, re.I | re.A), ("access", r"AKIA[A-Z0-9]+", 0, 16, 0), ("hex", r"[0-9a-f]+", 0, 32, 0)]
    for order, (kind, pattern, group, least, flags) in enumerate(kinds):
        out += [(m.start(), order, m.end(), kind) for m in re.finditer(pattern, text, flags) if len(m.group(group)) >= least]
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(out))


def test_base_findings_equal_brute_force(documents):
    rows = [(k, t) for k, t in enumerate(TEXTS)] + [(None, TEXTS[0]), (0, TEXTS[0]), (50, TEXTS[0])]
    found = scanned(documents(*rows)).select("doc_id", "text", "score", spans_text(["assign", "access", "hex"]).alias("base"), spans_text().alias("all")).collect()
    assert sorted((str(r.doc_id), r.text or "") for r in found) == sorted((str(k), t or "") for k, t in rows)
    assert all(r.base == brute(r.text) for r in found)
    assert {r.doc_id: r.all for r in found}[8] == "pem:0:31"


def test_only_unseen_pairs_of_blob_and_rule_version_are_scanned(spark, documents):
    ledger = create_ledger(spark)
    read = lambda: spark.read.parquet(ledger)
    scan(documents((1, TEXTS[0]), (2, TEXTS[0]), (3, "nothing")), ledger)
    assert read().count() == 2
    scan(documents((4, TEXTS[0]), (5, "new"), (6, None)), ledger)
    assert read().count() == 4
    rules = (replace(RULES[0], version=2, least=20), *RULES[1:])
    scan(documents((7, TEXTS[0]), (5, "new")), ledger, rules)
    assert sorted(map(list, (r.rules for r in read().collect() if r.rules == ["assign/2"]))) == [["assign/2"]] * 2 and read().count() == 6
    paths = documents((1, TEXTS[0]), (9, TEXTS[0]))
    assert {r[0] for r in findings(paths, ledger).select(spans_text(["assign"])).collect()} == {"assign:0:26"}
    assert {r[0] for r in findings(paths, ledger, rules).select(spans_text(["assign"])).collect()} == {""}


def test_a_later_run_moves_no_text_of_known_blobs(spark, documents):
    ledger = create_ledger(spark)
    old = [(k, f"known {k} " + "x" * 2000) for k in range(3000)]
    scan(documents(*old), ledger)
    assert unseen(documents(*old), ledger) is None
    new = unseen(documents(*old, (5000, "new"), (5001, "new"), (5002, None)), ledger)
    assert sorted(r.text for r in new.collect()) == ["", "new"]
    # The filter stands in front of the shuffle, and lets through few texts but those of new blobs.
    assert "MapInArrow chosen" in new._jdf.queryExecution().executedPlan().toString()
    texts = documents(*old, (5000, "new")).select(blob_of("text").alias("blob"))
    assert possible(texts, documents((1, "new")).select(blob_of("text").alias("blob")), "blob").count() <= 3


def test_names_that_clash_and_a_very_long_text(spark):
    long = ("word " * 400_000) + "token=abcdefgh"
    rows = [(1, "token=abcdefgh", "a", "b", "c", "d"), (2, long, "a", "b", "c", "d"), (3, None, None, None, None, None)]
    table = spark.createDataFrame(rows, "doc_id long, text string, _key string, _blob string, blob string, `row` string")
    found = {r.doc_id: r for r in scanned(table).withColumn("spans", spans_text()).collect()}
    assert [found[k].spans for k in (1, 2, 3)] == ["assign:0:14", "assign:2000000:2000014", ""]
    assert tuple(found[1][c] for c in ("_key", "_blob", "blob", "row")) == ("a", "b", "c", "d")


def test_empty_table(spark, documents):
    ledger = create_ledger(spark)
    assert scanned(documents(), ledger).collect() == [] and spark.read.parquet(ledger).count() == 0
