"""The registered queries of the operators, and SQL for those that SQL can express."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlab.llm import language_id, secret_ledger, sentencepiece_lattice, toxicity
from demandlab.llm.decontamination import contamination, judged
from demandlab.llm.jaccard_join import jaccard_join
from demandlab.llm.language_id import remainder
from demandlab.llm.one_bit_search import nearest
from demandlab.llm.phrase_counting import BREAKS, collocations
from demandlab.llm.pseudonyms import pseudonymized
from demandlab.llm.repair_files import read_documents, write_shards
from demandlab.llm.suffix_buckets import without_repeats
from demandlab.llm.token_alignment import aligned
from demandlab.llm.url_filter import RULES, canonical, filter_urls, host
from demandlab.llm.words import GAP, LOWER, UPPER
from demandlab.session import fresh_path

#: Labels of hosts whose pages are listed; the list of canonical URLs is made from the pages.
LISTED_LABELS = ("spam-farm", "cheap-pills", "casino-win", "adult-x", "free-bets", "ads-track")
LISTED_HOST = rf"(^|\.)({'|'.join(LISTED_LABELS)})\."


def tokenizer_file(name: str) -> str:
    """The place of a public tokenizer's file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def importable(spark: SparkSession) -> SparkSession:
    """Lets the tasks of a session on this machine import the package from where it lies."""
    root, paths = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if root not in paths.get("PYTHONPATH", "").split(":"):
        paths["PYTHONPATH"] = f"{root}:{paths.get('PYTHONPATH', '')}".rstrip(":")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return importable(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return judged(found).drop("text_key")


def op2_one_bit_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    listed = pages.filter(host("url").rlike(LISTED_HOST)).select(canonical("url").alias("canonical"))
    return filter_urls(pages, listed).drop("url")


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents")).drop("row_key", "class_key")


def op5_repair_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "token-files")
    write_shards(table(spark, sf_dir, "documents"), path, tokenizer_file("byte_bpe_50k.json"))
    return read_documents(spark, path)


def op6_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymized(table(spark, sf_dir, "documents").select("doc_id", "text"), key="linked pseudonyms")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(remainder("doc_id", 4) == 2, F.lit(False))
    model = toxicity.train(documents, table(spark, sf_dir, "labels").filter(~held_out))
    scored = toxicity.scored(documents, model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = sentencepiece_lattice.read_pieces(tokenizer_file("piece_bpe_32k.model"))
    decode = sentencepiece_lattice.decode_batches(pieces)
    encoded = sentencepiece_lattice.encode_texts(
        table(spark, sf_dir, "documents").select("doc_id", "text"),
        pieces,
        then=lambda batches: decode(sentencepiece_lattice.crc32_batches(batches)),
        added="ids_crc32 long, decoded string",
    )
    plain = F.translate(F.coalesce("text", F.lit("")), sentencepiece_lattice.SPACE, " ")
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids_crc32", (F.col("decoded") == plain).alias("round_trip"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language_id.train(documents.filter(remainder("doc_id", 3) != 1))
    found = language_id.identify(documents.select("doc_id", "text"), model)
    return found.select("doc_id", F.coalesce(remainder("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op10_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    # Two deliveries into one ledger: the second scans all documents, of which half are known by then.
    ledger = secret_ledger.create_ledger(spark)
    secret_ledger.scan(documents.filter("doc_id % 2 = 0"), ledger)
    found = secret_ledger.scanned(documents, ledger)
    base = [rule.kind for rule in secret_ledger.RULES if rule.base]
    counts = [secret_ledger.count_of(kind).alias(f"n_{kind}") for kind in base]
    return found.select("doc_id", *counts, F.sha2(secret_ledger.spans_text(base), 256).alias("base_sha256"), secret_ledger.spans_text().alias("spans"))


def op11_suffix_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select("row.doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model")
    found = aligned(table(spark, sf_dir, "documents").select("doc_id", "text"), *files, digest=True)
    return found.select("row.doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", F.col("groups").alias("groups_sha256"))


def op13_phrase_counting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents").select("doc_id", "lang", "text"))


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_one_bit_search": op2_one_bit_search,
    "op3_url_filter": op3_url_filter,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_repair_files": op5_repair_files,
    "op6_pseudonyms": op6_pseudonyms,
    "op7_toxicity": op7_toxicity,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_language_id": op9_language_id,
    "op10_secret_ledger": op10_secret_ledger,
    "op11_suffix_buckets": op11_suffix_buckets,
    "op12_token_alignment": op12_token_alignment,
    "op13_phrase_counting": op13_phrase_counting,
}

_WORDS = f"list_filter(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{GAP}'), lambda x: x <> '')"

ORACLE = {
    "op1_decontamination": f"""
WITH doc AS (SELECT doc_id, {_WORDS} AS w FROM documents),
item AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
windows AS (
  SELECT item_id, least(13, len(w)) AS size, array_to_string(w[s : s + least(13, len(w)) - 1], ' ') AS words
  FROM item, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS t(s) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT size FROM windows),
places AS (
  SELECT doc_id, s, size, array_to_string(w[s : s + size - 1], ' ') AS words
  FROM doc, sizes, unnest(range(1, len(w) - size + 2)) AS t(s) WHERE len(w) >= size),
hits AS (SELECT DISTINCT doc_id, s, size, item_id FROM places JOIN windows USING (size, words)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM hits, unnest(range(s, s + size)) AS t(p) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)""",
    "op2_one_bit_search": """
WITH v AS (
  SELECT DISTINCT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score
  FROM v AS q JOIN v AS c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 20 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM pairs)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score FROM ranked WHERE r <= 20""",
    "op3_url_filter": f"""
WITH parts AS (
  SELECT page_id, url,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), '{UPPER}', '{LOWER}') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path,
    regexp_replace(regexp_replace(coalesce(regexp_extract(url, '(?s)^.*?://[^?#]*\\?([^#]*)', 1), ''),
      '(^|&)(utm_[^&=]*|ref)=[^&]*', '', 'g'), '^&', '') AS query
  FROM pages),
keyed AS (
  SELECT *, nullif(regexp_replace(regexp_replace(host, ':[0-9]*$', ''), '^www\\.', ''), '')
    || regexp_replace(path, '/+$', '') || CASE WHEN query <> '' THEN '?' || query ELSE '' END AS canonical
  FROM parts),
list AS (SELECT DISTINCT canonical FROM keyed WHERE regexp_matches(host, '{LISTED_HOST}') AND canonical IS NOT NULL),
rules(verdict, rule) AS (VALUES {', '.join(str(r) for r in RULES)}),
fits AS (
  SELECT page_id, host, path, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
  FROM (SELECT DISTINCT page_id, host, path FROM keyed) JOIN rules
    ON (host = split_part(rule, '/', 1) OR ends_with(host, '.' || split_part(rule, '/', 1)))
    AND starts_with(path, substr(rule, strpos(rule, '/')))
  GROUP BY ALL)
SELECT k.page_id, k.host, k.path, f.rule, l.canonical IS NOT NULL AS listed,
  coalesce(f.verdict, CASE WHEN l.canonical IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM keyed AS k LEFT JOIN fits AS f ON f.page_id = k.page_id AND f.host = k.host AND f.path = k.path
LEFT JOIN list AS l ON l.canonical = k.canonical""",
    "op13_phrase_counting": f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(string_split(translate(coalesce(text, ''), '{UPPER}{BREAKS}', '{LOWER}' || repeat(chr(10), {len(BREAKS)})), chr(10))) AS piece
  FROM documents),
words AS (SELECT lang, list_filter(string_split_regex(piece, '[ \t]+'), lambda x: x <> '') AS w FROM pieces),
sizes AS (SELECT lang, CAST(sum(len(w)) AS HUGEINT) AS n FROM words GROUP BY lang),
f AS (
  SELECT lang, k, w[i : i + k - 1] AS p, CAST(count(*) AS HUGEINT) AS c
  FROM words, unnest(range(1, 6)) AS t(k), unnest(range(1, len(w) - k + 2)) AS u(i)
  GROUP BY lang, k, p HAVING count(*) >= 100),
longer AS (
  SELECT DISTINCT lang, unnest([p[: k - 1], p[2 :]]) AS p, c FROM f WHERE k >= 3),
kept AS (SELECT * FROM f WHERE k >= 2 AND NOT EXISTS (SELECT 1 FROM longer AS x WHERE x.lang = f.lang AND x.p = f.p AND x.c = f.c)),
cuts AS (
  SELECT q.lang, q.p, q.c AS a, l.c AS l, r.c AS r, n, s, 1000 * q.c * n // (l.c * r.c) AS score
  FROM kept AS q, unnest(range(1, q.k)) AS t(s)
  JOIN f AS l ON l.lang = q.lang AND l.p = q.p[: s]
  JOIN f AS r ON r.lang = q.lang AND r.p = q.p[s + 1 :]
  JOIN sizes AS z ON z.lang = q.lang),
least AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, s) = 1),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(array_to_string(p, ' '))) AS rank FROM least)
SELECT lang, rank, array_to_string(p, ' ') AS phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
  CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked WHERE rank <= 2000""",
}
