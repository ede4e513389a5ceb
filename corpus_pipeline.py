"""A corpus from documents to token ids, in stages that each write and reread Parquet.

Every stage works on all rows that the one before kept and, but for the last,
returns the columns of documents:

1. language_id: what has no letter, or no language with a calibrated probability
   of a half or more, goes.
2. jaccard_join: of each group of copies and near copies the row with the smallest
   id stays; texts without a word are no copies of each other.
3. decontamination: documents with a twentieth or more of their words inside
   benchmark passages go.
4. secret_ledger: documents with a finding go.
5. sentencepiece: adds `ids` and `n_tokens`.

SQL cannot express the stages; tests hold them against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlab.llm import language_id, secret_ledger, sentencepiece_lattice
from demandlab.llm.decontamination import contamination, judged
from demandlab.llm.jaccard_join import jaccard_join
from demandlab.llm.language_id import UNKNOWN, remainder
from demandlab.llm.queries import importable, tokenizer_file
from demandlab.session import materialize

LEAST_SCORE = 0.5


def _wrapped(docs: DataFrame, *columns: str) -> DataFrame:
    """The whole row as one column besides those an operator needs, so that no name can clash."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), *columns)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language_id.train(docs.filter(remainder("doc_id", 3) != 1))
    found = language_id.identify(_wrapped(docs, "text"), model)
    return found.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select("_row.*")


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = materialize(jaccard_join(docs).filter("class_key is not null").select("doc_id", "row_key", "class_key"), "groups")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")
    kept = found.groupBy("class_key").agg(F.min(order)["row_key"].alias("kept_key"))
    copies = found.join(kept, "class_key").filter(F.col("row_key") != F.col("kept_key")).select("row_key").distinct()
    repeated = found.groupBy("row_key").agg(F.count("*").alias("n")).filter("n > 1").select("row_key")
    keyed = _wrapped(docs, F.xxhash64("doc_id", "text").alias("row_key")).join(copies, "row_key", "left_anti")
    single = keyed.join(repeated, "row_key", "left_anti")
    return single.union(keyed.join(repeated, "row_key", "left_semi").dropDuplicates(["row_key"]).select(*single.columns)).select("_row.*")


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = judged(contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))
    bad = found.filter("contaminated").select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"))
    wrapped = _wrapped(docs, "doc_id", F.xxhash64("text").alias("text_key"))
    return wrapped.join(bad, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key")), "left_anti").select("_row.*")


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_ledger.scanned(_wrapped(docs, "text")).filter(F.size("findings") == 0).select("_row.*")


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    pieces = sentencepiece_lattice.read_pieces(tokenizer_file("piece_bpe_32k.model"))
    return sentencepiece_lattice.encode_texts(docs, pieces).withColumn("n_tokens", F.size("ids"))


STAGES = [
    ("language_id", known_language),
    ("jaccard_join", one_of_each_group),
    ("decontamination", decontaminated),
    ("secret_ledger", without_secrets),
    ("sentencepiece", tokenized),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = importable(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
