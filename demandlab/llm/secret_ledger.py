"""Secret scans with an incremental ledger of blobs.

A version (a path and its text, or any row with a text) is addressed by the
SHA-256 of its content. The ledger is a Parquet table with a row for each scan of
a blob: the rule versions applied and the findings. A run looks up which pairs of
blob and rule version the ledger lacks, by blobs alone; then only texts that may be
of such blobs (a Bloom filter tells) are brought together, one copy of each is
scanned for just those rules, and the findings of all blobs are joined back to every
path. A run without anything new moves no text. A rule that changes gets a new
version and is then scanned anew; nothing else is.

Cases: a null text is an empty one; equal texts are one blob; a row gets one
result row, also when it is repeated or its id is null; an empty table gives no
rows and leaves the ledger as it is; other columns pass through, whatever their
names, but for one named `findings`, which is replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlab.llm.row_filters import possible
from demandlab.session import fresh_path, materialize


@dataclass(frozen=True)
class Rule:
    """A pattern; a match counts if its group has `least` characters or more."""

    kind: str
    version: int
    pattern: str
    group: int
    least: int
    any_case: bool = False
    base: bool = True

    @property
    def name(self) -> str:
        return f"{self.kind}/{self.version}"


RULES = (
    Rule("assign", 1, r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8, any_case=True),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", 1, r"[0-9a-f]+", 0, 32),
    Rule("pem", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1, base=False),
)
LEDGER = "blob binary, rules array<string>, findings array<struct<rule:string,low:int,high:int>>"
_FINDINGS = pa.list_(pa.struct([("rule", pa.string()), ("low", pa.int32()), ("high", pa.int32())]))


def _scanner(rule: Rule):
    pattern = rule.pattern
    if pattern == r"[0-9a-f]+":
        pattern = f"[0-9a-f]{{{rule.least},}}"  # the same runs, without a match for each short one
    pattern = re.compile(pattern, re.ASCII | (re.IGNORECASE if rule.any_case else 0))
    return lambda text: [m.span() for m in pattern.finditer(text) if m.end(rule.group) - m.start(rule.group) >= rule.least]


def create_ledger(spark: SparkSession, path: str | None = None) -> str:
    """An empty ledger at the path, or at a new one in the shared folder; one that is there stays."""
    path = path or fresh_path(spark, "secret-ledger")
    spark.createDataFrame([], LEDGER).write.mode("ignore").parquet(path)
    return path


def _pending(blobs: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(blob, pending): the rule versions that the ledger lacks for each distinct blob."""
    seen = ledger.join(blobs, "blob", "left_semi").groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("seen"))
    wanted = F.array(*[F.lit(rule.name) for rule in rules])
    return blobs.join(seen, "blob", "left").select("blob", F.array_except(wanted, F.coalesce("seen", F.array().cast("array<string>"))).alias("pending"))


def unseen(versions: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame | None:
    """(blob, text, pending): one copy of each blob that the ledger lacks rule versions for, and those; None if there is no such blob."""
    spark = versions.sparkSession
    texts = versions.select(blob_of("text").alias("blob"), F.coalesce("text", F.lit("")).alias("text"))
    state = materialize(_pending(texts.select("blob").distinct(), spark.read.schema(LEDGER).parquet(ledger), rules), "blobs")
    pending = state.filter(F.size("pending") > 0)
    known, new = state.count(), pending.count()
    if not new:
        return None
    if new < known:
        texts = possible(texts, pending.select("blob"), "blob")
    # Copies meet in the partial aggregation, so a blob with many copies is sent once per task.
    return texts.groupBy("blob").agg(F.first("text").alias("text")).join(pending, "blob")


def scan(versions: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES) -> None:
    """Scan the blobs of the column text for the rules that they were not scanned for, and append to the ledger."""

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanners = {rule.name: _scanner(rule) for rule in rules}
        for batch in batches:
            found = [
                [{"rule": name, "low": low, "high": high} for name in names for low, high in scanners[name](text)]
                for text, names in zip(batch["text"].to_pylist(), batch["pending"].to_pylist())
            ]
            yield pa.RecordBatch.from_arrays([batch["blob"], batch["pending"], pa.array(found, _FINDINGS)], ["blob", "rules", "findings"])

    texts = unseen(versions, ledger, rules)
    if texts is not None:
        texts.mapInArrow(scanned, LEDGER).write.mode("append").parquet(ledger)


def blob_of(text: str) -> Column:
    return F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256))


def findings(versions: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Every row and column of the versions with `findings`: the spans of these rule versions by start, then rule as listed."""
    order = F.create_map(*[F.lit(x) for k, rule in enumerate(rules) for x in (rule.name, k)])
    kinds = F.create_map(*[F.lit(x) for rule in rules for x in (rule.name, rule.kind)])
    found = versions.sparkSession.read.schema(LEDGER).parquet(ledger).filter(F.size("findings") > 0)
    found = found.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("findings"))).alias("f"))
    spans = F.array_sort(F.transform(F.filter("f", lambda x: order[x["rule"]].isNotNull()), lambda x: F.struct(x["low"].alias("low"), order[x["rule"]].alias("order"), x["high"].alias("high"), kinds[x["rule"]].alias("kind"))))
    found = found.select("blob", spans.alias("findings"))
    none = F.array().cast("array<struct<low:int,order:int,high:int,kind:string>>")
    # The caller's row is one column, so that no name can clash.
    row = F.struct(*[F.col(f"`{c}`") for c in versions.columns if c.lower() != "findings"]).alias("row")
    joined = versions.select(row, blob_of("text").alias("blob")).join(found, "blob", "left")
    return joined.select("row.*", F.coalesce("findings", none).alias("findings"))


def scanned(versions: DataFrame, ledger: str | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Scan what is new and return every row with its findings."""
    ledger = create_ledger(versions.sparkSession, ledger)
    scan(versions, ledger, rules)
    return findings(versions, ledger, rules)


def spans_text(kinds: list[str] | None = None) -> Column:
    """kind:start:end of the findings (of the kinds), comma-joined."""
    chosen = F.filter("findings", lambda x: x["kind"].isin(kinds)) if kinds else F.col("findings")
    return F.array_join(F.transform(chosen, lambda x: F.concat_ws(":", x["kind"], x["low"], x["high"])), ",")


def count_of(kind: str) -> Column:
    return F.size(F.filter("findings", lambda x: x["kind"] == kind)).cast("long")
