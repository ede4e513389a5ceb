"""Filters of URLs: rules by host and path, and a list of canonical URLs behind a blocked Bloom filter.

The filter is a table of 256-bit blocks, each of four 64-bit words with one bit
per listed URL and word. A URL looks up its one block; only if all four bits are
set does it go on to the exact join with the list, which removes false positives.
There is a block for every 16 listed URLs, so few others pass however long the list
is; while the table is small by that count it is broadcast, beyond that it is joined
by the block. All is made of Spark functions.

Cases: a null URL or one without `://` has an empty host and path and is on no
list; each row gets one result row, also when it is repeated or its id is null;
listed nulls and repeats do not matter; other columns pass through, whatever their
names, but for those that the result names itself, which are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandlab.llm.words import LOWER, UPPER
from demandlab.session import materialize

#: (verdict, host and path). The path starts at the first slash.
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))
#: Listed URLs to a block, and the fewest blocks.
PER_BLOCK, LEAST_BLOCKS = 16, 1 << 15
#: 40 bytes each: up to so many blocks, 10 MB, are broadcast.
MOST_SENT = 1 << 18
RESULTS = ("host", "path", "rule", "verdict", "listed")
_TRACKING = r"(^|&)(utm_[^&=]*|ref)=[^&]*"


def host(url: str) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path(url: str) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: str) -> Column:
    """Host without `www.` and port, path without a closing slash, query without tracking; null without a host."""
    query = F.regexp_replace(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^?#]*\?([^#]*)", 1), F.lit("")), _TRACKING, "")
    query = F.regexp_replace(query, "^&", "")
    site = F.regexp_replace(F.regexp_replace(host(url), ":[0-9]*$", ""), r"^www\.", "")
    out = F.concat(site, F.rtrim(path(url), F.lit("/")), F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))
    return F.when(site != "", out)


def rule_of(host_: Column, path_: Column, rules=RULES) -> Column:
    """The longest rule that fits, as a struct of rule and verdict; null if none does."""
    out = None
    for verdict, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        site, slash, rest = rule.partition("/")
        fits = ((host_ == site) | host_.endswith("." + site)) & path_.startswith(slash + rest)
        value = F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return out if out is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def _bit(key: str, word: int) -> Column:
    """One bit of the word, by six bits of a second hash of the key."""
    six = F.pmod(F.shiftright(F.xxhash64(key, F.lit("bits")), 6 * word), F.lit(64)).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("long"), six)


def _block(key: str, blocks: int) -> Column:
    return F.when(F.col(key).isNotNull(), F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int"))


def bloom_blocks(listed: DataFrame, key: str, blocks: int = LEAST_BLOCKS) -> DataFrame:
    """The filter: (block, w0, w1, w2, w3), a row for each block that has a bit."""
    return listed.groupBy(_block(key, blocks).alias("block")).agg(*[F.bit_or(_bit(key, w)).alias(f"w{w}") for w in range(4)])


def filter_urls(pages: DataFrame, listed: DataFrame, url: str = "url", rules=RULES, most_sent: int = MOST_SENT) -> DataFrame:
    """All columns, and host, path, rule, verdict, and `listed`. listed: a frame with the column canonical."""
    # The caller's row is one column, so that no name can clash.
    row = F.struct(*[F.col(f"`{c}`") for c in pages.columns if c.lower() not in RESULTS]).alias("row")
    site, place = host(url).alias("host"), path(url).alias("path")
    pages = pages.select(row, site, place, canonical(url).alias("key"))
    listed = materialize(listed.select(F.col("canonical").alias("key")).filter("key is not null").distinct(), "listed")
    count = max(LEAST_BLOCKS, -(-listed.count() // PER_BLOCK))
    blocks = bloom_blocks(listed, "key", count)
    probed = pages.withColumn("block", _block("key", count)).join(F.broadcast(blocks) if count <= most_sent else blocks, "block", "left")
    possible = F.col("key").isNotNull()
    for word in range(4):
        possible &= F.col(f"w{word}").bitwiseAND(_bit("key", word)) != 0
    probed = probed.select("row", "host", "path", "key", F.coalesce(possible, F.lit(False)).alias("possible"))
    hits = probed.filter("possible").join(listed.withColumn("listed", F.lit(True)), "key", "left")
    judged = probed.filter("not possible").withColumn("listed", F.lit(False)).unionByName(hits.withColumn("listed", F.coalesce("listed", F.lit(False))))
    rule = rule_of(F.col("host"), F.col("path"), rules)
    judged = judged.select("row", "host", "path", rule.alias("rule"), "listed")
    verdict = F.coalesce("rule.verdict", F.when(F.col("listed"), "block").otherwise("allow"))
    return judged.select("row.*", "host", "path", F.col("rule.rule").alias("rule"), verdict.alias("verdict"), "listed")
