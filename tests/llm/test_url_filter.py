import re

from pyspark.sql import functions as F

from demandlab.llm.url_filter import RULES, bloom_blocks, canonical, filter_urls

URLS = [
    "http://a.com/x", "HTTPS://WWW.Example.COM/en/1?utm_source=x&b=2#f", "http://example.com/en/", "http://example.com/de/", "http://m.example.com/en/2", "http://www.example.com/en/2",
    "http://x.net/es/1", "http://x.net/fr", "http://net/fr/", "http://notexample.com/en/", "http://a.com", "http://a.com?x=/en/", "http://bad.org/page", "https://www.bad.org/page/?ref=1", "http://BAD.org:80/page#z",
    "http://good.org/page", "no scheme", "", None, "://h/p", "ftp://x.com:8080/a//b/", "http://u.org/?q=http://bad.org/page", "http://a.com/x\nhttp://bad.org/page", "mailto:x", "http://bad.org/page",
]


def parts(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    return "".join(c.lower() if c.isascii() else c for c in host), re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]


def rule(host, path):
    fits = [(len(r), v, r) for v, r in RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith(r[r.index("/") :])]
    return max(fits)[1:] if fits else (None, None)


def test_every_kind_of_url(spark):
    pages = spark.createDataFrame([(k, u, "clash") for k, u in enumerate(URLS)] + [(None, URLS[0], "c"), (0, URLS[0], "c")], "page_id long, url string, verdict string")
    listed = spark.createDataFrame([("bad.org/page",), ("bad.org/page",), (None,), ("other.org/x",)], "canonical string")
    rows = filter_urls(pages, listed).collect()
    assert len(rows) == len(URLS) + 2
    for row in rows:
        host, path = parts(row.url)
        verdict, name = rule(host, path)
        on_list = row.url in ("http://bad.org/page", "https://www.bad.org/page/?ref=1", "http://BAD.org:80/page#z")
        assert (row.host, row.path, row.rule, row.listed, row.verdict) == (host, path, name, on_list, verdict or ("block" if on_list else "allow")), row


def test_filter_passes_all_listed_and_few_others(spark):
    listed = spark.range(20000).select(F.concat(F.lit("h.org/"), "id").alias("canonical"))
    pages = spark.range(40000).select(F.col("id").alias("page_id"), F.concat(F.lit("http://h.org/"), "id").alias("url"))
    assert filter_urls(pages, listed).groupBy("listed").count().orderBy("listed").collect() == [(False, 20000), (True, 20000)]
    assert bloom_blocks(listed, "canonical").count() <= 1 << 15


def test_a_filter_joined_by_its_blocks_gives_the_same(spark):
    listed = spark.range(5000).select(F.concat(F.lit("h.org/"), "id").alias("canonical"))
    # A third of all rows is one listed page, another third has no URL.
    urls = F.when(F.col("id") % 3 == 0, "http://h.org/7").when(F.col("id") % 3 == 1, F.concat(F.lit("http://h.org/"), "id"))
    pages = spark.range(30000).select(F.col("id").alias("page_id"), urls.alias("url"))
    count = lambda **options: filter_urls(pages, listed, **options).groupBy("listed").count().orderBy("listed").collect()
    assert count(most_sent=0) == count() == [(False, 18333), (True, 11667)]


def test_names_that_clash_and_a_very_long_url(spark):
    long = "http://a.com/" + "/" * 300_000
    names = ["_key", "block", "w0", "_listed", "key", "row", "possible", "Host"]
    pages = spark.createDataFrame([(1, "http://bad.org/page", *names), (2, long, *names), (3, long + "x", *names)], ["page_id", "url", *names])
    rows = filter_urls(pages, spark.createDataFrame([("bad.org/page",), ("a.com",)], "canonical string")).collect()
    assert sorted((r.page_id, r.host, r.verdict, r.listed) for r in rows) == [(1, "bad.org", "block", True), (2, "a.com", "allow", True), (3, "a.com", "allow", False)]
    assert all(r[name] == name for r in rows for name in names[:-1]) and "Host" not in rows[0].asDict()


def test_canonical_form(spark):
    rows = spark.createDataFrame([("https://WWW.a.org:80/x/?utm_source=1&q=2&ref=3#f",), ("http://a.org/x?q=2",), (None,), ("nothing",)], "url string")
    assert [r[0] for r in rows.select(canonical("url")).collect()] == ["a.org/x?q=2", "a.org/x?q=2", None, None]


def test_empty_tables_and_plan(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    assert filter_urls(pages, spark.createDataFrame([], "canonical string")).collect() == []
    plan = filter_urls(pages, spark.createDataFrame([("x",)], "canonical string"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Cartesian" not in plan
