"""The URL filter against plain Python, on awkward URLs."""

import re

import pytest
from pyspark.sql import functions as F

from ridegauge.llm import urls
from ridegauge.llm.queries import QUERIES, URL_RULES, URL_WORDS

SF = "/root/testdata/sf0.001"
LONG = "http://long.example.net/" + "a/" * 60_000
AWKWARD = [
    (1, None), (2, ""), (3, "no scheme"), (4, "http://"), (5, "http://ORG/x"), (6, "https://a.Example.ORG/es/9?x#y"),
    (7, "http://example.org/en/1234"), (8, "http://www.example.org/en/2"), (9, "http://shop.com/fr/1"),
    (10, "http://shop.com/de/"), (11, "http://shop.com/de"), (12, "http://notexample.org?/es/"),
    (13, "http://u:p@www.List.net:80/a//b/index.html?b=2&utm_source=x&a=1#f"), (14, "ftp://list.net/a/b?a=1&b=2"),
    (14, "ftp://list.net/a/b?a=1&b=2"), (15, "http://list.net/a/b"), (None, "http://list.net/a/b?a=1&b=2"),
    (16, LONG), (17, "x://y://z/p"), (18, "http://list.net.#?q"),
]


def split(url):
    rest = url.partition("://")[2] if url and "://" in url else ""
    host = re.match("[^/?#]*", rest).group()
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), re.match("[^?#]*", rest[len(host):]).group(), rest


def canonical(url):
    host, path, rest = split(url)
    host = re.sub(r"^www\.|\.$", "", re.sub(r":(80|443)?$", "", re.sub("^[^@]*@", "", host)))
    path = re.sub("/$", "", re.sub(r"/index\.(html?|php)$", "/", re.sub("/{2,}", "/", path)))
    query = rest.partition("#")[0].partition("?")[2]
    asked = "&".join(sorted(p for p in query.split("&") if p and not re.search(urls.TRACKING, p)))
    return (host + path + ("?" + asked if asked else "")) if host else None


def expected(rows, listed):
    found = []
    for page_id, url in rows:
        host, path, _ = split(url)
        fits = [r for r in URL_RULES if ("." + host).endswith("." + r.host) and path.startswith(r.path)]
        rule = max(fits, key=lambda r: len(r.name), default=None)
        verdict = rule.verdict if rule else "block" if canonical(url) in listed else "allow"
        found.append((page_id, host, path, rule and rule.name, verdict))
    return sorted(found, key=repr)


def plain(df):
    columns = ("page_id", "host", "path", "rule", "verdict")
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def test_query(spark):
    rows = [(r.page_id, r.url) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    named = re.compile(rf"(^|[.-])({'|'.join(URL_WORDS)})([.-]|$)")
    listed = {canonical(u) for _, u in rows if named.search(split(u)[0])}
    got = plain(QUERIES["op12_bloom_url_filter"](spark, SF))
    assert got == expected(rows, listed)
    assert {"allow", "block"} == {r[4] for r in got if r[3] is None}


@pytest.mark.parametrize("most_blocks", [1, 1 << 18])
def test_awkward(spark, most_blocks):
    pages = spark.createDataFrame(AWKWARD, "page_id long, url string")
    for name in ("host", "path", "rule", "verdict", "listed", "possible", "block", "salt", "word0", "canonical_url"):
        pages = pages.withColumn(name, F.lit("x"))
    listed = ["list.net/a/b?a=1&b=2", LONG.partition("://")[2].rstrip("/"), None, "y:", "list.net/a/b?a=1&b=2"]
    entries = spark.createDataFrame([(u, 1) for u in listed], "url string, page_id int")
    found = urls.judged(pages, entries, URL_RULES, most_blocks)
    assert plain(found) == expected(AWKWARD, set(filter(None, listed)))
    assert found.columns == ["page_id", "host", "path", "rule", "verdict", "canonical_url", "possible", "listed"]
    assert [r.canonical_url for r in found.filter("page_id = 13").collect()] == [listed[0]]
    assert found.filter("listed AND NOT possible").count() == 0


def test_hot_url(spark):
    hot = spark.range(3000).selectExpr("id AS page_id", "if(id % 3 = 0, 'http://hot.net/x', 'http://h' || id || '.net/') AS url")
    listed = spark.createDataFrame([("hot.net/x",), ("h1.net",), ("h2.net/",)], "url string")
    found = urls.judged(hot, listed, salts=4)
    assert found.count() == 3000 and found.filter("verdict = 'block'").count() == 1001


def test_empty(spark):
    pages = spark.createDataFrame(AWKWARD, "page_id long, url string")
    none = spark.createDataFrame([], "url string")
    assert {r.verdict for r in urls.judged(pages, none).collect()} == {"allow"}
    assert urls.judged(pages.limit(0), none, URL_RULES).collect() == []


def test_filter_keeps_every_listed_url(spark):
    listed = spark.range(20_000).selectExpr("'h.net/' || id AS url")
    blocks = urls.blocks_for(20_000, 1 << 18)
    bloom = urls.bloom_filter(listed, blocks)
    asked = spark.range(40_000).selectExpr("'h.net/' || id AS url", "id < 20000 AS own")
    rows = urls.with_possible(asked, "url", bloom, blocks).groupBy("own").agg(F.avg(F.col("possible").cast("int")).alias("share"))
    share = {r.own: r.share for r in rows.collect()}
    assert share[True] == 1 and share[False] < 0.01
    assert bloom.count() <= blocks
