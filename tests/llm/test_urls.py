"""Hosts, paths and rules against plain Python; trees that learn."""

import re

from fixtures import plain
from pyspark.sql import functions as F

from kinfold.llm import urls
from kinfold.llm.urls import UrlParams, judged, labelled_urls, split_url

URLS = [
    "http://Blog.Example.NET/en/1?x=1#f", "https://example.net/en", "https://example.net/enx/", "http://myexample.net/en/1", "net", "http://net",
    "http://a.net/", "ftp://x.org/fr/1", "http://x.org/FR/1", "http://org/fr/", "http://sub.example.com/de/", "http://example.com/de", None,
    "", "://", "http://", "http://h?p=/en/", "http://h#://x/y", "no scheme/at/all", "http://É.org/fr/é", "http://a.b.c.d.e/f//g/?a=1&b=2&&c", "http://x.net:80/en/",
]


def slow(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in rules if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith("/" + r.split("/", 1)[1])]
    return host, path, max(fits, key=len, default=None)


def test_host_path_and_rule(spark):
    p = UrlParams()
    pages = spark.createDataFrame(list(enumerate(URLS)) + [(3, URLS[3])], "page_id long, url string").withColumn("rule", F.lit("x"))
    none = spark.createDataFrame([], "url string, bad int")
    rows = judged(pages, none, p).collect()
    assert plain((r.page_id, r.host, r.path, r.rule) for r in rows) == plain((i, *slow(u, p.rules)) for i, u in [*enumerate(URLS), (3, URLS[3])])
    assert all(r.verdict == p.rules.get(r.rule, "allow") for r in rows)
    assert judged(pages.limit(0), none, p).count() == 0
    host, path = split_url(F.lit("x://A/b"))
    assert spark.range(1).select(host, path).first()[:] == ("a", "/b")


def test_trees_learn_from_labelled_urls(spark):
    good = [(f"https://site{i % 7}.example.com/en/{i}", 0) for i in range(120)]
    bad = [(f"http://win-{i}-{i * 7919}.spam{i % 3}.biz/a/b/c?x={i}&y={i}&z=1", 1) for i in range(120)]
    labelled = spark.createDataFrame([*good, *bad, (None, 1), ("http://x", None)], "url string, bad int")
    fresh = [(1, "https://site2.example.com/en/999"), (2, "http://win-4-4242.spam9.biz/a/b/c?x=1&y=2&z=3"), (3, None), (4, "http://win-1.spam1.net/q?a=1&b=2")]
    rows = {r.page_id: r for r in judged(spark.createDataFrame(fresh, "page_id long, url string"), labelled, UrlParams(rounds=4)).collect()}
    assert rows[1].verdict == "allow" and rows[2].verdict == "block" and rows[3].verdict in ("allow", "block")
    assert rows[4].verdict == "block" and rows[4].rule == "net/"
    only = judged(spark.createDataFrame(fresh[:1], "page_id long, url string"), labelled.filter("bad = 1"), UrlParams())
    assert only.first().verdict == "block"


def test_labels_come_from_the_number_in_the_path(spark):
    pages = spark.createDataFrame([("http://a.com/en/12.html",), ("http://a.com/en/13/",), ("http://a.com/en/14?page=2",), (None,), ("http://a.com/",)], "url string")
    labels = spark.createDataFrame([(12, 1, 0), (13, 0, 0), (14, 1, 1), (2, 0, 1), (None, 0, 0)], "doc_id long, quality int, toxic int")
    assert plain(labelled_urls(pages, labels).collect()) == [("http://a.com/en/12.html", 0), ("http://a.com/en/13/", 1), ("http://a.com/en/14?page=2", 1)]


def test_entropy(spark):
    got = spark.createDataFrame([("aabb",), ("",), ("abcd",)], "u string").select(urls.entropy(F.col("u"))).collect()
    assert [round(r[0], 9) for r in got] == [1.0, 0.0, 2.0]
