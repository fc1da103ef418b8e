"""URL rules: every page against plain Python, and a cascade over a long list."""

import re

import pytest
from pyspark.sql import functions as F

from roadspark.llm import urlfilter
from roadspark.llm.queries import URL_RULES


def plain(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split("[/?#]", rest, maxsplit=1)[0]
        path = re.split("[?#]", rest[len(host) :], maxsplit=1)[0]
        host = host.translate({k: k + 32 for k in range(65, 91)})
    fits = [(len(h + p), h + p, v) for h, p, v in rules if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits) if fits else (0, None, "allow")
    return host, path, best[1], best[2]


def judge(spark, urls, rules):
    pages = spark.createDataFrame([(k, u, "own") for k, u in enumerate(urls)], "page_id long, url string, rule string")
    found, names = urlfilter.judge(pages, spark.createDataFrame(rules, "host string, path string, verdict string"))
    assert names[2] == "rule_"
    return {r.page_id: tuple(r[n] for n in names) for r in found.collect()}


def test_contract_rules(spark):
    urls = [None, "", "x", "http://", "HTTP://WWW.Example.COM/en/1", "https://m.example.com/en/", "https://example.com/en", "https://a.net/es/x?y#z", "http://net/fr/", "http://mynet/fr/", "http://x.com?/", "http://x.com/#a", "a://b://c.com/", "http://com/", "http://é.example.com/fr/é", "http://a..com/\n"]
    got = judge(spark, urls, URL_RULES)
    assert got == {k: plain(u, URL_RULES) for k, u in enumerate(urls)}


def test_long_list_is_exact(spark):
    rules = [(f"h{k}.example", f"/{k % 7}/", "block" if k % 3 else "allow") for k in range(0, 3000, 2)]
    urls = [f"http://w{k % 5}.h{k}.example/{k % 7 if k % 11 else 9}/x" for k in range(6000)] * 2
    got = judge(spark, urls, rules)
    by_host = {h: (h, p, v) for h, p, v in rules}
    for k, u in enumerate(urls):
        own = by_host.get(u.split("/")[2].split(".", 1)[1])
        assert got[k] == plain(u, [own] if own else []), u


def test_empty_tables(spark):
    assert judge(spark, [], URL_RULES) == {}
    assert judge(spark, ["http://a.com/"], []) == {0: ("a.com", "/", None, "allow")}


def test_block_wins_over_allow_for_one_key(spark):
    assert judge(spark, ["http://a.com/"], [("a.com", "/", "allow"), ("a.com", "/", "block")])[0][3] == "block"


def test_hashes_are_independent(spark):
    h1, h2 = urlfilter.hashes_of(F.col("key"))
    rows = spark.range(1000).select(F.col("id").cast("string").alias("key")).select(h1.alias("a"), h2.alias("b"), F.xxhash64("key", F.lit(1)).alias("c")).collect()
    assert len({r.b for r in rows}) == 1000 and all(r.b not in (r.a, r.c) for r in rows)


@pytest.mark.parametrize("different", [1, 3])
def test_equal_hashes_end_and_stay_exact(spark, monkeypatch, different):
    """All keys, or a third of them, hash alike: the keys themselves decide."""
    few = lambda key: F.pmod(F.xxhash64(key), F.lit(different)).cast("bigint")
    monkeypatch.setattr(urlfilter, "hashes_of", lambda key: (few(key), few(key) + 7))
    urls = [f"http://{a}example.com/{p}/" for a in ("", "www.", "m.") for p in ("en", "fr", "")] + ["http://a.net/es/x", "http://a.net/de/", "http://b.org/", "http://net/fr/", None]
    assert judge(spark, urls, URL_RULES) == {k: plain(u, URL_RULES) for k, u in enumerate(urls)}


def test_very_long_urls(spark):
    urls = ["http://" + "a." * 50_000 + "example.com/en/" + "x" * 200_000, "http://net/" + "fr/" * 100_000]
    assert judge(spark, urls, URL_RULES) == {k: plain(u, URL_RULES) for k, u in enumerate(urls)}
