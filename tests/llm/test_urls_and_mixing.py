"""URL filters and source mixing against brute force."""

import math
import re

import pytest
from pyspark.sql import functions as F

from dockpulse.llm import source_mixing, url_filter
from tests.llm.rows import documents, edge_rows

URLS = [
    "http://a.example.org/en/123", "https://EXAMPLE.org/es/", "http://example.org/es", "http://x.com/fr/1", "http://com/de/", "http://xcom/de/",
    "http://b.com/de/?q#f", "http://example.org/en/2", "http://notexample.org/es/1", "no scheme", None, "", "http://", "http://host", "http://host?x=1",
    "http://host#top", "ftp://u:p@Host.NET:80/A/b?c#d", "http://spam-farm.example.net/x", "http://www.cheap-pills.example.net/", "http://a.net/login?x",
    "http://a.net/x?PHPSESSID=1", "http://a.net/x?phpsessid=1", "a://b://c.org/", "http://example.org/en/1", "http://org/en/1", "http://é.org/ü?ß",
]


def brute(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    raw = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(raw) :])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in raw)
    listed = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]
    fits = [(len(h + p), h + p, v) for h, p, v in listed if (host == h or host.endswith("." + h)) and path.startswith(p)]
    target = host + rest[len(raw) :]
    blocked = any(r.verdict == "block" and re.search(r.regex, target) for r in url_filter.PATTERN_RULES)
    return host, path, max(fits)[1] if fits else None, max(fits)[2] if fits else "block" if blocked else "allow"


def test_urls(spark):
    pages = spark.createDataFrame([(i % 20 or None, u, "h", "r", "v") for i, u in enumerate(URLS * 2)], "page_id long, url string, host string, rule string, token string")
    found = url_filter.judge_urls(pages).select("page_id", "host", "path", "rule", "verdict").collect()
    want = [(i % 20 or None, *brute(u)) for i, u in enumerate(URLS * 2)]
    assert sorted(map(tuple, found), key=str) == sorted(want, key=str)


def test_no_pages(spark):
    assert url_filter.judge_urls(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_rules_are_indexed_by_their_rarest_token(spark):
    urls = spark.createDataFrame([(["cheap", "example"],)] * 3 + [(["pills"],)], "tokens array<string>")
    rows = {r.name: r.token for r in url_filter.rule_index(urls, url_filter.PATTERN_RULES).collect()}
    assert rows["cheap pills"] == "pills" and rows["login page"] in ("login", "signin")
    with pytest.raises(ValueError, match="no literal token"):
        url_filter.rule_index(urls, (url_filter.UrlRule("any", "x", (), "block"),))


def test_long_urls(spark):
    long = "https://shop.example.com/" + "a/" * 50_000
    pages = spark.createDataFrame([(1, long + "login"), (2, long), (3, "https://x.org/?q=" + "b" * 100_000)], "page_id long, url string")
    rows = {r.page_id: (r.verdict, r.pattern) for r in url_filter.judge_urls(pages).collect()}
    assert rows == {1: ("block", "login page"), 2: ("allow", None), 3: ("allow", None)}


def mixing_rows(spark):
    texts = [f"w{i} " * (1 + i % 7) for i in range(300)]
    sources = ["big" if i % 3 else "small" if i % 2 else None for i in range(300)]
    return documents(spark, texts, sources=sources), texts, sources


def test_quotas_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(source_mixing, "GROUP_DOCUMENTS", 16)
    docs, texts, sources = mixing_rows(spark)
    rows = source_mixing.mixture(docs, 2.0, block_tokens=100).collect()
    tokens = {s: sum(len(t.split()) for t, x in zip(texts, sources, strict=True) if x == s) for s in set(sources)}
    power = min(i for i in range(1025) if (max(tokens.values()) / min(tokens.values())) ** (1 - i / 1024) <= 2.0) / 1024
    scale = max(t / t**power for t in tokens.values())
    most = max(len(t.split()) for t in texts)
    for source, own in tokens.items():
        mine = [r for r in rows if r.source == source]
        quota = max(own, own**power * scale)
        assert quota <= sum(r.n_tokens for r in mine) + 1 < quota + most + 2
        assert {r.doc_id for r in mine if r.epoch == 0} == {i for i, s in enumerate(sources) if s == source}
        assert mine[0].weight == pytest.approx(own**power / sum(t**power for t in tokens.values()))
        at = 0
        for r in sorted(mine, key=lambda r: (r.tokens_before, r.n_tokens)):
            assert r.tokens_before == at
            at += r.n_tokens
    per_block = {}
    for r in rows:
        per_block.setdefault(r.block, {}).setdefault(r.source, []).append(r.n_tokens)
    assert all(set(b) == set(tokens) for b in per_block.values())


def test_entropy_target(spark):
    sources = spark.createDataFrame([("a", 900, 1), ("b", 90, 1), ("c", 10, 1)], "source string, tokens long, documents long")
    power = source_mixing.exponent(sources, None, min_entropy=1.2)

    def bits(a):
        p = [(t / 1000) ** a for t in (900, 90, 10)]
        return -sum(x / sum(p) * math.log2(x / sum(p)) for x in p)

    assert bits(power) >= 1.2 > bits(power + 1 / source_mixing.EXPONENT_STEPS)
    assert source_mixing.exponent(sources, None, min_entropy=2.0) == 0.0
    assert source_mixing.exponent(sources, None, min_entropy=0.1) == 1.0


def test_mixed_keeps_every_row_and_column(spark):
    texts, ids = edge_rows()
    docs = documents(spark, texts, ids, sources=[None if i % 4 == 0 else "s" if i % 2 else "t" for i in range(len(texts))])
    out = source_mixing.mixed(docs)
    assert out.columns == docs.columns
    before = {tuple(r) for r in docs.collect()}
    assert {tuple(r) for r in out.collect()} == before
    assert out.count() >= docs.count()
    assert source_mixing.mixed(documents(spark, [])).count() == 0
    empty = documents(spark, [None, "", "  "], sources=["a", "a", None])
    assert source_mixing.mixed(empty).count() == 3
    assert source_mixing.mixture(empty).where(F.col("block") != 0).count() == 0
