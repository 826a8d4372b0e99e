"""Hosts, paths and rules against a plain version; templates, merging and purity on planted sites; odd inputs."""

from __future__ import annotations

import re

import pytest
from llm_tables import SMALL

from tidyledger.llm.url_filter import MAX_CHILDREN, RULES, judge


def plain(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = host.translate({c: c + 32 for c in range(65, 91)})
    fits = [r for r in RULES if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
    best = max(fits, key=lambda r: len(r[1] + r[2]), default=None)
    return host, path, best and best[1] + best[2], best and best[0]


@pytest.fixture
def pages(spark):
    def make(*urls):
        return spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")

    return make


ODD = [
    None, "", "x", "://", "http://", "a://b://c", "http://EXAMPLE.org/es/x", "http://example.org/en/1", "http://example.org/en/19?x#y",
    "http://example.org", "http://org/", "http://xorg/", "http://x.org?/es/", "http://sub.example.org/es/", "HTTP://É.COM/fr/", "http://a.com/de/",
    "http://a.com/de", "http://a.com/xx", "http://a.net/de/1", "//a.com/de/", "http://a.com#/de/", "http://a.com/fr/\nx", "http://notexample.org/es/",
    "http://" + "a" * 5000 + ".com/" + "b/" * 5000, "http://user@h.org:80/es/", " http://b.org/ ",
]


def test_rules(pages):
    rows = {r.page_id: r for r in judge(pages(*ODD)).collect()}
    assert len(rows) == len(ODD)
    for i, url in enumerate(ODD):
        host, path, rule, verdict = plain(url)
        assert (rows[i].host, rows[i].path, rows[i].rule) == (host, path, rule), url
        assert rows[i].verdict == verdict if verdict else rows[i].verdict in ("allow", "block")


def test_on_pages(spark):
    table = spark.read.parquet(f"{SMALL}/pages.parquet")
    rows = {r.page_id: r for r in judge(table).collect()}
    urls = {r.page_id: r.url for r in table.collect()}
    assert rows.keys() == urls.keys()
    for i, url in urls.items():
        host, path, rule, verdict = plain(url)
        assert (rows[i].host, rows[i].path, rows[i].rule) == (host, path, rule)
        assert verdict is None or rows[i].verdict == verdict


def test_variable_segments_become_wildcards(pages):
    urls = [f"http://h.net/item/{w}/view" for w in ("ab", "cd", "ef", "gh", "ij")] + ["http://h.net/about", "http://h.net/n/1", "http://h.net/n/22.html"]
    urls += [f"http://h.net/a/b/c/d/e{i}/f" for i in range(2)]
    urls += [f"http://big.net/{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(MAX_CHILDREN + 1) for _ in range(3)]
    rows = {r.page_id: r.template for r in judge(pages(*urls)).collect()}
    assert {rows[i] for i in range(5)} == {"item/*/view"}
    assert [rows[i] for i in range(5, 8)] == ["about", "n/#", "n/#.html"]
    assert rows[8] == rows[9] == "a/b/c/d/**"
    assert {rows[i] for i in range(10, len(urls))} == {"*"}


def test_templates_are_rejected_by_purity(pages):
    """com: /de/ is blocked and /fr/ allowed; pages without a rule follow their branch and site."""
    bad = ["http://bad.com/de/1"] * 60 + ["http://bad.com/xx/1"]
    good = ["http://good.com/fr/1"] * 60 + ["http://good.com/xx/1"]
    rows = judge(pages(*bad, *good)).collect()
    verdict = {(r.host, r.template): r.verdict for r in rows}
    assert verdict["bad.com", "xx/#"] == "block" and verdict["good.com", "xx/#"] == "allow"


def test_similar_siblings_are_merged_and_different_ones_are_not(pages):
    site = "http://m.example.org"
    urls = [f"{site}/en/1"] * 40 + [f"{site}/en/x"] * 40 + [f"{site}/en/y"] * 40
    purity = {r.template: r.purity for r in judge(pages(*urls)).collect()}
    assert purity["en/x"] == purity["en/y"] > 0.9 > 0.3 > purity["en/#"]


def test_odd_tables(pages):
    assert judge(pages("x").filter("false")).count() == 0
    same = judge(pages("http://a.net/x", "http://a.net/x").selectExpr("1L as page_id", "url", "1 as host", "2 as n", "3 as segs", "4 as verdict"))
    assert [tuple(r)[:5] for r in same.collect()] == [(1, "a.net", "/x", None, "allow")] * 2


def test_main_path_is_native(pages):
    plan = judge(pages("http://a.net/x"))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
