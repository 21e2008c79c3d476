import re

import pytest

from ratelens.llm.urls import RULES, judged_urls, segmented


def expected(url):
    """Host, path and rule by the stated steps."""
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    path = re.split("[?#]", rest[len(host):], maxsplit=1)[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fit = [n + p for _, n, p in RULES if (host == n or host.endswith("." + n)) and path.startswith(p)]
    return host, path, max(fit, key=len, default=None)


URLS = ["http://a.example.net/en/1", "http://a.example.net/fr/1", "https://EXAMPLE.com/de/x?y#z", "http://org/fr/",
        "http://xorg/fr/", "http://example.net", "http://example.net?x", "http://a.org#frag", "no url", "", None,
        "://", "http://a\nb.net/x\ny", "http://É.net/", "http://a://b.net/en/", "ftp://u:p@host.com:80/de/1"]


@pytest.fixture
def pages(spark):
    def make(*urls):
        return spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)],
                                     "page_id long, url string, host string, verdict string")
    return make


def test_host_path_and_rule(pages):
    rows = judged_urls(pages(*URLS)).orderBy("page_id").collect()
    kinds = {n + p: v for v, n, p in RULES}
    for row, url in zip(rows, URLS, strict=True):
        assert (row.host, row.path, row.rule) == expected(url), url
        assert row.verdict == kinds[row.rule] if row.rule else row.verdict in ("allow", "block")


def test_query_same_rules_as_brute_force(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    urls = dict(pages.select("page_id", "url").collect())
    for row in judged_urls(pages).collect():
        assert (row.host, row.path, row.rule) == expected(urls[row.page_id])


def test_words_decide_where_no_rule_fits(pages):
    blocked = [f"http://pills{i}.cheap.net/buy/" for i in range(20)]
    allowed = [f"http://garden{i}.org/fr/tea" for i in range(20)]
    asked = ["http://cheappills.com/buy", "http://garden.com/tea"]
    rows = judged_urls(pages(*blocked, *allowed, *asked)).orderBy("page_id").collect()
    assert [r.verdict for r in rows[-2:]] == ["block", "allow"]
    assert rows[-2].words.split()[:2] == ["cheap", "pills"]


def test_segmentation():
    words = {"cheap": -3.0, "pills": -3.0, "a": -2.0}
    assert segmented("cheappills", words) == ["cheap", "pills"]
    assert segmented("", words) == []
    assert "".join(segmented("zqxw" * 30, words)) == "zqxw" * 30


def test_repeated_rows_null_ids_and_empty_table(spark, pages):
    twice = pages("http://a.net/", "http://a.net/").selectExpr("cast(null as long) as page_id", "url")
    assert [tuple(r)[:5] for r in judged_urls(twice).collect()] == [(None, "a.net", "/", "net/", "block")] * 2
    assert judged_urls(pages("x").limit(0)).collect() == []
