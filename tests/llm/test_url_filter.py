import pytest

from incidentlab.llm.queries import op3_url_filter
from incidentlab.llm.url_filter import LABELLED_URLS, RULES, judge_urls, train_url_model

URLS = [
    None, "", "nothing here", "http://a.net/x", "http://net/", "HTTP://A.NET/en/", "http://anet/x", "http://a.net",
    "http://x.example.net/en/25#top", "http://example.net/en", "http://example.net/en/", "https://WWW.Example.COM/de/1?a=b",
    "https://notexample.com/de/1", "http://example.com/DE/1", "ftp://b.org/fr/9", "http://b.org/fr", "http://b.org?x=/fr/",
    "http://b.org:80/fr/", "a://b://c.net/d", "://x.net/", "http:///net/", "http://é.NET/É", "http://a.net/\nb?c",
    "http://spam-farm.example.org/en/5", "https://casino-bonus.example.org/free", "x" * 200_000 + "://a.net/b",
    "http://a.org/" + "y" * 100_000,
]


def plain(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host, path, in_host = "", "", True
    for c in rest:
        if c in "?#":
            break
        if c == "/":
            in_host = False
        if in_host:
            host += c.lower() if "A" <= c <= "Z" else c
        else:
            path += c
    return host, path


def plain_rule(host, path):
    fit = [(len(h + p), h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit)[1:] if fit else (None, None)


@pytest.fixture(scope="module")
def model(spark):
    return train_url_model(spark)


def test_brute_force(spark, model):
    pages = spark.createDataFrame(
        [(i, u, "h", "p", "r") for i, u in enumerate(URLS)] + [(None, URLS[3], "h", "p", "r")] * 2,
        "page_id long, url string, host string, path string, rule string",
    )
    got = judge_urls(pages, model)
    assert got.columns == ["page_id", "host", "path", "rule", "verdict", "block_score"]
    rows = got.collect()
    assert len(rows) == len(URLS) + 2
    for r in rows:
        url = URLS[3 if r.page_id is None else r.page_id]
        assert (r.host, r.path) == plain(url), url
        rule, verdict = plain_rule(r.host, r.path)
        assert r.rule == rule
        assert r.verdict == (verdict or ("block" if r.block_score >= 0.5 else "allow"))


def test_model_fits_its_table(spark, model):
    pages = spark.createDataFrame([(y, u) for y, u in LABELLED_URLS], "page_id int, url string")
    assert all((r.block_score >= 0.5) == bool(r.page_id) for r in judge_urls(pages, model, rules=()).collect())


def test_unseen_urls(spark, model):
    pages = spark.createDataFrame(
        [(1, "https://m.spam-farm.example.org/es/77"), (1, "http://best-casino.example.org/win"), (0, "https://blog.example.org/en/31")],
        "page_id int, url string",
    )
    assert all((r.verdict == "block") == bool(r.page_id) for r in judge_urls(pages, model).collect())


def test_empty_and_native(spark, model):
    empty = judge_urls(spark.createDataFrame([], "page_id long, url string"), model)
    assert empty.count() == 0
    plan = empty._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_registered_query(spark):
    rows = op3_url_filter(spark, "/root/testdata/sf0.001").collect()
    want = {r.page_id: plain(r.url) for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()}
    assert {r.page_id: (r.host, r.path) for r in rows} == want
