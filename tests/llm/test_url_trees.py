import re

import pytest

from riskloom.llm import url_trees as U
from tests.conftest import SF_SMALL

URLS = [
    "http://A.Example.ORG/es/x?q=1#f", "https://example.org/en/12", "https://example.org/en/2", "http://www.example.com/fr/1",
    "http://example.com/de/2.html", "http://com/de/", "http://xcom/de/", "http://m.example.net/en/1?a=1&b=2", "http://example.org", "http://example.org?x=/es/",
    "//example.org/es/", "example.org/es/", "ftp://u:p@h.org:80/es/", "http:///de/", "http://é.com/fr/é?ü#ß", "http://a://b.org/x", "", None, "http://x.net/" + "a1%" * 20_000,
]


def brute(url):
    if not url or "://" not in url:
        return "", "", None, None
    rest = url[url.index("://") + 3 :]
    host = re.match("[^/?#]*", rest)[0]
    path = re.match("[^?#]*", rest[len(host) :])[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fit = [(h + p, v) for v, h, p in U.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *max(fit, key=lambda r: len(r[0]), default=(None, None)))


def test_parts_and_rules(spark):
    rows = list(enumerate(URLS))
    got = {r.page_id: r for r in U.judge(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    for i, url in rows:
        host, path, rule, verdict = brute(url)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule), url
        assert got[i].verdict == verdict if verdict else got[i].verdict in ("allow", "block")
        assert 0 <= got[i].score <= 1


def test_trees_learn_the_labels(spark):
    pages = spark.read.parquet(f"{SF_SMALL.replace('0.001', '0.01')}/pages.parquet")
    got = U.judge(pages).filter("rule is not null").collect()
    right = sum((r.score >= U.BLOCK_AT) == (r.verdict == "block") for r in got)
    assert len(got) > 60 and right / len(got) > 0.85


def test_features(spark):
    df = spark.createDataFrame([(1, "http://a-b.org/x/y.html?p=1&q=22#t"), (2, None)], "page_id long, url string")
    got = {r.page_id: r for r in U.with_features(U.with_parts(df)).collect()}
    a = got[1]
    assert (a.depth, a.n_params, a.n_hyphens, a.longest_number, a.has_fragment, a.file_ending, a.suffix) == (2, 2, 1, 2, 1, 1, "org")
    assert abs(a.digit_ratio - 3 / 34) < 1e-9 and 3 < a.entropy < 5
    assert got[2].url_length == 0 and got[2].entropy == 0


@pytest.mark.parametrize("one_label", [True, False])
def test_odd_tables(spark, one_label):
    schema = "page_id long, url string, html string, host int, score string"
    rows = [(None, "http://x.org/1", "", 1, "s"), (1, "http://x.org/1", "", 1, "s"), (1, "http://x.org/1", None, None, None)] if one_label else []
    got = U.judge(spark.createDataFrame(rows, schema)).collect()
    assert len(got) == len(rows) and all(r.verdict == "allow" and r.score == 0 for r in got)


def test_repeated_urls_do_not_crowd_out_the_fit(spark, monkeypatch):
    monkeypatch.setattr(U, "FIT_ROWS", 200)
    hosts = ["a.org", "x.com", "b.org", "example.org"]
    rows = [(i, f"http://{hosts[i % 4]}/{('fr', 'de', 'es', 'en/1')[i % 4]}/{i}") for i in range(300)]
    rows += [(1_000 + i, "http://x.com/de/hot") for i in range(1_000)]
    pages = U.with_parts(spark.createDataFrame(rows, "page_id long, url string"))
    got = U.judge(pages.select("page_id", "url")).collect()
    assert any(r.score > 0 for r in got)
    ruled = [r for r in got if r.rule is not None]
    assert {r.verdict for r in ruled} == {"allow", "block"}
