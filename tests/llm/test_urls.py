import numpy as np
import pytest

from basketseq.llm import urls
from tests.llm import edge  # noqa: F401

CASES = [
    # url, host, path, rule, verdict of the rule
    ("http://Example.ORG/es/1?x=/de/#y", "example.org", "/es/1", "example.org/es/", "block"),
    ("https://a.b.example.org/en/12", "a.b.example.org", "/en/12", "example.org/en/1", "block"),
    ("https://a.example.org/en/2", "a.example.org", "/en/2", "org/", "allow"),
    ("https://notexample.org/es/2", "notexample.org", "/es/2", "org/", "allow"),
    ("http://x.com/de/", "x.com", "/de/", "com/de/", "block"),
    ("http://x.com/de", "x.com", "/de", None, None),
    ("http://com/fr/9", "com", "/fr/9", "com/fr/", "allow"),
    ("http://x.org", "x.org", "", None, None),
    ("http://x.org?/q", "x.org", "", None, None),
    ("a://b://c.org/d", "b:", "//c.org/d", None, None),
    ("ÀB://ÀB.ORG/Ç", "Àb.org", "/Ç", "org/", "allow"),
    ("http://x.org/a\nb?c", "x.org", "/a\nb", "org/", "allow"),
    ("no scheme/org/", "", "", None, None),
    (None, "", "", None, None),
    ("", "", "", None, None),
    ("://", "", "", None, None),
    ("http://x.net/" + "a" * 60_000, "x.net", "/" + "a" * 60_000, None, None),
]


def test_edge_rows(spark):
    rows = [(i, c[0], "x", "y", "z") for i, c in enumerate(CASES)] * 2
    schema = "page_id long, url string, host string, row string, rule string"
    found = urls.judged_urls(spark.createDataFrame(rows, schema)).collect()
    assert len(found) == 2 * len(CASES)
    weights, bias = urls.trained()
    for r in found:
        url, host, path, rule, verdict = CASES[r.row.page_id]
        assert (r.host, r.path, r.rule) == (host, path, rule) == (*urls.url_parts(url), rule)
        p = urls.block_probability(host, path, weights, bias)
        assert r.probability == pytest.approx(p)
        assert r.verdict == (verdict or ("block" if p > 0.5 else "allow"))
    assert urls.judged_urls(spark.createDataFrame([], schema)).count() == 0


def test_query_equals_brute_force(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url")
    weights, bias = urls.trained()
    for r in urls.judged_urls(pages).collect():
        host, path = urls.url_parts(r.row.url)
        fits = [
            (len(h + p), h + p, v)
            for v, h, p in urls.RULES
            if (host == h or host.endswith("." + h)) and path.startswith(p)
        ]
        learned = "block" if urls.block_probability(host, path, weights, bias) > 0.5 else "allow"
        want = max(fits)[1:] if fits else (None, learned)
        assert (r.rule, r.verdict) == want


def test_the_model_generalises():
    hosts = {url.split("//")[1].split("/")[0].removeprefix("www."): b for url, b in urls.LABELLED}
    truth, guess = [], []
    for host, blocked in hosts.items():
        rest = [(u, b) for u, b in urls.LABELLED if host not in u]
        weights, bias = urls.trained(rest)
        truth.append(blocked)
        guess.append(urls.block_probability(host, "/en/5", weights, bias) > 0.5)
    assert np.mean(np.array(truth) == np.array(guess)) > 0.75


def test_training_table_is_bounded():
    with pytest.raises(ValueError):
        urls.trained([])
