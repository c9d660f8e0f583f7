from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa

from ledgerlake.llm.url_markov import RULES, MarkovModel, fit_filter, judge_urls, op3_url_markov


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :], re.S)[0]
    return "".join(c.lower() if c.isascii() else c for c in host), path


def rule(host, path):
    fits = []
    for name, verdict in RULES:
        domain, _, rest = name.partition("/")
        if (host == domain or host.endswith("." + domain)) and path.startswith("/" + rest):
            fits.append((len(name), name, verdict))
    return max(fits)[1:] if fits else (None, None)


def check(rows, got):
    assert len(got) == len(rows)
    urls = dict(rows)
    for r in got:
        host, path = split(urls[r["page_id"]])
        name, verdict = rule(host, path)
        assert (r["host"], r["path"], r["rule"]) == (host, path, name)
        assert r["verdict"] == verdict if name else r["verdict"] in ("allow", "block")


def test_whole_table_keeps_the_rules_and_tells_the_rest(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = [(r["page_id"], r["url"]) for r in pages.collect()]
    got = op3_url_markov(pages).collect()
    check(rows, got)
    assert {r["verdict"] for r in got if r["rule"] is None} == {"allow", "block"}


def test_held_out_urls_are_told_apart():
    good = [f"https://www.site{i}.example.com/de/{i * 7}.html" for i in range(400)]
    bad = [f"http://pills{i}.example.net/fr/{i * 3}?page=2" for i in range(400)]
    fitted = fit_filter(good[:300], bad[:300])
    assert (fitted.scores(pa.array(good[300:])) >= fitted.threshold).all()
    assert (fitted.scores(pa.array(bad[300:])) < fitted.threshold).all()


def test_probabilities_sum_to_one():
    model = MarkovModel.fit(["abcabd", "abx", "zz"])
    for context in (b"", b"ab", b"zzz", b"unseen"):
        urls = [context + bytes([b]) for b in range(256)]
        from ledgerlake.llm.url_markov import _grams

        data = np.frombuffer(b"".join(urls), np.uint8)
        n = len(context) + 1
        last = model.log_likelihood(_grams(data, np.arange(257) * n))[n - 1 :: n]
        assert math.isclose(np.exp(last).sum(), 1.0, rel_tol=1e-9)


ODD = [
    (1, None), (2, ""), (3, "no scheme.com/"), (4, "http://A.Example.COM/en/x?y#z"), (5, "http://www.example.com/en/"), (6, "http://example.com"),
    (7, "http://example.com/EN/"), (8, "ftp://x.net/es/1"), (9, "http://net/fr/"), (10, "http://notexample.com/en/"), (11, "a://b://c.net/fr/"),
    (12, "http://x.org?q=/en/"), (13, "http://ÄB.com/en/\nmore"), (14, "http://" + "x" * 50000 + ".org/"), (15, "http://example.com:80/en/"), (16, "http://x.com/en/" * 2),
]


def test_odd_urls_empty_table_and_clashing_columns(spark):
    df = spark.createDataFrame(ODD, "page_id long, url string")
    check(ODD, op3_url_markov(df).collect())
    clash = df.selectExpr("*", "'h' AS host", "1 AS score", "2 AS verdict", "'k' AS kept")
    got = judge_urls(clash).collect()
    check(ODD, got)
    assert all(r["kept"] == "k" and r["score"] != 1 or r["page_id"] for r in got)
    assert op3_url_markov(df.limit(0)).collect() == []
    only = spark.createDataFrame([(1, "http://x.org/a"), (1, "http://x.org/a")], "page_id long, url string")
    assert [r["verdict"] for r in op3_url_markov(only).collect()] == ["allow", "allow"]
