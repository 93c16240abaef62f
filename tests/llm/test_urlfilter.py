from __future__ import annotations

import math
import re
from collections import Counter

from millrace.llm import urlfilter
from millrace.llm._shared import Scratch


def brute(url):
    i = (url or "").find("://")
    if i < 0:
        return "", "", None, None
    rest = url[i + 3 :]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(h + p, v) for h, p, v in urlfilter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *(max(fits, key=lambda r: len(r[0])) if fits else (None, None))


ODD = [None, "", "abc", "://", "http://", "HTTP://A.COM", "http://A.Com/", "http://example.com/en/", "http://x.www.example.com/en/a?b", "http://anet/es/", "http://a.net/es/#://b", "x\n://WWW.Example.com/en/\n?q#f", "a://b://c/d", "http://É.net/fr/é", "http://com", "http://net/fr/" + "9" * 50_000]


def urls():
    good = [f"https://site{i % 7}.com/page/{i}" for i in range(60)]
    bad = [f"http://m.shop{i % 5}.net/es/{i * 7919}?a={i}&b=2" for i in range(60)]
    rest = [f"http://m.shop{i}.net/de/{i * 7919}?a={i}&b=2" for i in range(5)]
    return good + bad + rest + ODD


def test_rules_and_trees(spark):
    own = urls()
    df = spark.createDataFrame([(i, u, "h", "v") for i, u in enumerate(own + own)], "page_id long, url string, host string, verdict string")
    model = urlfilter.train(df, Scratch(spark, "t"))
    got = {}
    for r in urlfilter.judge(df, model, "page_id").collect():
        host, path, rule, verdict = brute(own[r.page_id % len(own)])
        assert (r.host, r.path, r.rule) == (host, path, rule), own[r.page_id % len(own)]
        assert r.verdict == verdict if rule else r.verdict in ("allow", "block")
        assert got.setdefault(r.page_id % len(own), r.verdict) == r.verdict
    # URLs without a rule go by their likeness to those with one
    assert [got[i] for i in range(120, 125)] == ["block"] * 5


def test_entropy(spark):
    df = spark.createDataFrame([("aabb",), ("",), ("abcd",)], "t string")
    assert [round(r[0], 6) for r in df.select(urlfilter._entropy(urlfilter.F.col("t"))).collect()] == [1.0, 0.0, 2.0]


def test_entropy_is_of_the_whole_url(spark):
    same = "http://" + "a" * 150 + ".com/" + "b" * 150
    own = [same, same + "?q=0123456789", same + "é漢😀" * 500, "http://" + "x" * 300 + "0123456789.net/", "http://a.net/" + "9" * 50_000]
    df = urlfilter.judged(spark.createDataFrame([(u,) for u in own], "url string"))

    def entropy(text):
        return -sum(c / len(text) * math.log2(c / len(text)) for c in Counter(text).values())

    got = {r.url: (round(r.entropy, 9), round(r.host_entropy, 9)) for r in urlfilter.features(df).collect()}
    assert got == {u: (round(entropy(u), 9), round(entropy(brute(u)[0]), 9)) for u in own}


def test_one_verdict_or_none(spark):
    df = spark.createDataFrame([(1, "http://a.com/"), (2, "ftp://b.org")], "page_id long, url string")
    assert {r.page_id: r.verdict for r in urlfilter.judge(df, urlfilter.train(df, Scratch(spark, "t")), "page_id").collect()} == {1: "allow", 2: "allow"}
    assert urlfilter.judge(df.limit(0), urlfilter.train(df.limit(0), Scratch(spark, "t")), "page_id").count() == 0
