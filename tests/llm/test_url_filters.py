"""URL rules against a plain version that tries every rule on every URL."""

import random
import re

import brute
from pyspark.sql import functions as F

from jobstrata.llm import url_filters

SITES = {
    "net/": "block",
    "example.net/en/": "allow",
    "Example.com/De": "block",
    "org": "allow",
    "a.org/x.y/": "block",
}
PATTERNS = {
    "^casino^": "block",
    "||ads.": "block",
    "|shop*.html|": "block",
    "*pay*": "block",
    "^casino^blog^": "allow",
    "a+b": "block",
}


def judged(spark, urls, sites=SITES, patterns=PATTERNS):
    rows = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    return url_filters.judge(rows, url_filters.rule_table(spark, sites, patterns))


def check(spark, urls):
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judged(spark, urls).collect()}
    assert got == {i: brute.url_verdict(u, SITES, PATTERNS) for i, u in enumerate(urls)}
    return got


def test_hand_made_urls(spark):
    got = check(
        spark,
        [
            None,
            "",
            "no scheme.net/",
            "http://net/",
            "http://net",
            "http://A.Example.NET/en/x?q#f",
            "http://b.xnet/en/",
            "HTTP://example.com/Detail",
            "HTTP://example.com/detail",
            "http://a.org?x",
            "http://aa.org/x.y/",
            "http://a.org/x.y/z",
            "http://a.org/xzy/z",
            "http://h.example/casino",
            "http://h.example/casinos",
            "http://x.casino/blog/",
            "http://ads.example/",
            "http://x.ADS.example/",
            "http://xads.example/",
            "http://shop.example/a.html?x",
            "http://my.shop.example/a.html",
            "http://h.example/xPAYx",
            "http://h.example/a+b",
            "http://h.example/aab",
            "http://é.example/casinoé",
            "://",
            "a://b://net/",
            "http://h.example/casino\n/x",
        ],
    )
    assert got[5][2:] == ("example.net/en/", "allow") and got[15][3] == "allow"


def test_random_urls_and_long_ones(spark):
    draw = random.Random(5)
    part = ["net", "org", "a", "example", "com", "casino", "ads", "pay", "De", "en", "x", "shop"]
    sign = ["/", ".", "-", "?", "#", "+", "", "://", "é"]
    urls = ["http://net/"] * 300 + ["http://" + "casino" * 5000 + "/", "http://x/" + "pay/" * 5000]
    for _ in range(600):
        words = (draw.choice(part) + draw.choice(sign) for _ in range(draw.randrange(8)))
        urls.append(draw.choice(["http://", "", "x://"]) + "".join(words))
    check(spark, urls)


def test_rules_are_filed_under_their_rarest_token(spark):
    urls = ["http://a.example.net/en/"] * 5 + ["http://example.net/"] * 5 + ["http://b.net/"]
    table = spark.createDataFrame([(u,) for u in urls], "url string")
    subject = F.concat(url_filters.host(F.col("url")), url_filters.path(F.col("url")))
    found = url_filters.index(
        url_filters.rule_table(spark, SITES, PATTERNS), table.select(subject.alias("subject"))
    )
    token = {r.rule: r.token for r in found.collect()}
    assert token["example.net/en/"] == "en" and token["net/"] == "net"
    assert token["*pay*"] == "" and token["||ads."] == "ads" and token["a.org/x.y/"] == "org"
    assert token["Example.com/De"] == "com"


def test_other_rule_tables_and_columns(spark, monkeypatch):
    urls = ["http://a.net/", None, "http://b/casino"]
    assert [r.verdict for r in judged(spark, urls, {}, {}).collect()] == ["allow"] * 3
    assert judged(spark, []).count() == 0
    rows = spark.createDataFrame(
        [("http://a.net/", "kept", 1), ("http://a.net/", "kept", 1), (None, None, None)],
        "url string, verdict string, subject int",
    )
    rules = url_filters.rule_table(spark, {"net/": "block", None: "block"}, {"*": None})
    out = url_filters.judge(rows, rules)
    assert out.columns == ["url", "subject", "host", "path", "rule", "verdict", "pattern"]
    want = sorted((r.subject, r.verdict) for r in out.where("url IS NOT NULL").collect())
    assert want == [(1, "block")] * 2 and out.count() == 3
    before = sorted(map(tuple, judged(spark, ["http://a.net/", "http://b/casino"]).collect()))
    monkeypatch.setattr(url_filters, "BROADCAST_BYTES", -1)
    after = sorted(map(tuple, judged(spark, ["http://a.net/", "http://b/casino"]).collect()))
    assert before == after
    assert not re.search("Python|Pandas", out._jdf.queryExecution().toString())
