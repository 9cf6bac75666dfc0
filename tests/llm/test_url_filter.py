import random
from collections import Counter

import pytest

from quire.llm.queries import URL_RULES
from quire.llm.url_filter import judge_by_table, judge_urls, split_url

URLS = [None, "", "no scheme", "http://", "http:///en/x", "HTTP://WWW.Example.COM/en/a?q=/es/", "https://example.com/en", "https://example.com/en/", "https://notexample.com/en/x", "ftp://a.net:80/es/x", "http://a.net/es/x#y", "http://net/fr/", "http://com", "http://com/", "http://x.com?/en/", "a://b://c.com/", "http://u@www.example.com/en/?x", "http://ÄB.com/é", "http://a..com/", "http://.com/", "http://www.example.com./en/"]


def brute(urls, rules):
    out = []
    for i, url in urls:
        host, path = split_url(url)
        fits = [(len(h + p), len(h), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits, default=(0, 0, None, "allow"))
        out.append((i, host, path, best[2], best[3]))
    return Counter(out)


def many(seed):
    r = random.Random(seed)
    part = lambda: r.choice(["a", "b", "ab", "com", "a-b", "net"])
    host = lambda: ".".join(part() for _ in range(r.randint(1, 4)))
    path = lambda: "/" + "/".join(part() for _ in range(r.randint(0, 3)))
    rules = [(r.choice(["allow", "block"]), h, p) for h, p in {(host(), path()) for _ in range(60)}]
    return [(i, f"http://{host()}{path()}") for i in range(600)], rules


def test_splitting():
    assert split_url("a://b://c.com/") == ("b:", "//c.com/")
    assert split_url("http://x.COM?/en/") == ("x.com", "")
    assert split_url("https://e.com/a/b?c#d") == ("e.com", "/a/b")


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_matches_brute_force(spark, seed):
    urls, rules = (list(enumerate(URLS)), URL_RULES) if not seed else many(seed)
    pages = spark.createDataFrame([(i, u, "x", 1) for i, u in urls], "page_id long, url string, rule string, id int")
    want = brute(urls, rules)
    assert Counter(map(tuple, judge_urls(pages, rules).collect())) == want
    assert Counter(map(tuple, judge_by_table(pages, spark.createDataFrame(rules, "verdict string, host string, path string")).collect())) == want


def test_a_partition_is_swept_as_a_whole(spark):
    """More urls than an Arrow batch holds, in one partition, nested rules; null and repeated ids."""
    _, rules = many(4)
    urls = [(None if i % 7 == 0 else i % 50, f"https://{'a.' * (i % 4)}b.com/{'a/' * (i % 3)}") for i in range(2000)]
    rules += [("block", "com", "/"), ("allow", "b.com", "/a/"), ("block", "a.b.com", "/a/a/"), ("allow", "a.a.b.com", "/")]
    pages = spark.createDataFrame(urls, "page_id long, url string").coalesce(1)
    want = brute(urls, rules)
    assert Counter(map(tuple, judge_urls(pages, rules).collect())) == want
    assert Counter(map(tuple, judge_by_table(pages, spark.createDataFrame(rules, "verdict string, host string, path string")).collect())) == want


def test_rule_count_is_bounded_and_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    assert judge_urls(pages, URL_RULES).count() == 0
    with pytest.raises(ValueError):
        judge_urls(pages, URL_RULES, max_rules=2)
