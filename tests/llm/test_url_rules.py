import random
import time

import pytest

from fiscalake.llm import url_rules


def host_path(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host, rest = rest[:end], rest[end:]
    end = min([rest.index(c) for c in "?#" if c in rest], default=len(rest))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), rest[:end]


def brute(url, rules, default="allow"):
    host, path = host_path(url)
    fits = [
        (h.count("."), len(p), h + p, a)
        for h, p, a in rules
        if host and (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    if not fits:
        return host, path, None, default
    best = max(fits)
    return host, path, best[2], best[3]


@pytest.fixture(scope="module")
def pages():
    rng = random.Random(5)
    hosts = ["a.net", "b.a.net", "c.b.a.net", "net", "x.org", "y.x.org", "ba.net", "é.net", "A.B.a.NET", "n.et"]
    paths = ["", "/", "/a", "/a/b", "/ab/c", "/a/b/c?q=/a", "?x", "#t", "/é/ü", "//", "/a\nb"]
    rows = [(i, f"http{'s' * (i % 2)}://{rng.choice(hosts)}{rng.choice(paths)}") for i in range(300)]
    return rows + [(300, None), (301, "no scheme"), (302, "://"), (303, ""), (300, None), (None, rows[0][1]), (304, "x" * 100_000), (305, "http://a.net/" + "a/" * 20_000)]


RULES = [
    ("net", "/", "block"), ("a.net", "/a", "allow"), ("a.net", "/a/b", "block"), ("b.a.net", "/", "allow"),
    ("x.org", "", "block"), ("org", "/a", "allow"), ("a.net", "/a/b/", "allow"), ("é.net", "/é", "allow"),
]


def test_against_brute_force(spark, pages):
    df = spark.createDataFrame([(i, u, "x", "y") for i, u in pages], "page_id long, url string, key string, URL string")
    odd = [(None, "/", "block"), ("a.net", None, "block"), ("a.net", "/zz", "maybe"), ("net", "/", "allow"), ("net", "/", "block")]
    rules = spark.createDataFrame([*RULES, *odd], "host string, path string, action string")
    got = url_rules.judge(df, rules).collect()
    assert sorted(map(repr, (tuple(r) for r in got))) == sorted(repr((i, *brute(u, RULES))) for i, u in pages)


def test_empty_tables(spark, pages):
    none = spark.createDataFrame([], "page_id long, url string")
    rules = spark.createDataFrame(RULES, "host string, path string, action string")
    assert url_rules.judge(none, rules).collect() == []
    some = spark.createDataFrame(pages[:3], "page_id long, url string")
    assert {r["verdict"] for r in url_rules.judge(some, rules.limit(0), "block").collect()} == {"block"}


def test_very_long_hosts(spark):
    hosts = ["a." * 30_000 + "a.net", ".".join(str(i) for i in range(20_000)), "." * 5000, "x" * 60_000 + ".org"]
    pages = [(i, f"http://{h}/a/b") for i, h in enumerate(hosts)]
    df = spark.createDataFrame(pages, "page_id long, url string")
    rules = spark.createDataFrame(RULES, "host string, path string, action string")
    start = time.monotonic()
    got = sorted(tuple(r) for r in url_rules.judge(df, rules).collect())
    assert got == [(i, *brute(u, RULES)) for i, u in pages]
    assert time.monotonic() - start < 40
