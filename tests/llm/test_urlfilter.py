import random

from tidemark.llm import urlfilter
from tidemark.llm.urlfilter import judge_urls

RULES = [("net", "/", "block"), ("example.net", "/a/", "allow"), ("b.example.net", "/", "block"), ("example.net", "/a/b", "block"),
         ("xample.net", "/a/", "block"), ("net", "/a/b/c/d/e/f/g/h/i", "allow"), ("a-b.org", "/", "block"), ("org", "/q", "block")]


def _plain(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(c.lower() if c.isascii() else c for c in rest[:cut])
    path = rest[cut:]
    path = path[:min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    fits = [(len(h + p), h + p, v) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, max(fits)[1], max(fits)[2]) if fits else (host, path, None, "allow")


def test_rules_against_a_plain_loop(spark, monkeypatch):
    random.seed(3)
    hosts = ["net", "example.net", "B.EXAMPLE.net", "www.b.example.net", "xample.net", "example.net.", "a-b.org", "x.a-b.org", "a.org", "org", "", "ÄÖ.org",
             "x\x01a.org", "example.net:80"]
    paths = ["", "/", "/a", "/a/", "/a/b", "/a/b/c/d/e/f/g/h/ijk", "/q?x=/a/", "#/a/", "?://net/", "/A/", "/" + "z" * 5000]
    urls = [f"{random.choice(['http', 'https', ''])}://{random.choice(hosts)}{random.choice(paths)}" for _ in range(1500)]
    urls += [None, "", "net/a/", "://", "http:/net/"] + ["http://net/hot"] * 800
    df = spark.createDataFrame([(i, u, "kept out") for i, u in enumerate(urls)], "page_id long, url string, verdict string")
    rules = spark.createDataFrame(RULES + [("org", None, "block")], "host string, path string, verdict string")
    for range_rows, ranges in ((50, 1024), (50, 3), (100_000, 1024)):  # with three ranges each is shared out
        monkeypatch.setattr(urlfilter, "_RANGES", ranges)
        found = judge_urls(df, rules, range_rows=range_rows)
        assert found.columns == ["page_id", "host", "path", "rule", "verdict"]
        assert {r[0]: tuple(r)[1:] for r in found.collect()} == {i: _plain(u) for i, u in enumerate(urls)}
    assert judge_urls(df, rules.limit(0), default="block").select("rule", "verdict").distinct().collect() == [(None, "block")]
    assert judge_urls(df.limit(0), rules).collect() == []


def test_repeated_and_nameless_rows(spark):
    df = spark.createDataFrame([(1, "http://net/"), (1, "http://net/"), (None, "http://net/")], "page_id long, url string")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    assert sorted((r["page_id"], r["verdict"]) for r in judge_urls(df, rules).collect() if r["page_id"]) == [(1, "block")] * 2
    assert judge_urls(df, rules).filter("page_id IS NULL AND verdict = 'block'").count() == 1
