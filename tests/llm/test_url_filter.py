import random
import time

from runoff.llm import url_filter as U
from runoff.llm.queries import QUERIES, RULES
from tests.llm.helpers import SF


def brute(url, rules, default="allow"):
    host, path = "", ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        n = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
        host, rest = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:n]), rest[n:]
        n = next((i for i, c in enumerate(rest) if c in "?#"), len(rest))
        path = rest[:n]
    fit = [(len(h) + len(p), len(h), v == "block", h + p, v) for v, h, p in rules
           if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fit)[3:] if fit else (None, default)))


def test_trie_equals_brute_force():
    rng = random.Random(1)
    labels, segments = ["a", "b", "org", "", "x1"], ["", "a", "ab", "en", "1", "en1"]

    def host():
        return ".".join(rng.choice(labels) for _ in range(rng.randrange(1, 4)))

    def path():
        return rng.choice(["", "/"]) + "/".join(rng.choice(segments) for _ in range(rng.randrange(3)))

    for _ in range(300):
        rules = [(rng.choice(["allow", "block"]), host(), path()) for _ in range(rng.randrange(12))]
        trie = U.Trie(rules)
        for _ in range(20):
            url = rng.choice(["http://", "://", "x", "https://u://"]) + host().title() + path() + rng.choice(
                ["", "?q=/a", "#/en", "/?#"])
            h, p = U.host_and_path(url)
            assert (h, p, *(trie.match(h, p) or (None, "allow"))) == brute(url, rules), (url, rules)


def test_query_equals_brute_force(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    want = sorted((r.page_id, *map(str, brute(r.url, RULES))) for r in pages)
    got = QUERIES["op10_url_filter"](spark, SF)
    assert got.columns == ["page_id", "host", "path", "rule", "verdict"]
    assert sorted((r[0], *map(str, r[1:])) for r in got.collect()) == want


def test_long_paths_take_no_longer_than_their_length():
    trie = U.Trie(RULES + [("block", "org", "/" + "x" * 300), ("block", "org", "")])
    for path in ("/" + "x" * 3_000_000, "/" + "y/" * 300_000, "/e" * 300_000, ""):
        began = time.perf_counter()
        got = trie.match("a.org", path)
        assert time.perf_counter() - began < 3
        assert got == brute("http://a.org" + path, RULES + [("block", "org", "/" + "x" * 300), ("block", "org", "")])[2:]


def test_rows(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://A.ORG", "http://a.org/", "http://é.org/ö?x", "http://" + "a" * 50_000 + ".com/de/"]
    df = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)] * 2, "page_id long, url string, host string")
    out = U.judge_urls(df, RULES, default="review")
    assert out.columns == ["page_id", "url", "host", "path", "rule", "verdict"]
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in out.collect()}
    assert got == {i: brute(u, RULES, "review") for i, u in enumerate(urls)}
    assert U.judge_urls(df.limit(0), RULES).collect() == [] and U.judge_urls(df, []).count() == 16
