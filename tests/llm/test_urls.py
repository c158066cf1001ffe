"""URL rules against brute force."""

import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from excursio.llm import url_filters

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
RULES = [
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"),
    ("net", "/fr/", "block"), ("", "", "allow"), ("a.b.c", "", "block"), ("b.c", "/x/y", "allow"), ("c", "/x/y/z/0", "block"),
    ("b.c", "/x/y", "block"), (None, "/", "block"), ("org", None, "block"), ("org", "/", None), ("org", "/", "odd"),
]


def brute(url, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        m = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1], re.S)
        host, path = m[1].translate(LOWER), m[2]
    best = None
    for rule_host, rule_path, verdict in RULES:
        if rule_host is None or rule_path is None or verdict not in ("allow", "block"):
            continue
        if (rule_host in ("", host) or host.endswith("." + rule_host)) and path.startswith(rule_path):
            rank = (len(rule_host) + len(rule_path), len(rule_host), verdict == "block")
            if best is None or rank > best[0]:
                best = rank, rule_host + rule_path, verdict
    return host, path, best and best[1], best[2] if best else default


URLS = [
    None, "", "no scheme", "://", "http://", "http://COM", "http://com/", "http://com?x=/", "x://y.net/es/#a", "http://WWW.Example.com/en/1",
    "http://a.www.example.com/en/1?q", "http://xexample.com/en/1", "http://net./es/", "http://q://r.net/fr/", "http://a\nb.com/x\ny",
    "http://a.b.c/x/y/z/0", "http://b.c/x/y/z/0/1", "http://z.b.c/x/y", "http://c/x/y/z/0", "http://é.C/x/y/z/0", "http://user@h.com:80/p",
    "http://x" * 500,
]


def test_odd_urls_and_a_hot_host(spark):
    rows = [(k, u, "h", "p", "r", "v", "f") for k, u in enumerate(URLS)] + [(0, URLS[-1], "h", "p", "r", "v", "f")] * 2
    rows += [(1000 + k, f"https://hot.example.com/{'en' if k % 3 else 'de'}/{k}", None, None, None, None, None) for k in range(2000)]
    rows += [(None, "http://a.net/es/1", None, None, None, None, None)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, host string, path string, rule string, verdict string, filter string").repartition(4)
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    for sample in (url_filters.SAMPLE, 50):
        got = url_filters.judged(pages, rules, sample=sample)
        assert got.columns == ["page_id", "url", "host", "path", "rule", "verdict", "filter"]
        want = Counter((r[0], r[2], *brute(r[1])) for r in rows)
        assert Counter((r.page_id, r.host, *r.filter) for r in got.collect()) == want
    assert url_filters.judged(pages.limit(0), rules).count() == 0
    assert {r.filter.verdict for r in url_filters.judged(pages, rules.limit(0), default="block").collect()} == {"block"}


@given(st.lists(st.sampled_from(["com", "net", "a", "b", "c", "www", "example", ""]), max_size=5), st.sampled_from(["", "/", "/en/", "/es/x", "/x/y", "/x/y/z/0"]))
@settings(max_examples=200, deadline=None)
def test_stack_finds_the_longest_rule(labels, path):
    host = ".".join(labels)
    key = lambda h: ".".join(reversed(h.split("."))) + "." if h else ""
    stack = url_filters.Stack()
    known = [r for r in RULES if r[0] is not None and r[1] is not None and r[2] in ("allow", "block")]
    for k, p, v in sorted((key(h), p, v) for h, p, v in known):
        if k <= key(host):
            stack.add(k, p, v)
    stack.move_to(key(host))
    best = stack.best(path)
    want = brute(f"http://{host}{path}")
    assert (None if best is None else (".".join(reversed(best[0].split(".")[:-1])) + best[1], best[2])) == (None if want[2] is None else want[2:])
