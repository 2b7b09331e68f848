import random
import re

from histdim.llm import url_filter

ENTRY = "list string, pattern string, at bigint, action string"
CAPTURE = "page_id bigint, url string, fetched bigint"


def brute(captures, entries):
    out = []
    for i, url, t in captures:
        m = re.match(r"(?i)^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]*)[^/?#]*([^?#]*)", url or "")
        host, path = (m[1].lower().rstrip("."), m[2]) if m else ("", "")
        hits = []
        for key in {(e[0], e[1]) for e in entries if None not in e}:
            past = [(at, action) for name, pattern, at, action in entries
                    if (name, pattern) == key and at is not None and t is not None and at <= t and action in ("add", "remove")]
            if not past or max(past)[1] != "add" or not host:
                continue
            p = key[1]
            if host == p or host.endswith("." + p) and "." in p or "/" in p and (
                    (host + path) == p or p.endswith("/") and (host + path).startswith(p)):
                hits.append(key[0])
        out.append((i, url, t, len(hits), ",".join(sorted(set(hits))), bool(hits)))
    return sorted(out, key=str)


def got(spark, captures, entries, **options):
    df = url_filter.judge(spark.createDataFrame(captures, CAPTURE).repartition(3), spark.createDataFrame(entries, ENTRY), **options)
    return sorted(map(tuple, df.collect()), key=str)


def test_against_brute_force(spark):
    rnd = random.Random(2)
    hosts = ["a.example.com", "b.a.example.com", "example.com", "x.org", "WWW.x.org", "u:p@y.net:80", "y.net."]
    paths = ["", "/", "/de/1.html", "/de/", "/de/x/y?q=/en/", "/en#/de/", "/DE/1"]
    captures = [(k, rnd.choice(["http://", "HTTPS://"]) + rnd.choice(hosts) + rnd.choice(paths), rnd.randrange(1000)) for k in range(300)]
    patterns = ["example.com", "a.example.com", "x.org", "org", "y.net", "x.org/de/", "a.example.com/de/1.html", "y.net/", "y.net/en"]
    entries = [(rnd.choice("pqr"), rnd.choice(patterns), rnd.randrange(1000), rnd.choice(["add", "add", "remove"])) for _ in range(150)]
    want = brute(captures, entries)
    assert sum(r[5] for r in want) > 50
    for slices in (1, 7, 64):
        assert got(spark, captures, entries, slices=slices) == want


def test_times_nulls_and_repeats(spark):
    captures = [(1, "http://h.com/", 10), (1, "http://h.com/", 10), (2, "http://h.com/", 9), (3, "http://h.com/", 20),
                (4, None, 10), (5, "http://h.com/", None), (None, "http://h.com/", 15), (6, "not a url", 10), (7, "", 10)]
    entries = [("l", "h.com", 10, "add"), ("l", "h.com", 20, "add"), ("l", "h.com", 20, "remove"), ("l", None, 1, "add"),
               (None, "h.com", 1, "add"), ("l", "h.com", None, "add"), ("m", "h.com", 1, "other")]
    want = brute(captures, entries)
    assert [r[0] for r in want if r[5]] == [1, 1, None]
    assert got(spark, captures, entries) == want
    assert got(spark, [], entries) == [] and not any(r[5] for r in got(spark, captures, []))


def test_timestamps(spark):
    c = spark.sql("select 1 page_id, 'http://h.com/a' url, timestamp'2024-01-02 00:00:00' fetched, 'x' pattern, 0 _slice")
    e = spark.sql("select 'l' list, 'h.com' pattern, timestamp'2024-01-01 00:00:00' at, 'add' action")
    assert url_filter.judge(c, e).first().blocked


def test_hosts_of_entries_are_normalised(spark):
    captures = [(1, "http://spam.example.com/A", 10), (2, "http://x.org/a", 10), (3, "http://x.org/A", 10)]
    entries = [("l", "Spam.Example.com", 1, "add"), ("l", "spam.example.COM.", 2, "add"), ("m", "X.org./A", 1, "add")]
    assert [r[3:5] for r in got(spark, captures, entries)] == [(1, "l"), (0, ""), (1, "m")]


def test_very_long_urls_take_linear_time(spark):
    """64 KB of slashes and of host labels; only patterns as deep as the list's are built."""
    import time
    deep = "http://x.org/" + "/".join("ab"[k % 2] for k in range(32000))
    wide = "http://" + ".".join("a" * (k % 3 + 1) for k in range(20000)) + ".x.org/de/1"
    captures = [(1, deep, 500), (2, wide, 500), (3, "http://x.org/a/b/", 500), (4, "http://x.org/a", 500)]
    entries = [("p", "x.org/a/b/", 1, "add"), ("q", "x.org", 1, "add"), ("r", "x.org/a", 1, "add")]
    began = time.perf_counter()
    rows = got(spark, captures, entries)
    assert time.perf_counter() - began < 30
    assert {r[0]: (r[3], r[4]) for r in rows} == {1: (2, "p,q"), 2: (1, "q"), 3: (2, "p,q"), 4: (2, "q,r")}


def test_patterns_of_single_labels_match_no_parent(spark):
    """Where the list names single labels alone, parent domains still have two."""
    captures, entries = [(1, "http://a.org/", 5), (2, "http://localhost/x", 5)], [("p", "org", 1, "add"), ("q", "localhost", 1, "add")]
    assert got(spark, captures, entries) == brute(captures, entries)
