import random

import numpy as np
import regex
from hypothesis import given, settings
from hypothesis import strategies as st

from chronovault.llm.url_filter import RULES, GlobAutomaton, url_verdicts


def glob_matches(glob, text):
    return regex.fullmatch("".join(".*" if c == "*" else "." if c == "?" else regex.escape(c) for c in glob), text, regex.S) is not None


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("ab*?#", max_size=70), min_size=1, max_size=6), st.lists(st.text("ab#", max_size=90), min_size=1, max_size=6))
def test_automaton_equals_globs(globs, texts):
    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    got = GlobAutomaton(globs).match(np.frombuffer(b"".join(raw), np.uint8), offsets)
    assert got.tolist() == [[glob_matches(g, t) for g in globs] for t in texts]


def judged(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = regex.match(r"[^/?#]*", rest).group()
    path = regex.match(r"[^?#]*", rest[len(host):]).group()
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def test_rules_by_brute_force(spark):
    rng = random.Random(3)
    hosts = ["example.com", "WWW.Example.com", "a.example.com", "notexample.com", "x.net", "net", "foo.org", "com", "É.com", "a.b#c", ""]
    paths = ["", "/", "/en/", "/en", "/es/1", "/fr/", "/es", "/x.net/es/", "?a=/en/", "#/en/", "/casino/x"]
    urls = [f"{s}://{h}{p}" for s in ("http", "") for h in hosts for p in paths] + [None, "", "no scheme", "a://b://c.com/en/", "http://casino-x.org/", "http://y.net/es/" + "z" * 20_000, "http://a.com/\n/x"]
    rng.shuffle(urls)
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)] + [(None, "http://a.net/fr/q", "x", "y"), (0, urls[0], "x", "y")], "page_id long, url string, host string, rule string")
    got = sorted((tuple(r) for r in url_verdicts(pages).collect()), key=str)
    want = []
    for page, url in [*enumerate(urls), (None, "http://a.net/fr/q"), (0, urls[0])]:
        host, path = judged(url)
        fits = [r for r in RULES if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
        best = max(fits, key=lambda r: len(r[1] + r[2]), default=None)
        bad = any(x in host for x in ("casino", "free-bets", "cheap-pills")) or "/login" in path or path.endswith(".exe")
        want.append((page, host, path, best and best[1] + best[2], best[0] if best else "block" if bad else "allow"))
    assert got == sorted(want, key=str)


def test_empty_table(spark):
    assert url_verdicts(spark.createDataFrame([], "page_id long, url string")).collect() == []
