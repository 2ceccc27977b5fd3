from __future__ import annotations

import random
import re

import pytest

from cardloom.llm.queries import BLOCKED_GLOBS, URL_RULES
from cardloom.llm.url_filter import Automaton, Rule, judge_urls, split_url

URLS = [
    None, "", "no scheme", "http://", "https://A.Example.ORG/es/1", "https://example.org/es", "https://example.org/en/12?x#y",
    "http://notexample.org/es/", "http://x.com/de/y", "http://com/fr/", "http://x.com/fr", "http://casino.org/a", "http://mycasino.net",
    "http://x.net/casino/", "http://x.org", "http://x.org?a/b", "http://x.org#/", "http://x.org:80/", "://", "a://b://c/d",
    "http://ünï.example.org/es/ü", "http://x.net/.example.org/es/", "http://x.org/" + "a" * 70_000, "HTTP://X.COM/DE/",
]


def regex(glob):
    out = ""
    for part in re.split(r"(\*\*|\*|\?)", glob):
        out += {"**": "(?s:.*)", "*": "[^/]*", "?": "(?s:[^/])"}.get(part, re.escape(part))
    return re.compile(out.encode() if part is None else out)


def test_automaton_equals_regular_expressions():
    rng = random.Random(4)
    globs = ["", "a", "*", "**", "a*b", "a**b", "*.x/**", "a?c", "**ab**ba**", "/*/", "*a*a*a*"] + [
        "".join(rng.choice(["a", "b", "/", ".", "*", "**", "?"]) for _ in range(rng.randint(1, 9))) for _ in range(80)]
    texts = ["", "a", "/", "ab", "a/b", ".x/"] + ["".join(rng.choice("ab/.x") for _ in range(rng.randint(0, 14))) for _ in range(300)]
    found = Automaton(globs).matches([text.encode() for text in texts])
    for row, text in enumerate(texts):
        assert found[row].tolist() == [regex(glob).fullmatch(text) is not None for glob in globs], text


def slow(url):
    host, path = split_url(url)
    fits = [r for r in URL_RULES if f".{host}".endswith(f".{r.host}") and path.startswith(r.path)]
    if fits:
        best = max(fits, key=lambda r: len(r.name))
        return host, path, best.name, best.verdict
    bad = not host or re.search("casino|free-bets|cheap-pills|adult", host)
    return host, path, None, "block" if bad else "allow"


def test_rules(spark):
    pages = spark.createDataFrame([(i, url, "z") for i, url in enumerate(URLS * 2)], "page_id long, url string, rule string")
    got = judge_urls(pages, URL_RULES, BLOCKED_GLOBS)
    assert got.columns == ["page_id", "url", "host", "path", "rule", "verdict"]
    for r in got.collect():
        assert (r.host, r.path, r.rule, r.verdict) == slow(r.url), r.url
    assert judge_urls(pages.where("false"), URL_RULES, BLOCKED_GLOBS).count() == 0


@pytest.mark.parametrize("url, want", [
    ("http://A.b/C/d?e#f", ("a.b", "/C/d")), ("x://h#f?g/", ("h", "")), ("x://h?g/", ("h", "")), ("h/p", ("", "")), ("://É.B/x", ("É.b", "/x")),
])
def test_split(url, want):
    assert split_url(url) == want


def test_many_rules_take_several_words(spark):
    rules = [Rule("block" if i % 2 else "allow", f"host{i}.net", f"/p{i}/") for i in range(100)]
    pages = spark.createDataFrame([(f"http://a.host{i}.net/p{i}/x",) for i in range(100)], "url string")
    got = {r.rule: r.verdict for r in judge_urls(pages, rules, []).collect()}
    assert got == {rule.name: rule.verdict for rule in rules}


def test_no_rules(spark):
    pages = spark.createDataFrame([("http://a.net/",), (None,)], "url string")
    assert sorted((r.verdict, r.rule) for r in judge_urls(pages, [], []).collect()) == [("allow", None), ("block", None)]
