from __future__ import annotations

import hashlib
import random
import re
import zlib
from fractions import Fraction

import pytest

from cardloom.llm import periodic_runs
from cardloom.llm.queries import REPEATED_WORDS


def brute_runs(words):
    """Every lag on its own: stretches of matches, then those whose lag is no smallest period go."""
    n, found = len(words), []
    for q in range(1, n):
        i = q
        while i < n:
            if words[i] != words[i - q]:
                i += 1
                continue
            first = i
            while i < n and words[i] == words[i - q]:
                i += 1
            start, length = first - q, i - first + q
            if length >= max(6, 4 * q):
                part = words[start:start + length]
                if not any(all(part[k] == part[k - p] for k in range(p, length)) for p in range(1, q)):
                    found.append((start, length, q))
    return sorted(found)


def brute_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if doc_id is not None:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n > 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    best = min(runs, key=lambda run: (-Fraction(run[1], run[2]), run[0], run[2]), default=None)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    sha = lambda one: hashlib.sha256(one.encode()).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)),
            sha(" ".join(word for i, word in enumerate(words) if i not in dropped)))


def check(docs):
    found = periodic_runs.digest(periodic_runs.with_runs(docs, repeat=REPEATED_WORDS))
    got = sorted((tuple(row) for row in found.collect()), key=str)
    assert got == sorted((brute_row(row.doc_id, row.text) for row in docs.collect()), key=str)
    return got


def test_given_documents(spark, documents):
    got = check(documents.where("length(text) < 6000"))
    assert sum(row[1] for row in got) > 0


def test_messy(messy, empty):
    check(messy.where("length(text) < 6000 OR text IS NULL"))
    clashing = messy.selectExpr("*", "1 AS runs", "2 AS collapsed", "3 AS _row", "4 AS _id")
    found = periodic_runs.with_runs(clashing)
    assert found.columns == [*messy.columns, "_row", "_id", "runs", "collapsed"]
    assert found.count() == messy.count()
    assert periodic_runs.digest(periodic_runs.with_runs(empty)).count() == 0


@pytest.mark.parametrize("seed", range(40))
def test_random_words(seed):
    rng = random.Random(seed)
    for _ in range(30):
        kind, n = rng.random(), rng.randrange(1, 130)
        words = [rng.choice("ab" if kind < 0.4 else "abcdefgh") for _ in range(n)]
        for _ in range(rng.randrange(4)):  # plant repeats, also in and over each other
            a = rng.randrange(n)
            p = rng.randrange(1, 1 + max(1, (n - a) // 3))
            end = rng.randrange(a, n + 1)
            for i in range(a + p, end):
                words[i] = words[i - p]
        assert periodic_runs.find_runs(words) == brute_runs(words), words


def test_nested_and_fibonacci_words():
    inner = list("aaaaaaab" * 3 + "c") * 5
    assert periodic_runs.find_runs(inner) == brute_runs(inner)
    one, two = "a", "ab"
    while len(two) < 400:
        one, two = two, two + one
    assert periodic_runs.find_runs(list(two)) == brute_runs(list(two))
    square = list(("x" * 20 + "y") * 9 + "x" * 25)
    assert periodic_runs.find_runs(square) == brute_runs(square)


def test_long_texts_take_little_time():
    assert periodic_runs.find_runs([b"a"] * 300_000) == [(0, 300_000, 1)]
    block = [b"w%d" % i for i in range(997)]
    assert periodic_runs.find_runs(block * 300) == [(0, 299_100, 997)]
    rng = random.Random(2)
    lines = [[b"l%d-%d" % (k, i) for i in range(9)] for k in range(2)]
    mixed = [word for _ in range(4000) for word in rng.choice(lines)]
    assert all(word[1] >= 4 * word[2] for word in periodic_runs.find_runs(mixed))


def test_collapsed_text_keeps_one_period(make_docs):
    docs = make_docs("say it again again again again again again now", "a b a b a b a b end", "no runs here")
    rows = {row.doc_id: row for row in periodic_runs.with_runs(docs).collect()}
    assert rows[0].collapsed == "say it again now" and rows[0].runs[0].asDict() == {"start": 2, "length": 6, "period": 1}
    assert rows[1].collapsed == "a b end" and rows[2].collapsed == "no runs here"
