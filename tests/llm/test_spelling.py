from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from cardloom.llm import spelling
from cardloom.llm.queries import DAMAGED_RUN


def brute_words(rows, min_length=7, min_count=2):
    counts = Counter()
    for row in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", row.text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if row.doc_id is None else row.doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {word: n for word, n in counts.items() if len(word) >= min_length and n >= min_count}


def edits(word, letters):
    for i in range(len(word) + 1):
        for letter in letters:
            yield word[:i] + letter + word[i:]
            if i < len(word):
                yield word[:i] + letter + word[i + 1:]
        if i < len(word):
            yield word[:i] + word[i + 1:]


def brute(counts, ratio=10):
    letters = {letter for word in counts for letter in word}
    form, rows = {}, []
    near = {word: {edit for edit in edits(word, letters) if edit != word and edit in counts} for word in counts}
    for word, n in counts.items():
        best = min(near[word], key=lambda one: (-counts[one], one), default=None)
        form[word] = best if best is not None and counts[best] >= ratio * n else None
    for word, n in counts.items():
        root = word
        while form[root] is not None:
            root = form[root]
        rows.append((word, form[word], root, n, len(near[word]), counts.get(form[word])))
    return sorted(rows, key=str)


def got(frame):
    assert frame.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted((tuple(row) for row in frame.collect()), key=str)


def words_of(spark, counts):
    return spark.createDataFrame(list(counts.items()), "word string, n long")


def test_documents(documents, messy, empty):
    for docs in (documents, messy, messy.selectExpr("*", "1 AS word", "2 AS n", "3 AS _run")):
        counts = brute_words(docs.collect())
        words = spelling.vocabulary(docs, edit=DAMAGED_RUN)
        assert {row.word: row.n for row in words.collect()} == counts
        assert got(spelling.variants(words)) == brute(counts)
    assert got(spelling.variants(spelling.vocabulary(empty))) == []


def test_capitals_beyond_ascii_stay(make_docs):
    docs = make_docs("ÉCOLIERS écoliers ÉCOLIERS Straßen_STRASSEN straßen", "aĀbcdefgh ABCDEFGH ×××××××")
    found = {row.word: row.n for row in spelling.vocabulary(docs, min_count=1).collect()}
    assert found == {"École".upper()[0] + "coliers": 2, "écoliers": 1, "straßen": 2, "strassen": 1, "bcdefgh": 1,
                     "abcdefgh": 1, "×" * 7: 1}


@pytest.mark.parametrize("crowded", [1 << 15, 64, 4])
def test_dense_vocabulary_and_crowded_keys(spark, crowded):
    rng = random.Random(5)
    counts = {}
    for _ in range(250):  # few letters: many words share a vector
        word = "".join(rng.choice("abcÿ") for _ in range(rng.choice((7, 8, 9))))
        counts[word] = rng.choice((2, 3, 25, 400, 7000))
    for count in (600, 601, 602, 254, 255, 256):  # beyond what a count of the vector holds
        counts["é" * count] = count
    assert got(spelling.variants(words_of(spark, counts), crowded=crowded)) == brute(counts)


def test_ties_and_chains(spark):
    counts = {"aaaaaaa": 2, "aaaaaab": 20, "aaaaaac": 20, "aaaaabb": 200, "aaaabbb": 1999, "unrelated": 5}
    rows = {row[0]: row for row in got(spelling.variants(words_of(spark, counts)))}
    assert rows["aaaaaaa"][1:] == ("aaaaaab", "aaaaabb", 2, 2, 20)
    assert rows["aaaaaab"][1:] == ("aaaaabb", "aaaaabb", 20, 3, 200)
    assert rows["aaaaaac"][1:] == (None, "aaaaaac", 20, 2, None)
    assert rows["aaaaabb"][1:] == (None, "aaaaabb", 200, 2, None)
    assert rows["unrelated"][1:] == (None, "unrelated", 5, 0, None)


def test_one_edit():
    rng = random.Random(1)
    for _ in range(3000):
        a = "".join(rng.choice("ab") for _ in range(rng.randrange(1, 6)))
        b = "".join(rng.choice("ab") for _ in range(rng.randrange(1, 6)))
        assert spelling.one_edit(a, b) == (b in set(edits(a, "ab")) - {a})
