from __future__ import annotations

import random
import re

import numpy as np
import pytest

from cardloom.llm import jaccard_join
from cardloom.llm.jaccard_join import jaccard_components


def brute_set(text, width=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return frozenset()
    return frozenset(" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1)))


def brute(rows, width=5, percent=80):
    sets = [brute_set(row.text, width) for row in rows]
    distinct = sorted({one for one in sets if one}, key=len)
    root = {one: one for one in distinct}

    def top(one):
        while root[one] != one:
            one = root[one]
        return one

    for i, one in enumerate(distinct):
        for other in distinct[i + 1:]:
            if 100 * len(one) < percent * len(other):
                break
            common = len(one & other)
            if 100 * common >= percent * (len(one) + len(other) - common):
                root[top(one)] = top(other)
    lowest = {}
    for row, one in zip(rows, sets):
        if one and row.doc_id is not None:
            lowest[top(one)] = min(lowest.get(top(one), row.doc_id), row.doc_id)
    return sorted(((row.doc_id, len(one), lowest.get(top(one)) if one else row.doc_id) for row, one in zip(rows, sets)), key=str)


def check(docs, **options):
    got = sorted((tuple(row) for row in jaccard_components(docs, **options).collect()), key=str)
    assert got == brute(docs.collect(), options.get("width", 5), options.get("percent", 80))
    return got


def test_given_documents(documents):
    got = check(documents)
    assert any(doc_id != component for doc_id, _, component in got)


def test_messy_empty_and_clashing(messy, empty):
    check(messy)
    assert check(messy.selectExpr("*", "1 AS rep", "2 AS size", "3 AS node", "4 AS token")) == check(messy)
    assert jaccard_components(empty).count() == 0


def family(rng, size, length, changes):
    """Near copies of one text, some only linked through others."""
    base = [f"b{rng.randrange(10**6)}" for _ in range(length)]
    for i in range(size):
        words = list(base)
        for _ in range(rng.randrange(changes)):
            words[rng.randrange(length)] = f"n{rng.randrange(10**6)}"
        yield " ".join(words)


@pytest.mark.parametrize("chunk", [4096, 8])
def test_families_and_shared_passages(make_docs, chunk):
    rng = random.Random(chunk)
    passage = " ".join(f"p{i}" for i in range(60))
    texts = [text for length in (40, 90, 200) for text in family(rng, 25, length, 1 + length // 20)]
    for i in range(60):  # passages that many share, in texts of similar length
        own = [f"o{i}-{j}" for j in range(rng.randrange(5, 40))]
        texts.append(f"{' '.join(own[:len(own) // 2])} {passage} {' '.join(own[len(own) // 2:])}")
    texts += [" ".join(rng.choice("abc") for _ in range(rng.randrange(1, 9))) for _ in range(80)]
    texts += texts[:10] + [text.upper() for text in texts[:10]]
    rng.shuffle(texts)
    got = check(make_docs(*texts), chunk=chunk)
    assert len({component for *_, component in got}) < len(got) - 50


@pytest.mark.parametrize("width, percent", [(1, 50), (3, 95), (2, 100)])
def test_other_thresholds(make_docs, width, percent):
    rng = random.Random(width)
    check(make_docs(*(" ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(12))) for _ in range(150))),
          width=width, percent=percent)


def test_a_group_of_near_copies_is_not_compared_pair_by_pair(make_docs, monkeypatch):
    rng, size, pairs, linked = random.Random(1), 500, [], jaccard_join.linked
    base = [f"b{i}" for i in range(150)]
    texts = []
    for i in range(size):  # one to three changes each: pairs lie on both sides of the threshold
        words = list(base)
        for _ in range(rng.randrange(1, 4)):
            words[rng.randrange(len(base))] = f"n{rng.randrange(10**6)}"
        texts.append(" ".join(words))

    def counted(candidates, *rest):
        pairs.append(candidates.count())
        return linked(candidates, *rest)

    monkeypatch.setattr(jaccard_join, "linked", counted)
    check(make_docs(*texts))
    assert sum(pairs) < 30 * size


def test_rounds_without_work_start_no_jobs_of_their_own(make_docs, monkeypatch):
    """The driver holds threads, plans and broadcasts of the jobs that it has lately run."""
    labels, stage = [], jaccard_join.stage
    monkeypatch.setattr(jaccard_join, "stage", lambda df, label: labels.append(label) or stage(df, label))
    check(make_docs(*(" ".join(f"w{i}-{j}" for j in range(30)) for i in range(20))))
    assert not {"wanted", "token-sets"} & {*labels} and labels.count("roots") == 1


def test_folded_sketches_bound_the_difference():
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 1 << 63, rng.integers(1, 3000), dtype=np.uint64)) for _ in range(30)]
    sets += [np.unique(np.concatenate([one[3:], rng.integers(0, 1 << 63, 3, dtype=np.uint64)])) for one in sets]
    brief = [jaccard_join.folded(jaccard_join.sketch(one)) for one in sets]
    assert max(map(len, brief)) == 8 * jaccard_join.WORDS
    one, two = (side.ravel() for side in np.indices((len(sets), len(sets))))
    got = jaccard_join.least_differences([*brief, None], one, two, held=7)
    assert got.tolist() == [jaccard_join.least_difference(brief[a], brief[b]) for a, b in zip(one, two)]
    assert all(n <= len(np.setxor1d(sets[a], sets[b])) for n, a, b in zip(got, one, two))
    assert jaccard_join.least_differences([brief[0], None], np.array([0, 1]), np.array([1, 1])).tolist() == [-1, -1]


def test_bounds_hold():
    rng = np.random.default_rng(3)
    for _ in range(500):
        pool = rng.integers(0, 1 << 63, 600, dtype=np.uint64)
        a, b = (np.unique(rng.choice(pool, rng.integers(1, 400))) for _ in range(2))
        differ = len(np.setxor1d(a, b))
        assert jaccard_join.least_difference(jaccard_join.sketch(a), jaccard_join.sketch(b)) <= differ
    for size in range(1, 300):  # a set's prefix is what its smallest partner leaves over, and one more
        assert jaccard_join.prefix_length(size, 80) == size - jaccard_join.needed(size, -(-80 * size // 100), 80) + 1


def test_at_the_threshold(make_docs):
    base = [f"w{i}" for i in range(13)]  # nine shingles; a change at the end makes one differ: 8 of 10
    docs = make_docs(" ".join(base), " ".join([*base[:-1], "x"]), " ".join([*base[:-2], "y", "z"]))
    assert {row.doc_id: row.component_id for row in jaccard_components(docs).collect()} == {0: 0, 1: 0, 2: 2}
