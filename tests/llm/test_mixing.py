from __future__ import annotations

import hashlib
import re

import pytest

from cardloom.llm.mixing import mix, mixed, source_targets


def water_fill(sizes, weights, share=1.5, repeats=2):
    """Targets by sharing the excess again and again."""
    total = share * sum(sizes)
    capped: set[int] = set()
    while True:
        left = total - sum(repeats * sizes[i] for i in capped)
        free = [i for i in range(len(sizes)) if i not in capped]
        shares = {i: left * weights[i] / sum(weights[j] for j in free) for i in free}
        over = {i for i in free if shares[i] > repeats * sizes[i]}
        if not over:
            return [repeats * sizes[i] if i in capped else shares[i] for i in range(len(sizes))]
        capped |= over


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def expected(rows):
    by_source: dict = {}
    for doc_id, text, source in rows:
        by_source.setdefault(source, []).append((doc_id, words(text)))
    order = sorted(by_source, key=lambda s: (s is None, (s or "").encode()))
    sizes = [sum(n for _, n in by_source[s]) for s in order]
    targets = water_fill(sizes, [(3, 1, 2)[i % 3] for i in range(len(order))])
    found = {}
    for source, size, target in zip(order, sizes, targets):
        budget = int(target)
        passes = budget // size if size else 0
        rest = budget - passes * size
        for doc_id, n in sorted(by_source[source], key=lambda d: hashlib.md5(str(d[0]).encode()).hexdigest()[:15]):
            found[doc_id] = (n, size, pytest.approx(target), passes * n + max(0, min(n, rest)))
            rest -= n
    return found


def test_equals_sorting_by_hash(documents):
    rows = [(r.doc_id, r.text, r.source) for r in documents.collect()]
    got = {r.doc_id: (r.size, r.source_size, r.target, r.taken) for r in mix(documents).collect()}
    assert got == expected(rows)


def test_one_source_with_a_third_and_one_with_a_single_document(make_docs):
    docs = make_docs(*[(i, "w " * (i % 7), ("hot" if i % 3 else f"s{i % 5}")) for i in range(600)], (9999, "a b c", "tiny"))
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    got = {r.doc_id: (r.size, r.source_size, r.target, r.taken) for r in mix(docs).collect()}
    assert got == expected(rows)


@pytest.mark.parametrize("sizes", [[10, 10, 10], [1, 1000, 1], [0, 5, 0, 7], [3, 100, 100, 100, 2, 50], [1]])
def test_targets(spark, sizes):
    frame = spark.createDataFrame([(f"s{i:02d}", size) for i, size in enumerate(sizes)], "source string, size long")
    got = [r.target for r in sorted(source_targets(frame).collect())]
    assert got == [pytest.approx(t) for t in water_fill(sizes, [(3, 1, 2)[i % 3] for i in range(len(sizes))])]
    assert sum(got) == pytest.approx(1.5 * sum(sizes))


def test_messy_rows(messy, empty):
    got = mix(messy.selectExpr("*", "1 AS size", "2 AS _row", "3 AS limit", "4 AS hash")).collect()
    assert len(got) == messy.count() and all(0 <= r.taken <= 2 * r["size"] for r in got)
    assert all(r["size"] == 0 and r.taken == 0 for r in got if not (r.text or "").strip())
    by_source: dict = {}
    for r in got:
        by_source.setdefault(r.source, [0, r.target])[0] += r.taken
    assert all(abs(taken - target) <= 3 for taken, target in by_source.values())
    assert mix(empty).count() == 0 == mixed(empty).count()


def test_no_words_at_all(make_docs):
    assert {(r.target, r.taken) for r in mix(make_docs("", None, " ")).collect()} == {(0.0, 0)}


def test_mixed_documents_are_whole_and_near_the_target(documents):
    docs = documents.selectExpr("*", "1 AS _doc", "2 AS taken")
    got = mixed(docs)
    assert got.columns == docs.columns
    targets = {r.source: r.target for r in mix(documents).collect()}
    totals: dict = {}
    largest: dict = {}
    for r in got.collect():
        totals[r.source] = totals.get(r.source, 0) + words(r.text)
    for r in documents.collect():
        largest[r.source] = max(largest.get(r.source, 0), words(r.text))
    assert all(abs(totals.get(s, 0) - t) <= largest[s] / 2 + 1 for s, t in targets.items())
    assert got.exceptAll(docs.union(docs)).isEmpty()


def test_partitions_do_not_matter(documents):
    assert sorted(map(tuple, mix(documents.repartition(5), keep=["doc_id"]).collect())) == sorted(
        map(tuple, mix(documents.coalesce(1), keep=["doc_id"]).collect()))
