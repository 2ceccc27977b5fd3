from __future__ import annotations

import hashlib
import string

from pyspark.sql import functions as F
import pytest

from cardloom.llm.exact_dedup import distinct_texts, exact_dedup

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def expected(rows):
    """(doc_id, keep_id, size, sha) of each row, and the number of rows to keep."""
    groups: dict[str, list] = {}
    for doc_id, text, *_ in rows:
        groups.setdefault((text or "").translate(LOWER), []).append(doc_id)
    found = []
    for norm, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        found += [(i, keep, len(ids), hashlib.sha256(norm.encode()).hexdigest()) for i in ids]
    return sorted(found, key=str), len(groups)


def check(docs, **options):
    rows = [tuple(row) for row in docs.select("doc_id", "text").collect()]
    got = exact_dedup(docs, keep=["doc_id"], **options).collect()
    want, groups = expected(rows)
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == want
    kept = [r for r in got if r.kept]
    assert len(kept) == groups == len({r.text_sha256 for r in kept})
    assert all(r.doc_id == r.keep_id for r in kept)


def test_messy_rows(messy):
    check(messy)


@pytest.mark.parametrize("options", [
    {"bucket_bytes": 20_000}, {"bucket_bytes": 8000, "text_key": "octet_length({}) % 3"},
])
def test_small_buckets_and_colliding_keys_change_nothing(messy, documents, options):
    check(messy.union(documents), **options)


def test_a_third_of_all_rows_is_one_text_over_pages(make_docs):
    docs = make_docs(*[(i, "The hot text" if i % 3 else f"text {i % 50}") for i in range(900)])
    check(docs, bucket_bytes=200)


def test_empty_table(empty):
    assert exact_dedup(empty).count() == 0
    assert distinct_texts(empty).columns == empty.columns


def test_clashing_columns(messy):
    docs = messy.selectExpr("*", "'x' AS keep_id", "1 AS _row", "2 AS _key", "3 AS `a.b`", "4 AS kept")
    got = exact_dedup(docs)
    assert got.columns == [*messy.columns, "_row", "_key", "a.b", "keep_id", "group_size", "kept", "text_sha256"]
    assert got.count() == messy.count() and got.where("_row = 1 AND _key = 2 AND `a.b` = 3").count() == messy.count()
    kept = distinct_texts(docs)
    assert kept.columns == docs.columns and kept.where("keep_id = 'x' AND kept = 4").count() == kept.count()


def test_distinct_texts_returns_rows_unchanged(messy):
    rows = {tuple(row) for row in messy.collect()}
    kept = [tuple(row) for row in distinct_texts(messy).collect()]
    assert set(kept) <= rows and len(kept) == len({(row[1] or "").translate(LOWER) for row in rows})


def test_no_python_in_the_plan(documents):
    plan = exact_dedup(documents, keep=["doc_id"])._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_texts_are_compared_in_the_owner_task_without_another_exchange(documents):
    from cardloom.llm.exact_dedup import TEXT_KEY, bucket_capacity, directory, key_loads, overflow_pages, owned_pages

    source = documents.select(F.struct("doc_id").alias("_row"), F.col("doc_id").alias("_id"), F.col("text").alias("_text"))
    source = source.selectExpr("*", f"{TEXT_KEY.format('_text')} AS _key")
    loads = key_loads(source)
    total = loads.selectExpr("sum(load)").first()[0]
    capacity = bucket_capacity(total, 4, 1 << 20)
    entries = directory(loads, capacity, total)
    filled = entries.groupBy("owner").count().count()
    assert filled > 4  # the directory has doubled
    plan = owned_pages(source, entries, overflow_pages(loads, capacity), filled, None)._jdf.queryExecution().toString()
    part = plan[plan.index("== Physical Plan =="):]
    assert part.count("_norm#") and part[: part.index("BroadcastHashJoin")].count("Exchange") == 1
