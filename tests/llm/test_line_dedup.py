from __future__ import annotations

import hashlib
import string
from collections import Counter

import pytest

from cardloom.llm.line_dedup import dedup_lines

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def line_key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(LOWER)


def expected(rows, documents=2):
    holders: dict = {}
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            holders.setdefault(line_key(line), set()).add(doc_id)
    for doc_id, text in rows:
        kept, lines = [], (text or "").split("\n")
        for line in lines:
            ids = holders[line_key(line)]
            first = min((i for i in ids if i is not None), default=None)
            if len(line_key(line)) < 10 or len(ids) < documents or doc_id == first:
                kept.append(line)
        joined = "\n".join(kept)
        yield doc_id, len(lines), len(lines) - len(kept), hashlib.sha256(joined.encode()).hexdigest(), joined


@pytest.mark.parametrize("documents_needed", [2, 3])
def test_given_and_messy_documents(documents, messy, make_docs, documents_needed):
    lines = make_docs(
        "a shared line here\nown line of the first\nshort", "  A Shared LINE here \r\nshort\nanother own line", "x\na shared line here\nx",
        (None, "a shared line here\nonly null ids hold this"), (None, "only null ids hold this"), (9, "twice in one row\ntwice in one row"),
        (10, "Éa shared line\n\u00a0a shared line here"), (11, "éa shared line"), (12, "\n\n\n"))
    for docs in (documents, messy, lines):
        rows = [(r.doc_id, r.text) for r in docs.collect()]
        got = dedup_lines(docs, documents=documents_needed).collect()
        assert Counter((r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256, r.kept_text) for r in got) == Counter(
            expected(rows, documents_needed))


def test_lines_that_begin_or_end_in_f_or_form_feeds(make_docs):
    docs = make_docs(
        "First line of text\nten chars f\na long list of\nfive and f", "first line of text\nTEN CHARS F\na long list o\nFIVE AND F",
        "\x0cfirst line of text\x0c\nf at start\nfffffffffff\na long list oF\x0c", "F AT START\n \x0c f at start\x0c\nfffffffff\nffffffffffF",
        "form\x0cfeed inside\n\x0cfour words\x0c", "formfeed inside\nfour words")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = dedup_lines(docs).collect()
    assert Counter((r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256, r.kept_text) for r in got) == Counter(expected(rows))
    assert {r.doc_id: r.n_dropped for r in got} == {0: 0, 1: 3, 2: 2, 3: 3, 4: 0, 5: 1}


def test_a_line_in_a_third_of_all_documents(make_docs):
    docs = make_docs(*[f"own line number {i}\n" + ("a very common line" if i % 3 == 0 else "") for i in range(300)])
    got = dedup_lines(docs).collect()
    assert sum(r.n_dropped for r in got) == 99 and next(r for r in got if r.doc_id == 0).n_dropped == 0


def test_empty_table_and_clashing_columns(empty, messy):
    assert dedup_lines(empty).count() == 0
    got = dedup_lines(messy.selectExpr("*", "1 AS at", "2 AS n_lines", "3 AS _row", "4 AS drops"))
    assert got.columns == [*messy.columns, "at", "_row", "drops", "kept_text", "n_lines", "n_dropped", "kept_sha256"]
    assert got.where("at = 1 AND _row = 3 AND drops = 4").count() == messy.count()
