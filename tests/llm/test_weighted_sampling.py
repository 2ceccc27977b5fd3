from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest

from cardloom.llm import weighted_sampling as ws


def jaccard(one, other):
    a, b = Counter(one.lower().split()), Counter(other.lower().split())
    terms = set(a) | set(b)
    return sum(min(a[t], b[t]) for t in terms) / max(1, sum(max(a[t], b[t]) for t in terms))


def test_collision_rate_is_the_generalised_jaccard_similarity():
    rng = np.random.default_rng(5)
    errors = []
    for overlap in (0.0, 0.2, 0.5, 0.8, 1.0):
        for _ in range(12):
            words = rng.zipf(1.5, 400) % 300
            other = np.where(rng.random(400) < overlap, words, 1000 + rng.zipf(1.5, 400) % 300)
            one, two = (" ".join(f"t{w}" for w in v).encode() for v in (words, other))
            a, b = ws.signatures([one, two], 512)
            errors.append(ws.likeness(a, b) - jaccard(one, two))
    assert abs(np.mean(errors)) < 0.01 and np.max(np.abs(errors)) < 0.1


def test_a_signature_does_not_depend_on_company_or_chunks(monkeypatch):
    texts = [b"a b c a", b"", b"  ", " ".join(f"w{i % 700}" for i in range(2000)).encode(), b"A B c A"]
    together = ws.signatures(texts)
    monkeypatch.setattr(ws, "TERMS", 7)
    alone = np.concatenate([ws.signatures([text]) for text in texts])
    assert (together == alone).all()
    assert (together[0] == together[4]).all() and (together[1] == together[2]).all()


def expected(rows):
    ordered = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), (r[1] or "").encode()))
    for at, (key, text, *_) in enumerate(ordered):
        following = ordered[(at + 1) % len(ordered)][1] or ""
        yield key, text or "", ws.edited_text(text or "", following), following


@pytest.mark.parametrize("range_bytes", [1 << 26, 30_000])
def test_every_row_meets_its_next_one(messy, documents, range_bytes):
    for docs in (messy, documents):
        rows = [tuple(row) for row in docs.collect()]
        got = ws.fingerprints(docs, range_bytes=range_bytes).collect()
        want = Counter((key, len(text), hashlib.sha256(edited.encode()).hexdigest()) for key, text, edited, _ in expected(rows))
        assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == want
        assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)


def test_fingerprints_of_equal_texts_and_likeness_columns(make_docs):
    docs = make_docs("one two three four", "One TWO three four", "x y z", None, "")
    got = {r.doc_id: r for r in ws.fingerprints(docs).collect()}
    assert got[0].fingerprint == got[1].fingerprint and got[1].near_next == 1.0
    assert got[3].fingerprint == got[4].fingerprint and got[4].near_next == 1.0 and got[4].near_edited == 1.0
    assert got[0].near_next == 0.0  # after the last comes the first, which is empty
    assert len(got[0].fingerprint) == 2 * ws.SAMPLES


def test_lone_document_and_empty_table(make_docs, empty):
    only = ws.fingerprints(make_docs("abcd ef")).collect()
    assert [(r.doc_id, r.near_next) for r in only] == [(0, 1.0)]
    assert ws.fingerprints(empty).count() == 0
    assert ws.fingerprints(make_docs((None, "a"), (None, None))).count() == 2


def test_extra_columns_do_not_matter(documents):
    docs = documents.selectExpr("*", "1 AS _range", "2 AS fingerprint", "3 AS _id")
    assert ws.fingerprints(docs).count() == documents.count()


def test_equal_texts_in_other_company_and_memory():
    """Ties of float draws go by the term's hash, whatever texts a portion holds and whatever is remembered."""
    rng = np.random.default_rng(5)
    texts = [" ".join(f"t{i}" for i in rng.choice(60_000, 5000, replace=False)).encode() for _ in range(300)]
    alone = np.concatenate([ws.signatures(texts[i:i + 1]) for i in range(len(texts))])
    together = np.concatenate([ws.signatures(texts[i:i + 7][::-1])[::-1] for i in range(0, len(texts), 7)])
    small = np.concatenate([ws.signatures(texts[i:i + 3], remembered=1700) for i in range(0, len(texts), 3)])
    assert (alone == together).all() and (alone == small).all()


def test_ties_go_to_the_smallest_hash(monkeypatch):
    monkeypatch.setattr(ws, "_uniforms", lambda hashes, samples, which: [np.full(
        (len(hashes), samples), 0.5, np.float32)] * 2)  # all terms tie in every sample
    ws.known_draws.cache_clear()
    texts = [b"one two three four five", b"five four three two one"]
    found = [ws.signatures(texts, remembered=room) for room in (64, 2)]
    ws.known_draws.cache_clear()
    assert (found[0] == found[1]).all() and (found[0][0] == found[0][1]).all()
